"""Rules held in tables: patterns, hints, templates and priorities that first-match expressions are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rules that one table may hold; they become one expression, so a table beyond this is refused rather than cut.
MOST_RULES = 1_000


def rule_list(table: DataFrame, *columns: str, order: str = "pos") -> list[tuple]:
    """The rules of a table by ``order``, then by their columns, for functions that take a list of them (``dict`` makes it a mapping)."""
    rows = table.orderBy(order, *columns).select(*columns).limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"a table of rules holds more than {MOST_RULES}")
    return [tuple(x) for x in rows]
