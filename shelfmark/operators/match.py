"""Exact search by expressions over postings: terms, phrases and prefixes joined by ``&``, ``|`` and ``~`` in any nesting.

    (term("energy") | phrase("heat", "pump")) & ~prefix("nucle")

An expression becomes one plan: the postings of its leaves, grouped by document into one truth value and one
number of occurrences a leaf, and a filter that is the expression itself. No leaf has a scan or a join of its own. Only an expression that
is true of a document without any leaf (``~term("x")``) needs the list of all documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import index


class Expression:
    def __and__(self, other: Expression) -> Expression:
        return All((self, other))

    def __or__(self, other: Expression) -> Expression:
        return Some((self, other))

    def __invert__(self) -> Expression:
        return Not(self)


@dataclass(frozen=True)
class Leaf(Expression):
    """Words that follow one another, or, with ``open_end``, one word and all that begin with it."""

    words: tuple[str, ...]
    open_end: bool = False

    def hit(self, term: Column, word: str) -> Column:
        return F.startswith(term, F.lit(word)) if self.open_end else term == word


@dataclass(frozen=True)
class All(Expression):
    parts: tuple[Expression, ...]


@dataclass(frozen=True)
class Some(Expression):
    parts: tuple[Expression, ...]


@dataclass(frozen=True)
class Not(Expression):
    part: Expression


def term(word: str) -> Leaf:
    return Leaf((word,))


def phrase(*words: str) -> Leaf:
    return Leaf(words)


def prefix(word: str) -> Leaf:
    return Leaf((word,), True)


def leaves(e: Expression) -> list[Leaf]:
    """The different leaves, in order."""
    found = [e] if isinstance(e, Leaf) else leaves(e.part) if isinstance(e, Not) else [x for p in e.parts for x in leaves(p)]
    return list(dict.fromkeys(found))


def wanted(e: Expression, under_not: bool = False) -> list[Leaf]:
    """The leaves that speak for a document: those under an even number of negations."""
    if isinstance(e, Leaf):
        return [] if under_not else [e]
    if isinstance(e, Not):
        return wanted(e.part, not under_not)
    return list(dict.fromkeys(x for p in e.parts for x in wanted(p, under_not)))


def true_when(e: Expression, of: dict) -> Column | bool:
    """The expression with a column, or a truth value, in the place of each leaf."""
    if isinstance(e, Leaf):
        return of[e]
    if isinstance(e, Not):
        inner = true_when(e.part, of)
        return not inner if isinstance(inner, bool) else ~inner
    parts = [true_when(p, of) for p in e.parts]
    return reduce((lambda a, b: a & b) if isinstance(e, All) else (lambda a, b: a | b), parts)


def keys_of(postings: DataFrame, found: list[Leaf]) -> DataFrame:
    """The postings of the leaves' words. A kept index is read only in their folders (all of them for a prefix shorter than a folder's stem)."""
    term_ = F.col("term")
    rows = postings.where(reduce(lambda a, b: a | b, [x.hit(term_, w) for x in found for w in x.words]))
    if "folder" not in postings.columns or any(x.open_end and len(x.words[0]) < index.STEM for x in found):
        return rows
    return rows.where(F.col("folder").isin(sorted({index.folder_number(w) for x in found for w in x.words})))


def search(postings: DataFrame, e: Expression, docs: DataFrame | None = None) -> DataFrame:
    """doc_id and n of the documents that the expression is true of: n occurrences of its leaves outside negations.

    ``postings`` (term, doc_id, pos) may be those of a kept index. ``docs`` (doc_id) is needed only where the expression is true of a document without a leaf.
    """
    found = leaves(e)
    if any(not w for x in found for w in x.words) or any(not x.words for x in found):
        raise ValueError("a leaf needs words")
    hits = F.array_compact(F.array(*[F.when(x.hit(F.col("term"), w), F.struct(F.lit(i).alias("leaf"), F.lit(at).alias("at"))) for i, x in enumerate(found) for at, w in enumerate(x.words)]))
    rows = keys_of(postings, found).select("doc_id", "pos", F.explode(hits).alias("hit"))
    # words of one start belong together; a leaf of one word has a start at each of its places
    starts = rows.groupBy("doc_id", F.col("hit.leaf").alias("leaf"), (F.col("pos") - F.col("hit.at")).alias("start")).agg(F.count("*").alias("k"))
    whole = F.element_at(F.array(*[F.lit(len(x.words)) for x in found]), F.col("leaf") + 1)
    per = starts.where(F.col("k") == whole).groupBy("doc_id").agg(*[F.count_if(F.col("leaf") == i).alias(f"leaf{i}") for i in range(len(found))])
    if true_when(e, dict.fromkeys(found, False)):
        if docs is None:
            raise ValueError("this expression is true of documents without any of its words: name all documents")
        per = docs.select("doc_id").distinct().join(per, "doc_id", "left").fillna(0)
    own = sum((F.col(f"leaf{found.index(x)}") for x in wanted(e)), F.lit(0))
    return per.where(true_when(e, {x: F.col(f"leaf{i}") > 0 for i, x in enumerate(found)})).select("doc_id", own.cast("long").alias("n"))
