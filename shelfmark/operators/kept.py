"""Tables kept in a shared folder and changed in place: by replacing the buckets that a batch touches, or by adding runs that are merged on reading.

Rows lie in ``rows/run=<name>/bucket=<n>``, by a hash of the key; a snapshot (``shelfmark.snapshots``), published last, says which
folders make up the table. Files of a change that failed are in no snapshot and are never read. A batch of a stream carries the stream's name
and its number: a batch that was applied before changes nothing. ``remove_unread`` deletes the folders that the last snapshots don't name.

``KeptTable`` is for tables that are read often and changed by few keys: buckets without a changed row keep their files.
``KeptRuns`` is for state that every batch adds to: a batch writes rows for its own keys only, and runs of like size are merged four or more
at a time, so that a row is written again a number of times that grows with the logarithm of the table, and so does the number of runs.

Choose ``buckets`` so that one holds some hundred MB. Keys are spread by the hash that Spark's shuffle uses, so a task writes few buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import file_system
from shelfmark.snapshots import Snapshots

#: A run belongs to the tier of its row count's logarithm to this base; as many runs of a tier or below are merged.
FAN = 4


class _Kept:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType | str, buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.schema = T.StructType([T.StructField(x.name, x.dataType) for x in spark.createDataFrame([], schema).schema])
        self.columns = self.schema.names
        self.snapshots = Snapshots(spark, self.path)

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).alias("bucket")

    def _name(self, now: dict) -> str:
        return f"{now['number'] + 1:09d}-{uuid.uuid4().hex[:8]}"

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.select("*", self._bucket()).write.partitionBy("bucket").parquet(f"{self.path}/{folder}")

    def _read(self, base: str, folders: list[str], more: tuple[str, ...] = ()) -> DataFrame:
        """Rows of the folders with their bucket, and further columns of text."""
        wanted = T.StructType([*self.schema, *[T.StructField(c, T.StringType()) for c in more], T.StructField("bucket", T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], wanted)
        rows = self.spark.read.schema(T.StructType([*wanted, T.StructField("run", T.StringType())])).option("basePath", f"{self.path}/{base}").parquet(*[f"{self.path}/{base}/{x}" for x in folders])
        return rows.drop("run")

    def _buckets_of(self, folder: str) -> list[int]:
        system, place = file_system(self.spark, f"{self.path}/{folder}")
        return sorted(int(n.split("=")[1]) for x in system.listStatus(place) if (n := x.getPath().getName()).startswith("bucket="))

    def _delete(self, folder: str) -> None:
        system, place = file_system(self.spark, f"{self.path}/{folder}")
        system.delete(place, True)

    def _applied(self, now: dict, batch: tuple[str, int] | None) -> bool:
        return batch is not None and now["applied"].get(batch[0], -1) >= batch[1]

    def remove_unread(self, keep: int = 2) -> int:
        """Delete run folders that none of the last ``keep`` snapshots names; how many went. Call it when no change is under way."""
        known = self.snapshots.numbers()[-keep:]
        named = set().union(*[self._named(self.snapshots.read(n)) for n in known]) if known else set()
        system, place = file_system(self.spark, f"{self.path}/rows")
        runs = [x.getPath().getName().removeprefix("run=") for x in system.listStatus(place)] if system.exists(place) else []
        lost = [r for r in runs if r not in named]
        for r in lost:
            self._delete(f"rows/run={r}")
        return len(lost)

    def _named(self, snapshot: dict) -> set[str]:
        raise NotImplementedError


class KeptTable(_Kept):
    """A table with one row a key, changed by merges that rewrite only the buckets in which a row changes."""

    def snapshot(self) -> dict:
        return self.snapshots.latest({"held": {}, "applied": {}})

    def _named(self, snapshot: dict) -> set[str]:
        return set(snapshot["held"].values())

    def folders(self, buckets: list[int] | None = None) -> list[str]:
        """Where the rows of the buckets (all of them, unless named) are."""
        return [f"run={run}/bucket={b}" for b, run in self.snapshot()["held"].items() if buckets is None or int(b) in set(buckets)]

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        return self._read("rows", self.folders(buckets)).select(self.columns)

    def merge(self, new: DataFrame, fill: tuple[str, ...] = (), replace: tuple[str, ...] = (), keep: tuple[str, ...] = (), order: tuple[str, ...] = (), batch: tuple[str, int] | None = None) -> dict[str, int]:
        """Merge ``new`` by key; how many rows were added and updated.

        Every other column is in one of three lists. ``fill``: the new value unless null; ``replace``: the new value; ``keep``: the old value if there is a row. All
        in ``keep`` is insert-or-ignore, all in ``replace`` is insert-or-replace. Of new rows with one key the last by ``order`` counts (nulls first), then by its
        values; all its columns must be of types that can be ordered. A row whose values stay the same isn't updated, and a bucket without added or updated rows keeps its files, so a second merge of the same rows
        publishes nothing. New rows with a null in the key are left out. Columns that the table lacks are ignored, but for use in ``order``.
        """
        values = [c for c in self.columns if c not in self.keys]
        if sorted((*fill, *replace, *keep)) != sorted(values):
            raise ValueError(f"fill, replace and keep must hold each of {values} once")
        now = self.snapshot()
        if self._applied(now, batch):
            return {"added": 0, "updated": 0}
        run = self._name(now)
        row = F.struct(*[F.col(c) for c in values], F.lit(True).alias("_there"))
        last = new.dropna(subset=self.keys).groupBy(*self.keys).agg(F.max_by(row, F.struct(*order, *values, *self.keys)).alias("_n"))
        incoming = f"incoming/run={run}"
        self._write(last.select(*self.keys, *[F.col("_n")[c].alias(c) for c in values]), incoming)
        touched = self._buckets_of(incoming)
        old = self.read(touched).select(*self.keys, row.alias("_o"))
        rows = self._read("incoming", [f"run={run}"] if touched else []).select(*self.keys, row.alias("_n"))
        o, n = F.col("_o"), F.col("_n")
        pick = {c: F.coalesce(n[c], o[c]) for c in fill} | {c: F.when(n.isNotNull(), n[c]).otherwise(o[c]) for c in replace} | {c: F.when(o.isNotNull(), o[c]).otherwise(n[c]) for c in keep}
        same = F.lit(True)
        for c in values:
            same = same & pick[c].eqNullSafe(o[c])
        change = F.when(o.isNull(), "added").when(n.isNull() | same, "kept").otherwise("updated")
        self._write(old.join(rows, self.keys, "full").select(*self.keys, *[pick[c].alias(c) for c in values], change.alias("_change")), f"rows/run={run}")
        self._delete(incoming)
        made = self._read("rows", [f"run={run}"] if touched else [], ("_change",)).groupBy("bucket").agg(F.count_if(F.col("_change") == "added").alias("added"), F.count_if(F.col("_change") == "updated").alias("updated"))
        changed = [x for x in made.collect() if x["added"] or x["updated"]]  # a row a bucket at most
        if changed or batch is not None:
            held = now["held"] | {str(x["bucket"]): run for x in changed}
            applied = now["applied"] | ({batch[0]: batch[1]} if batch else {})
            self.snapshots.publish({"number": now["number"] + 1, "held": held, "applied": applied})
        if not changed:
            self._delete(f"rows/run={run}")
        return {"added": sum(x["added"] for x in changed), "updated": sum(x["updated"] for x in changed)}


class KeptRuns(_Kept):
    """State with one row a key, merged from runs by ``rules``: for each other column an aggregate that gives the same whether it is taken at once or in parts (sum, min, max, ``union``)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType | str, rules: dict[str, Callable[[str], Column]], buckets: int = 64):
        super().__init__(spark, path, keys, schema, buckets)
        self.rules = rules

    def snapshot(self) -> dict:
        return self.snapshots.latest({"runs": [], "applied": {}})

    def _named(self, snapshot: dict) -> set[str]:
        return {r["name"] for r in snapshot["runs"]}

    def merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[rule(c).alias(c) for c, rule in self.rules.items()]).select(self.columns)

    def _rows(self, runs: list[dict]) -> DataFrame:
        return self._read("rows", [f"run={r['name']}" for r in runs])

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The merged rows, of the buckets named or of all; only their folders are read."""
        runs = self.snapshot()["runs"]
        rows = self._rows(runs) if buckets is None else self._rows(runs).where(F.col("bucket").isin(buckets) if buckets else F.lit(False))
        return self.merged(rows) if len(runs) > 1 else rows.select(self.columns)

    def add(self, rows: DataFrame, batch: tuple[str, int] | None = None, unknown: bool = False) -> int:
        """Add rows as a run of their own; how many keys it has. With ``unknown`` only keys that no run holds are added, and just the buckets of the rows are looked at."""
        now = self.snapshot()
        if self._applied(now, batch):
            return 0
        run = self._name(now)
        rows = self.merged(rows)
        incoming = f"incoming/run={run}"
        if unknown:
            self._write(rows, incoming)
            touched = self._buckets_of(incoming)
            known = self._rows(now["runs"]).where(F.col("bucket").isin(touched) if touched else F.lit(False)).select([F.col(k).alias(f"_{k}") for k in self.keys])
            same = F.lit(True)
            for k in self.keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            rows = self._read("incoming", [f"run={run}"] if touched else []).join(known, same, "left_anti").select(self.columns)
        self._write(rows, f"rows/run={run}")
        n = self._rows([{"name": run}]).count() if self._buckets_of(f"rows/run={run}") else 0
        if unknown:
            self._delete(incoming)
        applied = now["applied"] | ({batch[0]: batch[1]} if batch else {})
        runs = [*now["runs"], {"name": run, "rows": n}] if n else now["runs"]
        if n or batch is not None:
            self.snapshots.publish({"number": now["number"] + 1, "runs": runs, "applied": applied})
        start = merge_from([r["rows"] for r in runs])
        if start is not None:
            self.compact(start)
        return n

    def compact(self, start: int = 0) -> None:
        """Write the runs from ``start`` on as one."""
        now = self.snapshot()
        run = self._name(now)
        self._write(self.merged(self._rows(now["runs"][start:])), f"rows/run={run}")
        n = self._rows([{"name": run}]).count()
        self.snapshots.publish({"number": now["number"] + 1, "runs": [*now["runs"][:start], {"name": run, "rows": n}], "applied": now["applied"]})


def union(column: str) -> Column:
    """The distinct items of arrays; for arrays of few values."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(column))))


def merge_from(sizes: list[int]) -> int | None:
    """Where the longest tail of FAN runs or more begins that is of one tier or below; none if no tail is so long."""
    tier = lambda n: (max(n, 1).bit_length() - 1) // (FAN.bit_length() - 1)
    best, highest = None, 0
    for i in range(len(sizes) - 1, -1, -1):
        highest = max(highest, tier(sizes[i]))
        of_tier = sum(tier(n) == highest for n in sizes[i:])
        if of_tier >= FAN:
            best = i
    return best
