"""Kept search indexes: postings or trigrams of a corpus, written in batches, refreshed by document and merged later.

An index is a folder with one sub-folder for each batch and a list of snapshots. A batch holds three tables: ``docs`` (doc_id, mtime),
``rows`` (the postings, in folders by the start of their key) and ``gone`` (doc_id and batch of rows of
earlier batches that it replaces or takes back). A snapshot names the batches that make up the index, and
is written last, by a rename to the next number: readers take the highest number, so they see all of a refresh or nothing, and of two
refreshes at once one fails. Files of a failed refresh are in no snapshot and are never read.

A refresh compares ids and times (``changed_docs``), makes rows of new and changed documents only, and leaves the rest
of the index as it is. Rows that a later batch replaced are left out on reading, by an anti-join with ``gone``. Beyond
MERGE_AT batches those after the largest are merged; where replaced documents are over a GONE_SHARE-th of all, every batch is. The folder
is named by the kind of index and its FORMAT, so a changed tokeniser starts a new one.

Cases: a null text has no rows but is known; a null doc_id is left out (it can't be found again); of rows with one doc_id the latest time
counts, of equal times all rows; a null time always counts as changed; an empty corpus gives an empty index.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.snapshots import Snapshots

#: Raise when what ``build`` gives changes, or the layout does.
FORMAT = 3
FOLDERS = 64
#: Characters of a key that decide its folder: a longer prefix is looked up in one folder.
STEM = 3
MERGE_AT = 8
GONE_SHARE = 4
#: Documents whose rows one task makes, and how few are worth a task of their own.
DOCS_PER_TASK, FEW_DOCS = 8_000, 1_000


def folder_of(key: Column) -> Column:
    return (F.crc32(F.substring(key, 1, STEM).cast("binary")) % FOLDERS).cast("int")


def folder_number(key: str) -> int:
    return zlib.crc32(key[:STEM].encode()) % FOLDERS


@dataclass(frozen=True)
class Kind:
    """What an index holds: its name, the name of the key column, and the function that gives rows of documents (doc_id, text)."""

    name: str
    key: str
    build: Callable[[DataFrame], DataFrame]


class Index:
    """A kept index of one kind at a path that all executors share."""

    def __init__(self, spark: SparkSession, path: str, kind: Kind):
        self.spark, self.kind = spark, kind
        self.path = f"{path.rstrip('/')}/{kind.name}-{FORMAT}"
        self.snapshots = Snapshots(spark, self.path)

    # ---- snapshots

    def snapshot(self) -> dict:
        """The latest snapshot: its number, the names of its batches, how many documents they have and how many were replaced."""
        return self.snapshots.latest({"batches": [], "docs": {}, "gone": 0})

    def _publish(self, snapshot: dict) -> None:
        self.snapshots.publish(snapshot)

    # ---- reading

    def _table(self, table: str, batches: list[str], schema: str) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], f"{schema}, batch string")
        at = f"{self.path}/{table}"
        return self.spark.read.schema(f"{schema}, batch string").option("basePath", at).parquet(*[f"{at}/batch={b}" for b in batches])

    def _live(self, table: DataFrame, batches: list[str]) -> DataFrame:
        if len(batches) < 2:
            return table  # one batch replaces nothing of itself
        gone = self._table("gone", batches, "doc_id long, old string").select("doc_id", F.col("old").alias("batch"))
        return table.join(gone, ["doc_id", "batch"], "left_anti").select(table.columns)

    def known(self, batches: list[str] | None = None) -> DataFrame:
        """doc_id, mtime and batch of the documents that the index holds."""
        batches = self.snapshot()["batches"] if batches is None else batches
        return self._live(self._table("docs", batches, "doc_id long, mtime long"), batches)

    def docs(self, batches: list[str] | None = None) -> DataFrame:
        """doc_id, mtime, n_keys (the number of distinct keys, counted from the rows) and batch of the documents that the index holds."""
        n = self.rows(batches).groupBy("doc_id").agg(F.countDistinct(self.kind.key).alias("n_keys"))
        return self.known(batches).join(n, "doc_id", "left").select("doc_id", "mtime", F.coalesce("n_keys", F.lit(0)).alias("n_keys"), "batch")

    def rows(self, batches: list[str] | None = None) -> DataFrame:
        """The index's rows with their ``folder``, those replaced left out."""
        batches = self.snapshot()["batches"] if batches is None else batches
        return self._live(self._table("rows", batches, self._row_schema()), batches).drop("batch")

    # ---- writing

    def _tasks(self, n_docs: int) -> int:
        return max(1, -(-n_docs // DOCS_PER_TASK), min(self.spark.sparkContext.defaultParallelism, -(-n_docs // FEW_DOCS)))

    def _write_rows(self, rows: DataFrame, batch: str) -> None:
        """Each task writes the rows it has: a file a folder, in the order they come, which one sort by a small number gives."""
        rows = rows.withColumn("folder", folder_of(F.col(self.kind.key))).sortWithinPartitions("folder")
        rows.write.mode("overwrite").partitionBy("folder").parquet(f"{self.path}/rows/batch={batch}")

    def _write(self, table: str, rows: DataFrame, batch: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.path}/{table}/batch={batch}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{table}/batch={batch}")

    def refresh(self, docs: DataFrame) -> dict[str, int]:
        """Bring the index to ``docs`` (doc_id, text, mtime); how many documents were made anew and how many old ones went."""
        from shelfmark.operators.search import changed_docs

        now = self.snapshot()
        batch = f"{now['number'] + 1:09d}-{uuid.uuid4().hex[:8]}"
        docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("mtime").cast("long").alias("mtime"), "text")
        known = self.known(now["batches"])
        latest = docs.groupBy("doc_id").agg(F.max("mtime").alias("mtime"))
        changed = changed_docs(latest, known.select("doc_id", "mtime")) if now["batches"] else latest
        wanted = self._write("docs", changed.select("doc_id", "mtime"), batch)
        texts = docs.join(wanted.select(F.col("doc_id").alias("_id"), F.col("mtime").alias("_mtime")), (F.col("doc_id") == F.col("_id")) & F.col("mtime").eqNullSafe(F.col("_mtime")), "left_semi")
        kept = latest.join(wanted.select("doc_id"), "doc_id", "left_anti").select("doc_id")
        gone = self._write("gone", known.join(kept, "doc_id", "left_anti").select("doc_id", F.col("batch").alias("old")), batch)
        n_made, n_gone = wanted.count(), gone.count()
        if n_made or n_gone:
            # texts are dealt to tasks, not their many more rows
            self._write_rows(self.kind.build(texts.select("doc_id", "text").repartition(self._tasks(n_made), "doc_id")), batch)
            now = {"number": now["number"] + 1, "batches": [*now["batches"], batch], "docs": now["docs"] | {batch: n_made}, "gone": now["gone"] + n_gone}
            self._publish(now)
            self._merge_if_due(now)
        return {"made": n_made, "gone": n_gone}

    def _merge_if_due(self, now: dict) -> None:
        if now["gone"] * GONE_SHARE > sum(now["docs"].values()):
            self.merge(now["batches"])
        elif len(now["batches"]) > MERGE_AT:
            largest = max(now["batches"], key=lambda b: now["docs"][b])
            after = now["batches"][now["batches"].index(largest) + 1 :]
            self.merge(after if len(after) > 1 else now["batches"])

    def merge(self, batches: list[str]) -> None:
        """Write the live rows of these batches, the last of the index, as one batch in their place."""
        now = self.snapshot()
        rest = now["batches"][: len(now["batches"]) - len(batches)]
        if now["batches"][len(rest) :] != batches:
            raise ValueError("only the last batches can be merged")
        batch = f"{now['number'] + 1:09d}-{uuid.uuid4().hex[:8]}"
        live = self.known().where(F.col("batch").isin(batches)).select("doc_id", "mtime")
        n = self._write("docs", live, batch).count()
        old = self._table("gone", batches, "doc_id long, old string").where(F.col("old").isin(rest) if rest else F.lit(False))
        n_gone = self._write("gone", old.select("doc_id", "old"), batch).count()
        rows = self._live(self._table("rows", now["batches"], self._row_schema()), now["batches"]).where(F.col("batch").isin(batches)).drop("batch", "folder")
        self._write_rows(rows.repartition(self._tasks(n), "doc_id"), batch)
        held = {b: now["docs"][b] for b in rest}
        self._publish({"number": now["number"] + 1, "batches": [*rest, batch], "docs": held | {batch: n}, "gone": n_gone + (now["gone"] and self._table("gone", rest, "doc_id long, old string").count())})

    def _row_schema(self) -> str:
        plain = self.kind.build(self.spark.createDataFrame([], "doc_id long, text string")).schema
        return ", ".join([f"{x.name} {x.dataType.simpleString()}" for x in plain] + ["folder int"])
