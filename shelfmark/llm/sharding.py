"""Operator 1, sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots; bytes and rows are summed per slot; a versioned map sends
slots to shards. Rebalancing edits the map, moving whole slots from the heaviest shard to the lightest, and
gives it the next version: no record is hashed anew. A store keeps every version under its own folder; the latest
is the map in force, and a version is added only where the map was edited. Only the per-slot sums (one row per virtual slot, a
number that is a parameter) reach the driver, and only the map is broadcast.

Cases: a null text has no bytes and the checksum of the empty text; a null id hashes by its checksum; equal
rows share a virtual slot and get neighbouring positions; an empty table gives no rows; other columns are
left aside by ``assign_shards`` and may have any names.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.staging import file_system, shared_folder

SLOTS = 4096
SHARDS = 16


@dataclass(frozen=True)
class SlotMap:
    """Which shard each virtual slot belongs to, and the version of that choice."""

    version: int
    n_shards: int
    shard_of: tuple[int, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, slot, shard) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "version int, virtual_slot int, shard int")


def first_map(n_shards: int = SHARDS, n_slots: int = SLOTS) -> SlotMap:
    return SlotMap(0, n_shards, tuple(slot % n_shards for slot in range(n_slots)))


def rebalanced(old: SlotMap, slot_bytes: dict[int, int], n_shards: int | None = None) -> SlotMap:
    """The next version of ``old``: slots move from the heaviest to the lightest shard while that evens them out.

    With more shards than before, the new ones start empty and fill by the same moves, so no slot moves
    between two old shards that are already even.
    """
    n = n_shards or old.n_shards
    shard_of = [shard if shard < n else slot % n for slot, shard in enumerate(old.shard_of)]
    held: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for slot, shard in enumerate(shard_of):
        held[shard].append((slot_bytes.get(slot, 0), slot))
    for own in held:
        own.sort()
    load = [sum(size for size, _ in own) for own in held]
    heavy = [(-size, shard) for shard, size in enumerate(load)]
    heapq.heapify(heavy)
    while heavy:
        size, top = heapq.heappop(heavy)
        if -size != load[top]:
            continue
        low = min(range(n), key=lambda shard: (load[shard], shard))
        gap = load[top] - load[low]
        fit = min((x for x in held[top] if 0 < x[0] < gap), key=lambda x: (abs(2 * x[0] - gap), x), default=None)
        if fit is None:
            break
        held[top].remove(fit)
        held[low].append(fit)
        shard_of[fit[1]] = low
        load[top] -= fit[0]
        load[low] += fit[0]
        for shard in (top, low):
            heapq.heappush(heavy, (-load[shard], shard))
    return SlotMap(old.version + 1, n, tuple(shard_of))


def slotted(docs: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1 more), text_crc32 and virtual_slot of every record."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_slots)).cast("int"))


def latest_map(spark: SparkSession, map_path: str) -> SlotMap | None:
    """The last version that a store holds whole; none if it has none."""
    system, place = file_system(spark, f"{map_path}/version=*/_SUCCESS")
    found = system.globStatus(place) or []
    versions = [int(x.getPath().getParent().getName().split("=")[1]) for x in found]
    if not versions:
        return None
    rows = spark.read.parquet(f"{map_path}/version={max(versions)}").collect()
    shard_of = {x["virtual_slot"]: x["shard"] for x in rows}
    return SlotMap(max(versions), rows[0]["n_shards"], tuple(shard_of[slot] for slot in range(len(shard_of))))


def store_map(spark: SparkSession, new: SlotMap, map_path: str) -> None:
    """Adds a version to the store; one that is there already is an error."""
    rows = new.frame(spark).drop("version").withColumn("n_shards", F.lit(new.n_shards))
    rows.coalesce(1).write.parquet(f"{map_path}/version={new.version}")


def assign_shards(docs: DataFrame, old: SlotMap | None = None, n_shards: int = SHARDS, n_slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Every record's shard under the map rebalanced for these bytes, and its position in that shard.

    The map in force is ``old``, else the latest of the store ``map_path``, else the first map. Where rebalancing
    edits it, or the store has no version, the new one is stored (in a store of this run's own, if no path is given).
    Positions run from 0 in each shard without a gap.
    """
    spark = docs.sparkSession
    store = map_path or f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    stored = latest_map(spark, store)
    old = old or stored or first_map(n_shards, n_slots)
    rows = slotted(docs, len(old.shard_of))
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    new = rebalanced(old, {x["virtual_slot"]: x["bytes"] for x in sums}, n_shards)
    if stored and (new.shard_of, new.n_shards) == (stored.shard_of, stored.n_shards):
        new = stored
    else:
        new = replace(new, version=max(new.version, stored.version + 1 if stored else 0))
        store_map(spark, new, store)
    count = {x["virtual_slot"]: x["rows"] for x in sums}
    filled, base = [0] * n_shards, []
    for slot, shard in enumerate(new.shard_of):
        base.append((slot, shard, filled[shard], new.version))
        filled[shard] += count.get(slot, 0)
    plan = spark.createDataFrame(base, "virtual_slot int, shard int, base long, map_version int")
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(order) - 1)
        .join(F.broadcast(plan), "virtual_slot")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place")).alias("slot"), "virtual_slot", "map_version")
    )


def shard_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns; the law is ``bytes``."""
    return assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version"
    )


__all__ = ["SlotMap", "assign_shards", "first_map", "latest_map", "rebalanced", "shard_digest", "slotted", "store_map"]
