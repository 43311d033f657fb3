"""Operator 4, mixing sources to target weights, with DataFrame functions only.

Each source's texts, in hash order, are packed into one stream of words, which is cut into blocks of equal length, to one word: as many
as blocks of BLOCK words would fill, but at least LEAST_BLOCKS if there are as many words, so that a part of a small source can be taken too. A source
gets as many slots as blocks make its target, so what it takes differs from that by half a block and by the odd words of blocks, whatever its size. All slots are put in output
shards of 1024. How many of a source's slots fall in which shard is drawn at random: the slots,
labelled with their sources, are put in the order of a hash and each run of 1024 is a shard. Every shard's source counts
are thus multinomial draws given that the totals meet the targets (draws without that condition leave a small
source several percent off). A source's slots, numbered over all shards, go through pseudorandom
permutations of its block indices, one permutation for each pass over the source, and slots and blocks are
joined by index. A document's ``taken`` words are the parts of it inside the blocks taken, with repeats.

A permutation is the order of its numbers by a keyed hash. No block is taken more than three times, as no target is over three times its source's size.

Slots and blocks grow with the corpus, so they are dealt out by source and run before they are listed, and
their join is a sorted merge, never a broadcast. One row a source is sorted in one task for places and targets.

Running sums go over buckets of a source first and then inside a bucket, so that a source with a third of all
rows is still spread over many tasks. A bucket is a range of the hash that gives the order, so there can be as many as the rows ask for
(one for about BUCKET_ROWS rows): their number doesn't change the result.

Cases: a null or empty text has size 0 and takes nothing; a null source is a source like others and the last
in order; rows that are equal in every way share their words' places in any order, so their results
are the same as a set; an empty table gives no rows; other columns are left aside, and ``mixed_documents`` hands
them through whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
BLOCK, LEAST_BLOCKS = 64, 32
SHARD_SLOTS = 1024
BUCKET_ROWS = 20_000
HASH_BITS = 60
SHARD_GROUP = 4096
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
RUN = 65_536


def hashed(*parts: str | Column) -> Column:
    """A number below 2**60 from the MD5 of the parts, nulls told apart."""
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("\\N")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols).cast("binary")), 1, 15), 16, 10).cast("long")


def bucket_bits(rows: int) -> int:
    """How many leading bits of the hash make a bucket of about BUCKET_ROWS of ``rows`` rows."""
    return min(24, max(4, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS))))


def bucketed(rows: DataFrame, mark: Column, bits: int) -> DataFrame:
    """``rows`` with ``mark``, which gives the order, and ``bucket``, a range of it."""
    return rows.withColumn("mark", mark).withColumn("bucket", F.shiftright("mark", HASH_BITS - bits))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """source, source_size, n and target of every source.

    Shares by weight fill like water: in the order of cap to weight, a source is capped when the level that
    the sources before it leave would lift it over its cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("place", F.row_number().over(order) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    per = per.withColumn("ratio", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    upto = level.rowsBetween(Window.unboundedPreceding, -1)
    total, weight = F.sum("source_size").over(all_rows), F.sum("weight").over(all_rows)
    left = total - most * F.coalesce(F.sum("source_size").over(upto), F.lit(0))
    per = per.withColumn("level", left / (weight - F.coalesce(F.sum("weight").over(upto), F.lit(0))))
    per = per.withColumn("free", F.col("ratio") > F.col("level"))
    first = F.min(F.when(F.col("free"), F.struct("ratio", "place", "level"))).over(all_rows)["level"]
    target = F.when(F.col("free"), F.col("weight") * first).otherwise(F.lit(float(most)) * F.col("source_size"))
    return per.withColumn("target", F.coalesce(target, F.lit(0.0))).select("source", "place", "source_size", "target")


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and start: where the document's words begin in its source's stream."""
    rows = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("crc"))
    rows = staged(rows, "mix-sizes")
    rows = bucketed(rows, hashed("doc_id"), bucket_bits(rows.count()))
    per = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("source", "bucket", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("mark", "doc_id", "size", "crc").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = rows["source"].eqNullSafe(per["source"]) & (rows["bucket"] == per["bucket"])
    return rows.join(per, same).select("doc_id", rows["source"], "size", (F.col("base") + F.col("inside")).alias("start"))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(rows: DataFrame, by: list[str], number: str, name: str, bits: int) -> DataFrame:
    """``rows`` with ``rank``: the place, from 0, of ``number`` in the pseudorandom order of its group that ``name`` and the group name."""
    rows = bucketed(rows, hashed(F.lit(name), *by, number), bits)
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(*by, "bucket").agg(F.count("*").alias("in_bucket")).select(*by, "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy(*by, "bucket").orderBy("mark", number)) - 1
    return rows.withColumn("inside", inside).join(base.hint("merge"), [*by, "bucket"]).withColumn("rank", F.col("base") + F.col("inside")).drop("mark", "bucket", "base", "inside")


def _listed(rows: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """A row for every number from ``first`` to before ``last``, dealt out in runs."""
    # a few rows become many here, which Spark's size estimate doesn't see
    runs = rows.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col(last) - F.col(first) - 1) / RUN)))).repartition(_tasks(rows), "place", "run")
    begin = F.col(first) + F.col("run") * RUN
    return runs.withColumn(name, F.explode(F.sequence(begin, F.least(begin + RUN, F.col(last)) - 1))).drop("run")


def n_blocks(size: Column, block: int = BLOCK) -> Column:
    """How many blocks a source of so many words is cut into."""
    return F.greatest(F.ceil(size / block), F.least(size, F.lit(LEAST_BLOCKS))).cast("long")


def block_of(word: Column, size: Column, n: Column) -> Column:
    """The block that holds a word (from 0) of a source: the first ``size % n`` blocks are a word longer than the others."""
    least, longer = F.floor(size / n), F.pmod(size, n)
    head = longer * (least + 1)
    return F.when(word < head, F.floor(word / (least + 1))).otherwise(longer + F.floor((word - head) / least)).cast("long")


def block_start(index: Column, size: Column, n: Column) -> Column:
    return (index * F.floor(size / n) + F.least(index, F.pmod(size, n))).cast("long")


def source_slots(targets: DataFrame, block: int = BLOCK, most: int = MOST_PASSES) -> DataFrame:
    """place, n (blocks), low, high: the labels of each source's slots among all slots (sources without slots left out)."""
    along = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    t = targets.where("source_size > 0").withColumn("n", n_blocks(F.col("source_size"), block))
    t = t.withColumn("slots", F.least(most * F.col("n"), F.floor(F.col("target") * F.col("n") / F.col("source_size") + 0.5)).cast("long"))
    t = t.withColumn("high", F.sum("slots").over(along)).withColumn("low", F.col("high") - F.col("slots"))
    return t.select("place", "n", "low", "high").where("high > low")


def slot_counts(slots: DataFrame, shard_slots: int = SHARD_SLOTS, bits: int = 12) -> DataFrame:
    """place, shard, slots: the drawn source counts of every output shard."""
    labels = _listed(slots.select("place", "low", "high"), "low", "high", "label").select(F.lit(0).alias("all"), "place", "label")
    return ranked(labels, ["all"], "label", "draw", bits).groupBy("place", F.floor(F.col("rank") / shard_slots).alias("shard")).agg(F.count("*").alias("slots"))


def slot_blocks(slots: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """place, shard, k, index: every slot of every output shard, its number among its source's slots and the block it takes."""
    slots = staged(slots, "mix-slots")
    bits = bucket_bits(slots.agg(F.sum(F.col("high") - F.col("low"))).first()[0] or 0)
    counts = staged(slot_counts(slots, shard_slots, bits).withColumn("group", F.floor(F.col("shard") / SHARD_GROUP)), "mix-counts")
    before = Window.partitionBy("place").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.groupBy("place", "group").agg(F.sum("slots").alias("in_group")).select("place", "group", F.coalesce(F.sum("in_group").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("place", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("inside", F.coalesce(F.sum("slots").over(inside), F.lit(0))).join(base, ["place", "group"])
    first = F.col("base") + F.col("inside")
    numbered = counts.repartition(_tasks(counts), "place", "shard").select("place", "shard", F.explode(F.sequence(first, first + F.col("slots") - 1)).alias("k"))

    wanted = slots.withColumn("wanted", F.col("high") - F.col("low")).withColumn("zero", F.lit(0).cast("long"))
    blocks = _listed(wanted.select("place", "n", "wanted", "zero"), "zero", "n", "index")
    passes = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0), F.floor((F.col("wanted") - 1) / F.col("n")))))
    order = ranked(passes.select("place", "pass", "index", "n"), ["place", "pass"], "index", "block", bits)
    order = order.select("place", (F.col("pass") * F.col("n") + F.col("rank")).alias("k"), "index")
    return numbered.join(order.hint("merge"), ["place", "k"])


def block_passes(targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, most: int = MOST_PASSES) -> DataFrame:
    """place, index, times: how often each block of each source is taken; blocks never taken are left out."""
    return slot_blocks(source_slots(targets, block, most), shard_slots).groupBy("place", "index").agg(F.count("*").alias("times"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source, source_size, target and taken of every document."""
    rows = staged(placed(docs), "mix-placed")
    targets = staged(source_targets(rows), "mix-targets")
    passes = block_passes(targets, block)
    known = targets.select(F.col("source").alias("s"), "place", "source_size", "target", n_blocks(F.col("source_size"), block).alias("n"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows.join(known, rows["source"].eqNullSafe(known["s"])).drop("s"), "mix-rows")
    end, cut = F.col("start") + F.col("size"), (F.col("source_size"), F.col("n"))
    parts = rows.where("size > 0").select("row", "place", "start", end.alias("end"), "source_size", "n", F.explode(F.sequence(block_of(F.col("start"), *cut), block_of(end - 1, *cut))).alias("index"))
    words = F.least(F.col("end"), block_start(F.col("index") + 1, *cut)) - F.greatest(F.col("start"), block_start(F.col("index"), *cut))
    parts = parts.select("row", "place", "index", words.alias("words"))
    taken = parts.join(passes.hint("merge"), ["place", "index"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return rows.join(taken, "row", "left").select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix repeats them: each stands ``taken`` / ``size`` times, a fraction by the hash of its id.

    The number of copies of a document has the expected value taken / size, so each source's words keep to its target
    while texts stay whole; a document without words stays once. Rows of one doc_id share their average.
    """
    per = mix(docs).groupBy("doc_id").agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("passes"))
    copies = F.when(F.col("passes").isNull(), 1).otherwise(F.floor(F.col("passes") + hashed(F.lit("copy"), "doc_id") / float(1 << 60)).cast("int"))
    per = per.select(F.col("doc_id").alias("mixed_id"), copies.alias("copies")).where("copies > 0")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # so that no name can clash
    joined = plain.join(per, plain[f"c{docs.columns.index('doc_id')}"].eqNullSafe(per["mixed_id"]))
    repeated = joined.select(*plain.columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"))
    return repeated.select(*plain.columns).toDF(*docs.columns)
