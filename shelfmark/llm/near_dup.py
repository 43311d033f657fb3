"""Operator 10, near-duplicates by MinHash and odd sketches.

Each text becomes its set of distinct shingles (five words; with fewer, the whole sequence). Texts with the
same set form one class and only the class goes on. From 128 MinHash samples, 80 make 20 bands of 4 (for thresholds
below 85 percent all make 32 bands), whose equality proposes candidates; all 128 fold into an odd sketch of 512 bits, in which each (place, sample)
flips one bit. The number of ones in the XOR of two sketches estimates their similarity, most precisely
where it is high, and candidates far below the threshold go before any set is read. The rest are confirmed
on full sets by integer arithmetic.

A band's bucket never expands into all its pairs. Its members are first compared with one leader each (of
four differently ordered leaders over the bands), and confirmed links are merged into components. A second
pass takes the classes of buckets whose members, the leader aside, still lie in different components, and finds
all pairs of them that can reach the threshold by an exact prefix filter, rare shingles first, so that texts which
only share a base or a passage don't meet; again first with one leader for each shingle, then all pairs of
parts that are still apart and of sizes that can reach the threshold. A pair that all passes leave out shares a component or no
bucket, so components are those of all links that banding can find: a pair at similarity 0.85 shares none of
20 bands with probability 4e-7, one at 0.8 none of 32 with 5e-8. The ones in the XOR of a pair at the threshold exceed their
expected number (35 at 0.85, 46 at 0.8) by the allowed margin of 57 with a probability below 1e-9.

Buckets and shingles that more than one in HOT_MOST rows hold, of which there are fewer than HOT_MOST, are joined by a broadcast
of their one row each, so that a large group isn't dealt to one task; the others join by a shuffle. The tables
between the steps are removed when the result is written.

Cases: a null or empty text, or one of separators only, has an empty set and links with nothing; rows with one
doc_id count as one document; a null doc_id has a null component, is kept and links with nothing; an empty
table gives no rows; other columns are left aside. Memory follows the longest text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import textkit as tk
from shelfmark.llm.staging import Scratch

SHINGLE = 5
PERCENT = 85
SAMPLES, BANDS, ROWS = 128, 20, 4
SKETCH_BITS = 512
LEADER_ORDERS = 4
IDS_MOST = 1_000_000
HOT_MOST, HOT_LEAST = 10_000, 100

_rule = tk.mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
_FACTOR = ((_rule[:SAMPLES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
_SHIFT = (_rule[SAMPLES:] >> np.uint64(32)).astype(np.uint32)[:, None]
_PLACE = tk.mix(np.arange(1000, 1000 + SAMPLES, dtype=np.uint64))


def most_ones(percent: int = PERCENT) -> int:
    """How many ones the XOR of two sketches may have for the pair to be read: the expected number at the threshold and a margin."""
    flips = 2 * SAMPLES * (100 - percent) / 100
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** flips)) + 57


MOST_ONES = most_ones()


def n_bands(percent: int) -> int:
    return BANDS if percent >= PERCENT else SAMPLES // ROWS


def _samples(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each of the hash functions over one set."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        values = short[at : at + 2048] * _FACTOR
        values += _SHIFT
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        np.minimum(least, values.min(axis=1), out=least)
    return least


def _odd_sketch(samples: np.ndarray) -> np.ndarray:
    bits = tk.mix(_PLACE ^ samples.astype(np.uint64)) % np.uint64(SKETCH_BITS)
    parity = (np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for s in tk.slices(batch.column("text")):
        starts, ends, first = tk.word_bounds(s)
        words = tk.word_hashes(s, starts, ends)
        for i in range(len(s)):
            yield tk.shingle_set(words[first[i] : first[i + 1]], SHINGLE)


def _signatures(batches: Iterator[pa.RecordBatch], n_bands: int = BANDS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, first, second, bands, sketches = [], [], [], [], []
        for shingles in _sets(batch):
            sizes.append(len(shingles))
            if not len(shingles):
                first.append(0), second.append(0), bands.append(np.zeros(0, np.int64)), sketches.append(np.zeros(0, np.int64))
                continue
            samples = _samples(shingles)
            rows = tk.mix(samples[: n_bands * ROWS].astype(np.uint64)).reshape(n_bands, ROWS)
            key = rows[:, 0]
            for j in range(1, ROWS):
                key = tk.mix(key * np.uint64(3) ^ rows[:, j])
            with np.errstate(over="ignore"):
                first.append(int(tk.mix(shingles).sum().view(np.int64)))
                second.append(int(tk.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)))
            bands.append(key.view(np.int64))
            sketches.append(_odd_sketch(samples))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), tk.long_list(bands), tk.long_list(sketches)],
            names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), tk.long_list(list(_sets(batch)))], names=["doc_id", "shingles"])


def matched(rows: DataFrame, key: str, table: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row a key and in ``n`` how many of ``rows`` hold it (keys held once may be missing)."""
    total = table.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(table.where(F.col("n") > max(HOT_LEAST, total // HOT_MOST)))
    few = rows.join(hot.select(key), key, "left_anti").join(table, key, how)
    return few.unionByName(rows.join(hot, key))


def connected_components(edges: DataFrame, owner: Scratch | None = None) -> DataFrame:
    """(node, component) with the smallest node reachable, for every node of the edges (u, v).

    Large-star and small-star steps take turns; each is one grouping and one join, written out, until a
    round leaves the edges as they were. Nothing but two numbers a round reaches the driver. The last edges stay
    in the shared folder, for ``owner`` to remove.
    """
    scratch = Scratch(edges.sparkSession)

    def star(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u"), least

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = scratch.staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both)[0].where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.staged(large, "large-star")
        joined, least = star(large)
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = scratch.staged(small.where("u <> v").distinct(), "small-star")
        scratch.clear(keep=1)
        after = mark(now)
        if after == before:
            break
        before = after
    if owner:
        owner.paths += scratch.paths
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class _Run:
    """One run over ``docs`` (doc_id, text): its threshold and its tables."""

    def __init__(self, docs: DataFrame, percent: int):
        self.docs, self.percent = docs, percent
        self.scratch = Scratch(docs.sparkSession)
        self.staged = self.scratch.staged

    def confirmed(self, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the threshold; the sketches of both sides are looked at first."""
        near = pairs.join(sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na")), "a")
        near = near.join(sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb")), "b")
        ones = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
        fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent
        near = self.staged(near.where(fits & (ones <= most_ones(self.percent))).select("a", "b"), "near-pairs")
        full = self.sets_of(near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))))
        both = near.join(full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a").join(full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
        shared = both.select("a", "b", (F.size("sa") + F.size("sb")).alias("total"), F.size(F.array_intersect("sa", "sb")).alias("shared"))
        return shared.where(F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * self.percent).select(F.col("a").alias("u"), F.col("b").alias("v"))

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """doc_id and shingles of the wanted documents; their ids go to all tasks only if counted as few."""
        wanted = self.staged(wanted.select("doc_id").distinct(), "wanted")
        few = wanted.count() <= IDS_MOST
        texts = self.docs.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
        return self.staged(texts.mapInArrow(_full_sets, "doc_id long, shingles array<long>"), "shingle-sets")

    def prefixes(self, classes: DataFrame) -> DataFrame:
        """token, rep, size, at: the shingles by which ``classes`` (rep) of different texts can reach the threshold.

        Shingles are ordered from rare to frequent. Two sets of n <= m shingles at the threshold t share one among
        the first n(1 - t)/(1 + t) of the smaller and the first m(1 - t) of the larger.
        """
        full = self.sets_of(classes.select(F.col("rep").alias("doc_id")))
        tokens = full.select(F.col("doc_id").alias("rep"), F.size("shingles").alias("size"), F.explode("shingles").alias("token"))
        held = self.staged(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "held-twice")
        order = Window.partitionBy("rep", "size").orderBy(F.coalesce("n", F.lit(1)), "token")
        ranked = matched(tokens, "token", held, "left").withColumn("at", F.row_number().over(order) - 1)
        ranked = ranked.where(F.col("at") * 100 <= F.col("size") * (100 - self.percent)).where("n > 1").select("token", "rep", "size", "at")
        return self.staged(ranked, "prefixes")

    def parts(self, classes: DataFrame, links: DataFrame) -> DataFrame:
        """rep and part: its component under ``links``, else itself."""
        labels = self.staged(connected_components(links, self.scratch), "components").withColumnsRenamed({"node": "rep"})
        return classes.select("rep").join(labels, "rep", "left").select("rep", F.coalesce("component", "rep").alias("part"))

    def star_pairs(self, prefixes: DataFrame) -> DataFrame:
        """Each shingle's classes with the one in which it stands first (which has the fewest rare ones), if their parts differ."""
        prefixes = self.staged(prefixes, "prefix-parts")
        leader = prefixes.groupBy("token").agg(F.min_by(F.struct("rep", "part"), F.struct("at", "rep")).alias("x"), F.count("*").alias("n"))
        leader = self.staged(leader.where("n > 1").select("token", F.col("x.rep").alias("leader"), F.col("x.part").alias("its"), "n"), "token-leaders")
        pairs = matched(prefixes, "token", leader).where("part <> its")
        return pairs.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()

    def prefix_pairs(self, prefixes: DataFrame) -> DataFrame:
        """All pairs of different parts that meet in a shingle and have enough left behind it on both sides.

        For each shingle only pairs with a member outside its largest part are looked at, and only those whose sizes stand in
        neighbouring steps of a scale on which a step is the most that sizes may differ.
        """
        sizes = prefixes.groupBy("token", "part").agg(F.count("*").alias("k"))
        main = sizes.groupBy("token").agg(F.max_by("part", F.struct("k", "part")).alias("main"), F.count("*").alias("parts"), F.sum("k").alias("n")).where("parts > 1")
        main = self.staged(main.select("token", "main", "n"), "main-parts")
        step = F.floor(F.log(F.col("size").cast("double")) / (math.log(100 / self.percent) * 1.0001)).cast("int")
        rows = self.staged(matched(prefixes, "token", main).drop("n").withColumn("step", step), "open-prefixes")
        outside = rows.where("part <> main")

        def pairs(small: DataFrame, large: DataFrame) -> DataFrame:
            x = small.where(F.col("at") * (100 + self.percent) <= F.col("size") * (100 - self.percent))
            x = x.select("token", F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("step"), *[F.col(c).alias(f"x_{c}") for c in ("rep", "size", "at", "part")])
            y = large.select("token", "step", *[F.col(c).alias(f"y_{c}") for c in ("rep", "size", "at", "part")])
            fits = F.expr(
                f"x_part <> y_part and (x_size < y_size or (x_size = y_size and x_rep < y_rep)) and x_size * 100 >= y_size * {self.percent}"
                f" and least(x_size - x_at, y_size - y_at) * {100 + self.percent} >= (x_size + y_size) * {self.percent}"
            )
            return x.join(y, ["token", "step"]).where(fits).select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b"))

        return pairs(outside, rows).unionByName(pairs(rows, outside)).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id long, text string)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    run = _Run(docs, percent)
    staged, bands = run.staged, n_bands(percent)
    shape = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"
    marks = staged(docs.mapInArrow(lambda batches: _signatures(batches, bands), shape), "signatures")
    held = marks.where("n_shingles > 0 and doc_id is not null")
    key = ["set_a", "set_b", "n_shingles"]
    classes = staged(
        held.groupBy(*key).agg(F.min_by(F.struct("doc_id", "bands", "sketch"), "doc_id").alias("x")).select(*key, F.col("x.doc_id").alias("rep"), "x.bands", "x.sketch"),
        "classes",
    )
    rows = classes.select("rep", F.posexplode("bands").alias("band", "value")).select("rep", "band", F.xxhash64("band", "value").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("rep", F.xxhash64("rep", F.col("band") % LEADER_ORDERS)).alias("leader")).where("n > 1")
    members = staged(matched(rows, "bucket", staged(shared, "bucket-leaders")).select("bucket", "leader", "rep"), "buckets")
    first = members.where("rep <> leader").select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
    links = staged(run.confirmed(first, classes), "links")

    part = staged(members.where("rep <> leader").select("bucket", "rep").join(run.parts(classes, links), "rep"), "bucket-parts")
    open_ = part.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n")).where("low <> high")
    open_ = staged(matched(part, "bucket", staged(open_.select("bucket", "n"), "open-buckets")).select("rep", "part").distinct(), "open-classes")
    prefixes = run.prefixes(open_)
    second = staged(run.star_pairs(prefixes.join(open_, "rep")).join(first, ["a", "b"], "left_anti"), "second-pairs")
    links = staged(links.unionByName(run.confirmed(second, classes)), "links")
    third = run.prefix_pairs(staged(prefixes.join(run.parts(open_, links), "rep"), "prefix-parts"))
    third = staged(third.join(first.unionByName(second), ["a", "b"], "left_anti"), "third-pairs")
    more = staged(run.confirmed(third, classes), "links")

    linked = connected_components(links.unionByName(more).unionByName(_shared_ids(held, classes, key)), run.scratch)
    named = classes.select(*key, "rep").join(linked.withColumnsRenamed({"node": "rep"}), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    found = marks.select("doc_id", *key).join(named, key, "left")
    found = found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id")).alias("component_id"))
    out = Scratch(docs.sparkSession).staged(found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "near-duplicates")
    run.scratch.clear()
    return out


def _shared_ids(held: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
    """Links between the classes of rows that share one doc_id."""
    ids = held.select("doc_id", *key).distinct().groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    own = held.join(ids, "doc_id", "left_semi").join(classes.select(*key, "rep"), key)
    return own.select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those that a smaller doc_id of their component stands for."""
    gone = near_duplicates(docs, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    at = docs.columns.index("doc_id")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # so that no name can clash
    return plain.join(gone, F.col(f"c{at}") == F.col("_gone"), "left_anti").toDF(*docs.columns)
