"""Ranking, picking, sampling, ordering and set operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pick_canonical(files: DataFrame, priorities: dict[str, int], title_least: float = 0.5) -> DataFrame:
    """One file for each record that has a file of any size, with the method, its confidence and the reason.

    Empty files are dropped first. Evidence in order: a single file (confidence 1.0); equal hashes, nulls aside
    (1.0, by priority); a title score of at least ``title_least`` (that score, ties by priority); a unique
    largest file (0.8); the priority among the largest (0.6). Unknown sources come last; remaining ties go to
    the smallest instance_id. Two partial aggregations, by size and then by record, carry all of it, so a record
    with very many files is combined before it is shuffled. ``rejected_files`` lists the files that lost.
    """
    rank = F.lit(99)
    for name, value in priorities.items():
        rank = F.when(F.col("source") == name, value).otherwise(rank)
    f = files.where("size > 0").withColumns({"_p": rank, "_t": F.coalesce("title_score", F.lit(0.0))})
    row = F.struct("instance_id", "source", "path", "size", "sha256")
    by_size = f.groupBy("record_id", "size").agg(
        F.count("*").alias("n"), F.min("sha256").alias("h0"), F.max("sha256").alias("h1"),
        F.min(F.struct((-F.col("_t")).alias("t"), F.col("_p").alias("p"), F.col("instance_id").alias("i"), row.alias("row"))).alias("titled"),
        F.min(F.struct(F.col("_p").alias("p"), F.col("instance_id").alias("i"), row.alias("row"))).alias("first"),
    )
    g = by_size.groupBy("record_id").agg(
        F.sum("n").alias("n_files"), F.min("h0").alias("h0"), F.max("h1").alias("h1"), F.min("titled").alias("titled"), F.min("first").alias("first"),
        F.max_by("n", "size").alias("n_largest"), F.max_by("first", "size").alias("largest"),
    )
    method = (
        F.when(F.col("n_files") == 1, "single_instance").when(F.col("h0") == F.col("h1"), "duplicate_byte_identical")
        .when(-F.col("titled.t") >= title_least, "title_extract_match").when(F.col("n_largest") == 1, "size_largest").otherwise("source_priority")
    )
    m = F.col("method")
    chosen = F.when(m.isin("single_instance", "duplicate_byte_identical"), F.col("first.row")).when(m == "title_extract_match", F.col("titled.row")).otherwise(F.col("largest.row"))
    confidence = F.when(m.isin("single_instance", "duplicate_byte_identical"), 1.0).when(m == "title_extract_match", -F.col("titled.t")).when(m == "size_largest", 0.8).otherwise(0.6)
    g = g.withColumn("method", method).withColumns({"c": chosen, "confidence": confidence})
    why = F.concat_ws(" ", m, F.lit("from"), F.col("c.source"), F.lit("of"), F.col("n_files").cast("string"), F.lit("files"))
    return g.select("record_id", "c.*", "method", F.round("confidence", 6).alias("confidence"), why.alias("rationale"), "n_files", (F.col("n_files") - 1).alias("n_rejected"))


def rejected_files(files: DataFrame, picks: DataFrame) -> DataFrame:
    """record_id, instance_id and method for every non-empty file that its record's pick leaves out; one row a file."""
    chosen = picks.select("record_id", F.col("instance_id").alias("_chosen"), "method")
    return files.where("size > 0").join(chosen, "record_id").where("instance_id <> _chosen").select("record_id", "instance_id", "method")


def min_priority(files: DataFrame) -> DataFrame:
    """The window form of the canonical preview."""
    return files.withColumn("_m", F.min("priority").over(Window.partitionBy("record_id"))).where("priority = _m").drop("_m")


def first_row(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def first_wins(rows: DataFrame, keys: list[str], order: list) -> tuple[DataFrame, DataFrame]:
    """(the first row of each key, one row with the rows read, kept and dropped)."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    report = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("kept"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dropped"))
    return first_row(rows, keys, order), report


def best_nonzero(files: DataFrame) -> DataFrame:
    return first_row(files.where("size > 0"), ["record_id"], ["priority", "instance_id"])


def extra_paths(inventory: DataFrame) -> DataFrame:
    kept = Window.partitionBy("record_id", "source").orderBy(F.desc("path"))
    return inventory.withColumn("_rn", F.row_number().over(kept)).where("_rn > 1").drop("_rn")


def hash_order(seed: int, *cols: str) -> Column:
    """A seeded order that any engine with MD5 can repeat."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]).cast("binary"))


def stratified_sample(df: DataFrame, by: list[str], n: int, seed: int, key: str) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(hash_order(seed, key), key))).where(F.col("_rn") <= n).drop("_rn")


def sample_n(df: DataFrame, n: int, seed: int, key: str, drop_rate: float = 0.0) -> DataFrame:
    return df.orderBy(hash_order(seed, key), key).limit(round(n / (1 - drop_rate)))


def sample_mixed(df: DataFrame, condition: Column, n: int, seed: int, key: str) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return sample_n(df.where(hit), n // 2, seed, key).unionByName(sample_n(df.where(~hit), n - n // 2, seed, key))


def hash_slice(col: Column, m: int) -> Column:
    """SHA-256 of the text modulo m, exactly, eight hexadecimal digits at a time."""
    digest = F.sha2(col.cast("binary"), 256)
    return F.aggregate(F.sequence(F.lit(1), F.lit(57), F.lit(8)), F.lit(0).cast("long"), lambda a, i: (a * F.lit(1 << 32) + F.conv(F.substring(digest, i, F.lit(8)), 16, 10).cast("long")) % m)


def _number(col: str, kind: T.DataType) -> Column:
    """A number in the order of the column: itself, or the first seven bytes of a text."""
    if isinstance(kind, T.NumericType):
        return F.col(col).cast("double")
    return F.conv(F.rpad(F.hex(F.substring(F.encode(F.col(col).cast("string"), "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("double")


def global_rank(df: DataFrame, key: str, tie: str, descending: bool = False, buckets: int = 200) -> DataFrame:
    """``rank`` (from 1) of every row by a numeric key and then a tie column, without one task seeing all rows.

    Approximate quantiles of the key cut it into buckets, and those of the tie column cut a bucket of one key again; ranks inside a bucket are moved by
    the rows of the buckets before it. The cuts only deal out work: any cuts give the same ranks.
    """
    steps = [i / buckets for i in range(1, buckets)]
    tie_number = _number(tie, df.schema[tie].dataType)
    place = lambda cuts, x: F.coalesce(F.size(F.filter(cuts, lambda c: c <= x)), F.lit(-1))
    cuts = df.agg(F.percentile_approx(key, steps)).first()[0] or []
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    first = F.when(F.col(key).isNull(), F.lit(buckets)).otherwise((-place(cuts, F.col(key))) if descending else place(cuts, F.col(key)))
    rows = df.withColumn("_bucket", first)
    even = F.min(key).eqNullSafe(F.max(key))
    again = rows.groupBy("_bucket").agg(F.when(even, F.percentile_approx(tie_number, steps)).alias("_cuts"))
    rows = rows.join(F.broadcast(again), "_bucket").withColumn("_part", F.when(F.col("_cuts").isNull(), 0).otherwise(place(F.array_distinct("_cuts"), tie_number))).drop("_cuts")
    by_key = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    before = Window.orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("_bucket", "_part").agg(F.count("*").alias("_n")).select("_bucket", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_bucket", "_part").orderBy(by_key, tie))
    return rows.withColumn("_in", inside).join(F.broadcast(base), ["_bucket", "_part"]).withColumn("rank", F.col("_base") + F.col("_in")).drop("_bucket", "_part", "_base", "_in")


def every_kth(df: DataFrame, k: int, key: str) -> DataFrame:
    return global_rank(df, key, key).where((F.col("rank") - 1) % k == 0).select(*df.columns)


def select_tiered(candidates: DataFrame, excludes: DataFrame, n: int) -> DataFrame:
    """Tiers in order, within a tier a turn for each stratum by score, until n are chosen."""
    left = candidates.join(excludes.select("record_id"), "record_id", "left_anti")
    turn = Window.partitionBy("tier", "stratum").orderBy(F.desc("score"), "record_id")
    first = left.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= n)  # later turns can't be chosen; the plan cuts each stratum before its shuffle
    return first.orderBy("tier", "turn", F.desc("score"), "record_id").limit(n)


def make_blocks(records: DataFrame, cap: int) -> DataFrame:
    """block_id, year, org_code, n, bytes: blocks of at most ``cap`` records of one (year, org)."""
    rn = F.row_number().over(Window.partitionBy("year", "org_code").orderBy("record_id"))
    no = F.floor((rn - 1) / cap)
    named = records.withColumn("_no", no).withColumn("block_id", F.concat(F.lit("B-"), F.col("year").cast("string"), F.lit("-"), "org_code", F.when(F.col("_no") > 0, F.concat(F.lit("-"), F.lpad(F.col("_no").cast("string"), 2, "0"))).otherwise("")))
    return named.groupBy("block_id", "year", "org_code").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def order_blocks(blocks: DataFrame) -> DataFrame:
    """The blocks with ``rank``, smallest first."""
    return global_rank(blocks, "bytes", "block_id")


def first_success(attempts: DataFrame) -> DataFrame:
    """Each record's first good attempt in time, and how many came before it. Both steps combine before they shuffle."""
    at = F.struct("ts", "attempt_id")
    won = attempts.where("ok").groupBy("record_id").agg(F.min(F.struct("ts", "attempt_id", "source")).alias("w"))
    won = won.select("record_id", "w.source", F.struct("w.ts", "w.attempt_id").alias("first"))
    before = attempts.join(won, "record_id").where(at < F.col("first")).groupBy("record_id").agg(F.count("*").alias("n"))
    return won.join(before, "record_id", "left").select("record_id", "source", F.coalesce("n", F.lit(0)).alias("attempts_before"))


def consecutive_errors(attempts: DataFrame) -> DataFrame:
    """source, longest: the longest run of server errors.

    A source's days are looked at one by one, by gaps and islands; of a day only its length, its runs at both ends and its longest one go on,
    and a source's few days are joined in order.
    """
    rows = attempts.select("source", F.to_date("ts").alias("day"), "ts", "attempt_id", (F.col("http_status") >= 500).alias("bad"))
    order = Window.partitionBy("source", "day").orderBy("ts", "attempt_id")
    rows = rows.withColumn("a", F.row_number().over(order)).withColumn("b", F.row_number().over(Window.partitionBy("source", "day", "bad").orderBy("ts", "attempt_id")))
    runs = rows.groupBy("source", "day", "bad", (F.col("a") - F.col("b")).alias("island")).agg(F.count("*").alias("n"), F.min("a").alias("first"))
    days = runs.groupBy("source", "day").agg(
        F.sum("n").alias("n"), F.coalesce(F.max(F.when(F.col("bad"), F.col("n"))), F.lit(0)).alias("longest"),
        F.coalesce(F.max(F.when(F.col("bad") & (F.col("first") == 1), F.col("n"))), F.lit(0)).alias("head"), F.max(F.struct("first", F.when(F.col("bad"), F.col("n")).otherwise(0).alias("n")))["n"].alias("tail"),
    )
    each = F.array_sort(F.collect_list(F.struct("day", "n", "longest", "head", "tail")))
    start = F.struct(F.lit(0).cast("long").alias("longest"), F.lit(0).cast("long").alias("open"))
    step = lambda s, d: F.struct(
        F.greatest(s["longest"], d["longest"], s["open"] + d["head"]).alias("longest"), F.when(d["tail"] == d["n"], s["open"] + d["n"]).otherwise(d["tail"]).alias("open")
    )
    per = days.groupBy("source").agg(F.aggregate(each, start, step)["longest"].alias("longest"))
    return per.where("longest > 0")


def next_batch(queue: DataFrame, n: int) -> DataFrame:
    """The n pending items that wait longest; those without a time come last."""
    return queue.where("status = 'pending'").orderBy(F.col("enqueued_ts").asc_nulls_last(), "record_id").limit(n)


def cap_signals(signals: DataFrame, n: int) -> DataFrame:
    return signals.withColumn("_rn", F.row_number().over(Window.partitionBy("doc_id", "kind").orderBy("value"))).where(F.col("_rn") <= n).drop("_rn")


def plan_counts(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """step, n: the rows left after each further condition, counted in one pass."""
    held = F.lit(True)
    aggs = [F.count("*").alias("all")]
    for name, condition in steps:
        held = held & F.coalesce(condition, F.lit(False))
        aggs.append(F.count_if(held).alias(name))
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("step"), F.col(c).alias("n")) for c in one.columns])).alias("x")).select("x.step", "x.n")


def id_delta(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    new = b.select(key).distinct().join(a.select(key), key, "left_anti").withColumn("change", F.lit("new"))
    return new.unionByName(a.select(key).distinct().join(b.select(key), key, "left_anti").withColumn("change", F.lit("dropped")))


def intersection_rate(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    x = a.select(key).distinct().join(b.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return x.agg(F.count("*").alias("n"), F.count("_hit").alias("shared"), F.round(F.count("_hit") / F.count("*"), 6).alias("rate"))


def union_distinct(frames: list[DataFrame], key: str, order: list) -> DataFrame:
    allof = frames[0]
    for f in frames[1:]:
        allof = allof.unionByName(f)
    return first_row(allof, [key], order)


def union_report(frames: list[DataFrame], key: str, order: list) -> tuple[DataFrame, DataFrame]:
    """``union_distinct``, and one row with the rows read, kept and dropped."""
    allof = frames[0]
    for f in frames[1:]:
        allof = allof.unionByName(f)
    return first_wins(allof, [key], order)


def merge_disjoint(frames: list[DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """(the union, the keys that are not unique in it)."""
    allof = frames[0]
    for f in frames[1:]:
        allof = allof.unionByName(f)
    return allof, allof.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def basename_overlap(files: DataFrame) -> DataFrame:
    f = files.select(F.substring_index("path", "/", -1).alias("name"), F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    return f.groupBy("name").agg(F.countDistinct("folder").alias("folders")).where("folders >= 2")


def mixed_layout(files: DataFrame) -> DataFrame:
    return files.groupBy("source").agg(F.min(F.size(F.split("path", "/"))).alias("least_depth"), F.max(F.size(F.split("path", "/"))).alias("most_depth"))


def shape_divergence(sample: DataFrame, population: DataFrame, by: str, flag: float = 0.05) -> DataFrame:
    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(by).agg(F.count("*").alias("n"))
        return counts.select(by, (F.col("n") / F.sum("n").over(Window.partitionBy())).alias(name))

    j = shares(sample, "s").join(shares(population, "p"), by, "full").na.fill(0.0, ["s", "p"])
    return j.select(by, F.round("s", 6).alias("sample_share"), F.round("p", 6).alias("population_share"), (F.abs(F.col("s") - F.col("p")) > flag).alias("diverges"))


def smoke_gate(rate: Column) -> Column:
    """What a small first run allows: under 10 percent nothing, under 25 a run of low priority, else the full one."""
    return F.when(rate < 0.1, "stop").when(rate < 0.25, "low_priority").otherwise("full")


def orphan_cause(orphans: DataFrame, variants: DataFrame, first: int, last: int, share: float = 0.8) -> DataFrame:
    """n, cause: why held records are no candidates.

    ``few_cells`` if at most two (org, year) cells hold ``share`` of them, else ``org_variant`` if as many have an organisation listed in
    ``variants`` (org_code), else ``out_of_window`` if as many lie outside the years, else ``mixed``.
    """
    marked = orphans.join(variants.select("org_code", F.lit(1).alias("_v")).distinct(), "org_code", "left")
    cells = marked.groupBy("org_code", "year").agg(F.count("*").alias("n"), F.count("_v").alias("v"))
    cells = cells.withColumn("outside", F.when(~F.col("year").between(first, last), F.col("n")).otherwise(0)).withColumn("_k", F.lit(1))
    top = cells.orderBy(F.desc("n")).limit(2).groupBy("_k").agg(F.sum("n").alias("top"))
    one = cells.groupBy("_k").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("outside").alias("outside")).join(top, "_k")
    cause = (
        F.when(F.col("top") >= share * F.col("n"), "few_cells").when(F.col("v") >= share * F.col("n"), "org_variant")
        .when(F.col("outside") >= share * F.col("n"), "out_of_window").otherwise("mixed")
    )
    return one.select("n", cause.alias("cause"))


def gate(rate: Column) -> Column:
    return F.when(rate < 0.3, "stop").when(rate <= 0.5, "recoverable_strata_only").otherwise("all")
