"""Aggregated reports over catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import ids
from shelfmark.functions.text import DEPOSITS, RUNNABLE


def snapshot(records: DataFrame, files: DataFrame) -> DataFrame:
    r = records.agg(
        F.count("*").alias("records"), F.count_if(~ids.no_doi(F.col("doi"))).alias("with_doi"), F.count_if(ids.no_doi(F.col("doi"))).alias("without_doi"),
        F.count_if(F.col("has_file") | F.col("canonical_path").isNotNull()).alias("with_file"), F.countDistinct("canonical_path").alias("canonical_paths"),
    )
    r = r.withColumn("missing", F.col("records") - F.col("with_file")).withColumn("coverage", F.round(100.0 * F.col("with_file") / F.col("records"), 2))
    f = files.agg(F.count("*").alias("files"), F.countDistinct("record_id").alias("records_with_files"))
    return r.withColumn("_k", F.lit(1)).join(f.withColumn("_k", F.lit(1)), "_k").drop("_k")


def top_counts(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(col).asc_nulls_last()).limit(n)


def counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def distinct_by_year(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy(F.coalesce(F.col("year").cast("string"), F.lit("UNKNOWN")).alias("year")).agg(F.countDistinct("record_id").alias("n"))


def coverage_matrix(records: DataFrame) -> DataFrame:
    """org, year, n, held, percent, with the totals of each org, each year and all."""
    cube = records.cube("org_code", "year").agg(F.count("*").alias("n"), F.count_if("has_file").alias("held"), F.grouping("org_code").alias("all_orgs"), F.grouping("year").alias("all_years"))
    return cube.withColumn("percent", F.round(100.0 * F.col("held") / F.col("n"), 2))


def source_overlap(files: DataFrame) -> DataFrame:
    return files.groupBy("record_id").agg(F.countDistinct("source").alias("sources")).groupBy("sources").agg(F.count("*").alias("n"))


def dup_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("source").agg(F.count("*").alias("rows"), F.countDistinct("record_id").alias("ids"), (F.count("*") - F.countDistinct("record_id")).alias("extra"))


def multi_instance(files: DataFrame) -> DataFrame:
    return files.groupBy("record_id").agg(F.count("*").alias("n")).where("n >= 2")


def no_doi_profile(records: DataFrame) -> DataFrame:
    """Records without a DOI by type, decade and organisation; those before 2000 are of the time before DOIs."""
    rows = records.where(ids.no_doi(F.col("doi"))).withColumn("decade", (F.floor(F.col("year") / 10) * 10).cast("int"))
    return rows.groupBy("product_type", "decade", "org_code").agg(F.count("*").alias("n")).withColumn("pre_doi", F.coalesce(F.col("decade") < 2000, F.lit(False)))


def failure_by_org(status: DataFrame, classes: tuple[str, ...] = ("good", "image", "truncated", "zero")) -> DataFrame:
    rolled = status.rollup("org_code").agg(F.count("*").alias("have"), *[F.count_if(F.col("status") == c).alias(c) for c in classes], F.grouping("org_code").alias("g"))
    name = F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("org_code"))
    return rolled.select(name.alias("org_code"), "have", *classes, F.round(100.0 * F.col("good") / F.col("have"), 2).alias("good_percent"))


def outcome_rates(attempts: DataFrame, by: list[str]) -> DataFrame:
    n = attempts.groupBy(*by, "bucket").agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*by)), 4))


def findability_data(docs: DataFrame, validated: DataFrame) -> DataFrame:
    """Verdict of each data card; doc_id, kind, ok, resource_type rows in ``validated``."""
    v = validated.groupBy("doc_id").agg(
        F.count("*").alias("signals"), F.count_if("ok").alias("resolved"),
        F.count_if(F.col("ok") & (F.col("kind").isin(*DEPOSITS) | F.col("resource_type").isin("Dataset", "Collection"))).alias("strong"),
        F.count_if(F.col("ok") & (F.col("kind") == "doi")).alias("dois"),
    )
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    verdict = F.when(n("signals") == 0, "NO_SIGNALS").when(n("strong") > 0, "FOUND_DEPOSIT").when(n("resolved") > 0, "FOUND_DOI_ONLY").otherwise("BROKEN_SIGNALS")
    return docs.select("doc_id").join(v, "doc_id", "left").select("doc_id", n("signals").alias("signals"), n("resolved").alias("resolved"), verdict.alias("verdict"))


def findability_code(docs: DataFrame, validated: DataFrame) -> DataFrame:
    """Verdict of each code, model or agent card; rows of kind ``name_search`` aren't signals."""
    real = F.col("kind") != "name_search"
    v = validated.groupBy("doc_id").agg(
        F.count_if(real).alias("signals"), F.count_if(F.col("ok") & real).alias("resolved"),
        F.count_if(F.col("ok") & (F.col("kind").isin(*RUNNABLE) | F.col("resource_type").isin("Software", "Model"))).alias("runnable"),
        F.count_if(F.col("ok") & (F.col("kind") == "arxiv")).alias("paper"), F.count_if(F.col("ok") & ~real).alias("weak"),
    )
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    verdict = (
        F.when(n("runnable") > 0, "FOUND_RUNNABLE").when(n("paper") > 0, "FOUND_PAPER_ONLY").when(n("resolved") > 0, "FOUND_DOI_ONLY")
        .when(n("weak") > 0, "WEAK_MATCH_ONLY").when(n("signals") > 0, "BROKEN_SIGNALS").otherwise("NO_SIGNALS")
    )
    return docs.select("doc_id").join(v, "doc_id", "left").select("doc_id", n("signals").alias("signals"), verdict.alias("verdict"))


def findability_report(verdicts: DataFrame) -> DataFrame:
    n = verdicts.groupBy("verdict").agg(F.count("*").alias("n"), F.sum("signals").alias("signals"))
    return n.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def signal_rates(validated: DataFrame) -> DataFrame:
    """signals, resolved and rate over all signals, and the shares of documents with a signal that resolves as it stands (raw) and after repair (cleaned)."""
    ok, raw = F.col("resolved").isNotNull(), F.col("resolved") == F.col("value")
    per = validated.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(ok).alias("ok"), F.count_if(raw).alias("raw"))
    one = per.agg(F.sum("n").alias("signals"), F.sum("ok").alias("resolved"), F.avg((F.col("raw") > 0).cast("double")).alias("raw_rate"), F.avg((F.col("ok") > 0).cast("double")).alias("cleaned_rate"))
    return one.select("signals", "resolved", F.round(F.col("resolved") / F.col("signals"), 6).alias("rate"), F.round("raw_rate", 6).alias("raw_rate"), F.round("cleaned_rate", 6).alias("cleaned_rate"))


def strong_types(validated: DataFrame) -> DataFrame:
    """Resolved deposits by type: the kind, or the resource type of a DOI."""
    kind = F.when(F.col("kind").isin(*DEPOSITS), F.col("kind")).otherwise(F.concat(F.lit("doi:"), "resource_type"))
    return validated.where("resolved is not null").select(kind.alias("type")).where("type is not null").groupBy("type").agg(F.count("*").alias("n"))


def method_rates(tri: DataFrame) -> DataFrame:
    """How many bindings each author source was asked about, and the shares whose affiliation or name agreed."""
    n = tri.groupBy("source").agg(F.count("*").alias("n"), F.avg(F.col("found_affil").cast("double")).alias("affil_rate"), F.avg(F.col("found_name").cast("double")).alias("name_rate"))
    return n.select("source", "n", F.round("affil_rate", 6).alias("affil_rate"), F.round("name_rate", 6).alias("name_rate"))


def email_confidence(tri: DataFrame, hits: DataFrame) -> DataFrame:
    t = tri.groupBy("record_id", "email").agg(F.count_if("found_affil").alias("affil"), F.count_if("found_name").alias("named"))
    h = hits.select("record_id", "email").distinct().withColumn("hit", F.lit(True))
    level = (
        F.when(F.col("hit"), "CONFIRMED").when(F.col("affil") >= 3, "STRONG").when(F.col("affil") == 2, "LIKELY").when(F.col("affil") == 1, "PROBABLE")
        .when(F.col("named") > 0, "WEAK").otherwise("UNVERIFIED")
    )
    return t.join(h, ["record_id", "email"], "left").select("record_id", "email", "affil", "named", level.alias("confidence"))


def judge_agreement(verdicts: DataFrame, baseline: str) -> DataFrame:
    """Each judge's agreement with the baseline over the items that both decided."""
    decided = verdicts.where("verdict <> 'UNCLEAR'")
    base = decided.where(F.col("judge") == baseline).select("item_id", F.col("verdict").alias("base"))
    j = decided.join(base, "item_id")
    return j.groupBy("judge").agg(F.count("*").alias("items"), F.round(F.avg((F.col("verdict") == F.col("base")).cast("double")), 6).alias("agreement"))


def judge_profile(verdicts: DataFrame) -> DataFrame:
    """Each judge's verdicts, their share of all it gave, and its mean latency."""
    n = verdicts.groupBy("judge", "verdict").agg(F.count("*").alias("n"), F.sum("seconds").alias("s"))
    own = Window.partitionBy("judge")
    return n.select("judge", "verdict", "n", F.round(F.col("n") / F.sum("n").over(own), 6).alias("share"), F.round(F.sum("s").over(own) / F.sum("n").over(own), 6).alias("mean_seconds"))


def consensus(scores: DataFrame) -> DataFrame:
    """Scores within 2 points: their mean; else their median, flagged beyond 3; the verdict by majority, ties by text."""
    s = scores.groupBy("item_id").agg((F.max("score") - F.min("score")).alias("spread"), F.avg("score").alias("mean"), F.percentile("score", F.lit(0.5)).alias("median"))
    votes = scores.groupBy("item_id", "verdict").agg(F.count("*").alias("n"))
    vote = votes.groupBy("item_id").agg(F.min_by("verdict", F.struct((-F.col("n")).alias("n"), "verdict")).alias("verdict"))
    return s.join(vote, "item_id").select("item_id", F.round(F.when(F.col("spread") <= 2, F.col("mean")).otherwise(F.col("median")), 6).alias("score"), (F.col("spread") > 3).alias("flagged"), "verdict")


def inflated_cells(records: DataFrame, k: float = 5) -> DataFrame:
    """(org, year) cells of more than k times the org's median year."""
    n = records.groupBy("org_code", "year").agg(F.count("*").alias("n"))
    median = n.groupBy("org_code").agg(F.percentile("n", F.lit(0.5)).alias("median"))
    return n.join(median, "org_code").where(F.col("n") > k * F.col("median"))


def inflated_months(records: DataFrame, k: float = 5) -> DataFrame:
    """(org, month) cells of more than k times the mean of the months before and after, of those the org has."""
    n = records.groupBy("org_code", F.date_trunc("month", "date").alias("month")).agg(F.count("*").alias("n"))
    near = Window.partitionBy("org_code").orderBy("month").rowsBetween(-1, 1)
    others = F.try_divide(F.sum("n").over(near) - F.col("n"), F.count("*").over(near) - 1)
    return n.withColumn("near", F.round(others, 6)).where(F.col("n") > k * F.col("near"))


def extrapolate(sample: DataFrame, pool: DataFrame) -> DataFrame:
    """Each org's sample success rate, projected on its pool."""
    s = sample.groupBy("org_code").agg(F.avg(F.col("ok").cast("double")).alias("rate"))
    p = pool.groupBy("org_code").agg(F.count("*").alias("pool"))
    return s.join(p, "org_code").select("org_code", "pool", F.round("rate", 6).alias("rate"), F.round(F.col("rate") * F.col("pool"), 4).alias("expected"))


def yield_gap(attempts: DataFrame) -> DataFrame:
    n = attempts.groupBy("source").agg(F.count("*").alias("n"), F.avg((F.col("http_status") == 200).cast("double")).alias("l"), F.avg((F.col("bucket") == "other").cast("double")).alias("d"))
    return n.select("source", "n", F.round("l", 6).alias("lookup_rate"), F.round("d", 6).alias("download_rate"), F.round(F.col("l") - F.col("d"), 6).alias("gap"))


def yield_gap_buckets(attempts: DataFrame) -> DataFrame:
    """For each source and failure bucket, the share of the source's good look-ups that ended there."""
    found = attempts.where("http_status = 200").groupBy("source", "bucket").agg(F.count("*").alias("n"))
    return found.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source")), 6)).where("bucket <> 'other'")


def source_yield(firsts: DataFrame) -> DataFrame:
    """Records first won by each source, and the running total in falling order."""
    n = firsts.groupBy("source").agg(F.count("*").alias("n"))
    order = Window.orderBy(F.desc("n"), "source").rowsBetween(Window.unboundedPreceding, 0)
    return n.withColumn("running", F.sum("n").over(order))


def final_status(attempts: DataFrame) -> DataFrame:
    """The most common failure of each record without a success, ties by name."""
    per = attempts.groupBy("record_id", "bucket").agg(F.count("*").alias("n"))
    lost = per.groupBy("record_id").agg(F.count_if(F.col("bucket") == "other").alias("won"), F.min_by("bucket", F.struct((-F.col("n")).alias("n"), "bucket")).alias("final_status"))
    return lost.where("won = 0").select("record_id", "final_status")


def taxonomy_coverage(leaves: DataFrame, categories: DataFrame) -> DataFrame:
    """leaf_id, sources (how many map to it) and whether none does."""
    mapped = categories.groupBy("leaf_id").agg(F.countDistinct("source").alias("sources"))
    return leaves.join(mapped, "leaf_id", "left").select("leaf_id", F.coalesce("sources", F.lit(0)).alias("sources"), F.col("sources").isNull().alias("unmapped"))


def source_coverage(leaves: DataFrame, categories: DataFrame) -> DataFrame:
    """Of each source: how many leaves its categories map to, and their share of all leaves."""
    n = categories.join(leaves.select("leaf_id").distinct(), "leaf_id", "left_semi").groupBy("source").agg(F.countDistinct("leaf_id").alias("leaves")).withColumn("_k", F.lit(1))
    total = leaves.agg(F.countDistinct("leaf_id").alias("_all")).withColumn("_k", F.lit(1))
    return n.join(total, "_k").select("source", "leaves", F.round(F.col("leaves") / F.col("_all"), 6).alias("share"))


def taxonomy_gates(predictions: DataFrame, leaves: DataFrame, groups_least: int = 10, leaf_least: int = 5) -> DataFrame:
    """gate, value, passed: known labels, high and low confidence, least hits of a group, leaves with enough hits, and the broadest leaf's share.

    ``predictions`` has primary_id and confidence (high, medium, low), ``leaves`` leaf_id and group_id.
    """
    hits = predictions.groupBy(F.col("primary_id").alias("leaf_id")).agg(F.count("*").alias("n"), F.count_if(F.col("confidence") == "high").alias("high"), F.count_if(F.col("confidence") == "low").alias("low"))
    j = hits.join(leaves.select("leaf_id", "group_id", F.lit(True).alias("known")), "leaf_id", "full").na.fill(0, ["n", "high", "low"])
    groups = j.where("known").groupBy("group_id").agg(F.sum("n").alias("g")).agg(F.min("g").alias("least_group")).withColumn("_k", F.lit(1))
    one = j.agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("known"), F.sum("high").alias("high"), F.sum("low").alias("low"),
        F.count_if(F.col("known")).alias("leaves"), F.count_if(F.col("known") & (F.col("n") >= leaf_least)).alias("full"), F.max("n").alias("most"),
    ).withColumn("_k", F.lit(1)).join(groups, "_k")
    share = lambda c, of="all": F.col(c) / F.col(of)
    rows = [
        ("known_labels", share("known"), share("known") >= 0.95), ("high_confidence", share("high"), share("high") >= 0.4), ("low_confidence", share("low"), share("low") <= 0.2),
        ("least_group", F.col("least_group").cast("double"), F.col("least_group") >= groups_least), ("full_leaves", share("full", "leaves"), share("full", "leaves") >= 75 / 81), ("broadest_leaf", share("most"), share("most") <= 0.15),
    ]
    each = F.array(*[F.struct(F.lit(name).alias("gate"), F.round(value, 6).alias("value"), ok.alias("passed")) for name, value, ok in rows])
    return one.select(F.explode(each).alias("x")).select("x.*")


def taxonomy_trial(predictions: DataFrame, leaves: DataFrame) -> DataFrame:
    """Share of each leaf and its flags; labels outside the taxonomy appear as unknown."""
    n = predictions.groupBy(F.col("primary_id").alias("leaf_id")).agg(F.count("*").alias("n"))
    j = leaves.select("leaf_id").withColumn("known", F.lit(True)).join(n, "leaf_id", "full")
    share = F.coalesce("n", F.lit(0)) / F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy())
    flag = F.when(F.col("known").isNull(), "unknown").when(F.col("n").isNull(), "dead").when(share > 0.15, "broad").otherwise("ok")
    return j.select("leaf_id", F.coalesce("n", F.lit(0)).alias("n"), F.round(share, 6).alias("share"), flag.alias("flag"))


def prefix_profile(records: DataFrame) -> DataFrame:
    p = records.withColumn("prefix", ids.doi_prefix(F.col("doi"))).where("prefix is not null")
    n = p.groupBy("prefix").agg(F.count("*").alias("n"), F.count_if("has_file").alias("held"))
    return n.withColumn("rate", F.round(F.col("held") / F.col("n"), 6))


def prefix_outcomes(records: DataFrame, attempts: DataFrame) -> DataFrame:
    """prefix, bucket, n and rate: the outcomes of the attempts on each DOI prefix's records."""
    p = records.withColumn("prefix", ids.doi_prefix(F.col("doi"))).where("prefix is not null").select("record_id", "prefix")
    n = attempts.join(p, "record_id").groupBy("prefix", "bucket").agg(F.count("*").alias("n"))
    return n.withColumn("rate", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("prefix")), 6))


def author_profile(bindings: DataFrame) -> DataFrame:
    """Each author's papers, first paper, organisations (their number and the first) and distinct addresses."""
    return bindings.groupBy("author").agg(F.countDistinct("record_id").alias("papers"), F.min("record_id").alias("first_id"), F.countDistinct("org_code").alias("n_orgs"), F.min("org_code").alias("org_code"), F.countDistinct("email").alias("emails"))


def author_papers(bindings: DataFrame) -> DataFrame:
    """The ids of each author's papers, one a row."""
    return bindings.select("author", "record_id").distinct()


def author_rollup(bindings: DataFrame) -> DataFrame:
    return bindings.groupBy("email").agg(F.countDistinct("record_id").alias("papers"), F.array_join(F.array_sort(F.collect_set("org_code")), ",").alias("orgs"))


def attempt_stats(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg("bytes"), 4).alias("mean"), F.percentile("bytes", F.lit(0.5)).alias("p50"), F.percentile("bytes", F.lit(0.99)).alias("p99"))


#: Size of a quantile sketch: ranks are right to 0.35 % of the rows, with 99 % confidence, however many sketches were merged.
SKETCH_SIZE = 800


def attempt_sketches(attempts: DataFrame, span: str = "1 hour", column: str = "bytes") -> DataFrame:
    """source, start and sketch (KLL, some 10 KB at most) of ``column`` in each window; null values aren't counted, and a window of nulls alone has a sketch of no rows.

    Sketches can be kept, and those of new windows added, as ``quantiles_of`` merges them to any span.
    """
    n = attempts.groupBy("source", F.window("ts", span).alias("w")).agg(F.kll_sketch_agg_bigint(F.col(column).cast("long"), F.lit(SKETCH_SIZE)).alias("sketch"))
    return n.select("source", F.col("w.start").alias("start"), "sketch")


def quantiles_of(sketches: DataFrame, by: list[str], fractions: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """n and the quantiles (``p50`` for 0.5) of merged sketches for each of ``by``; 0 and 1 give the least and the largest value exactly. Null where no value is."""
    one = sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_SIZE)).alias("_s")).withColumn("n", F.kll_sketch_get_n_bigint("_s"))
    at = lambda f: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("_s", F.lit(f)))
    return one.select(*by, "n", *[at(float(f)).alias(f"p{f * 100:g}") for f in fractions])


def attempt_rates(attempts: DataFrame, span: str = "1 hour") -> DataFrame:
    """Attempts and bytes a second of each source and window."""
    n = attempts.groupBy("source", F.window("ts", span).alias("w")).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return n.select("source", F.col("w.start").alias("start"), "n", F.round(F.col("n") / seconds, 6).alias("per_second"), F.round(F.col("bytes") / seconds, 6).alias("bytes_per_second"))


def error_classes(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy(F.trim(F.substring_index("error", ":", 1)).alias("error_class")).agg(F.count("*").alias("n"))


def classification_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.countDistinct("doc_id").alias("ids"), F.count_if(F.expr("confidence < 0.5")).alias("low"), F.count_if(F.expr("status = 'error'")).alias("errors"), F.count_if(F.expr("status = 'good'")).alias("good"))


def verdict_profile(verdicts: DataFrame) -> DataFrame:
    """Verdict shares of each subject code, with flags for a heavy middle and a thin low class."""
    n = verdicts.groupBy("code").agg(F.count("*").alias("n"), *[F.avg((F.col("verdict") == v).cast("double")).alias(v) for v in ("HIGH", "MIDDLE", "LOW")])
    return n.select("code", "n", *[F.round(v, 6).alias(v.lower()) for v in ("HIGH", "MIDDLE", "LOW")], (F.col("MIDDLE") > 0.5).alias("heavy_middle"), (F.col("LOW") < 0.05).alias("thin_low"))


def expected_verdicts(profile: DataFrame, expected: DataFrame) -> DataFrame:
    """``verdict_profile`` rows with ``breached``: the share of the class that ``expected`` (code, verdict, least) names for the code is below its least."""
    share = F.coalesce(*[F.when(F.upper("verdict") == c.upper(), F.col(c)) for c in ("high", "middle", "low")])
    j = profile.join(expected, "code", "left").withColumn("breached", F.coalesce(share < F.col("least"), F.lit(False)))
    return j.select(*profile.columns, "breached")


def upstream_coverage(universe: DataFrame, results: dict[str, DataFrame], key: str) -> DataFrame:
    """Share of the universe's ids that each upstream result holds; all are counted in one pass over their union."""
    rows = None
    for name, df in results.items():
        part = df.select(key).distinct().join(universe.select(key), key, "left_semi").withColumn("result", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    total = universe.agg(F.countDistinct(key).alias("total")).withColumn("_k", F.lit(1))
    n = rows.groupBy("result").agg(F.count("*").alias("n")).withColumn("_k", F.lit(1)).join(total, "_k").drop("_k")
    share = F.col("n") / F.col("total")
    return n.select("result", "n", F.round(share, 6).alias("share"), (share < 0.5).alias("thin"))


def inventory_drift(scan: DataFrame, files: DataFrame, flag: float = 0.05) -> DataFrame:
    a, b = scan.groupBy("source").agg(F.count("*").alias("scanned")), files.groupBy("source").agg(F.count("*").alias("catalogued"))
    j = a.join(b, "source", "full").na.fill(0, ["scanned", "catalogued"])
    drift = F.col("scanned") - F.col("catalogued")
    return j.withColumn("drift", drift).withColumn("flagged", F.abs(drift) > flag * F.greatest("catalogued", F.lit(1)))


def harvest_completeness(cells: DataFrame, announced: DataFrame) -> DataFrame:
    """Every announced (org, year) cell with the rows received; missing cells have 0."""
    got = cells.groupBy("org_code", "year").agg(F.count("*").alias("received"))
    j = announced.join(got, ["org_code", "year"], "left").withColumn("received", F.coalesce("received", F.lit(0)))
    return j.withColumn("complete", F.col("received") >= F.col("total"))


def harvest_grid(cells: DataFrame, totals: DataFrame, orgs: DataFrame, first: int, last: int) -> DataFrame:
    """Every (org, year) of the organisations and years asked for, with rows received, the announced total and state: missing, short, complete or unannounced."""
    grid = orgs.select("org_code").distinct().withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    got = cells.groupBy("org_code", "year").agg(F.count("*").alias("received"))
    j = grid.join(got, ["org_code", "year"], "left").join(totals.select("org_code", "year", "total"), ["org_code", "year"], "left")
    received = F.coalesce("received", F.lit(0))
    state = F.when(received == 0, "missing").when(F.col("total").isNull(), "unannounced").when(received < F.col("total"), "short").otherwise("complete")
    return j.select("org_code", "year", received.alias("received"), "total", state.alias("state"))


def magic_absent(payloads: DataFrame, magic: str) -> DataFrame:
    """n, expected and absent: whether no payload at all begins with the expected bytes."""
    return payloads.agg(F.count("*").alias("n"), F.count_if(F.col("magic") == magic).alias("expected")).withColumn("absent", F.col("expected") == 0)


def magic_counts(payloads: DataFrame, n: int = 10) -> DataFrame:
    return top_counts(payloads, "magic", n)


def gap_sources(records: DataFrame, texts: DataFrame, files: DataFrame) -> DataFrame:
    """Records without a DOI by what could fill it: a text, a file or neither."""
    gap = records.where(ids.no_doi(F.col("doi"))).select("record_id")
    t, f = texts.select("record_id").distinct().withColumn("t", F.lit(1)), files.select("record_id").distinct().withColumn("f", F.lit(1))
    by = F.when(F.col("t") == 1, "text").when(F.col("f") == 1, "file").otherwise("neither")
    return gap.join(t, "record_id", "left").join(f, "record_id", "left").groupBy(by.alias("filled_by")).agg(F.count("*").alias("n"))


def segment_cell(records: DataFrame, condition: Column) -> DataFrame:
    return records.where(condition).groupBy("product_type").agg(F.count("*").alias("n"))


def theme_frequency(tags: DataFrame) -> DataFrame:
    """Documents of each theme; ``tags`` comes from ``tag_terms``."""
    return tags.groupBy("tag").agg(F.countDistinct("doc_id").alias("docs"))


def repair_stats(fixed: DataFrame) -> DataFrame:
    """Totals over the result of ``fix_emails``."""
    has = lambda field: F.count_if(F.array_contains("changed", field))
    return fixed.agg(F.count("*").alias("total"), F.count_if(F.size("changed") > 0).alias("changed"), F.sum(F.size("extras")).alias("recovered"), has("email").alias("by_email"), has("authors").alias("by_authors"))


def queue_status(queue: DataFrame) -> DataFrame:
    return counts(queue, ["status"])


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("started"), "run_id").limit(n)


def group_topics(rows: DataFrame, extra: list[tuple[str, str, str]], expected: int) -> DataFrame:
    """One row a topic with name, office and its sorted focuses; ``as_expected`` says whether the number of topics is the announced one."""
    topics = rows.groupBy("topic").agg(F.min("name").alias("name"), F.min("office").alias("office"), F.array_join(F.array_sort(F.collect_set("focus")), "; ").alias("focuses"))
    if extra:
        topics = topics.unionByName(rows.sparkSession.createDataFrame(extra, "topic string, name string, office string").withColumn("focuses", F.lit("")))
    total = topics.agg(F.count("*").alias("_n")).withColumn("_k", F.lit(1))
    return topics.withColumn("_k", F.lit(1)).join(total, "_k").withColumn("as_expected", F.col("_n") == expected).drop("_k", "_n")
