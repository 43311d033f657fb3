"""Operator 5, quality rules by a hashed n-gram log-likelihood ratio, with DataFrame functions only.

Words and pairs of neighbouring words hash into buckets. Two multinomials over the buckets, with additive
smoothing, are counted: one over the trusted texts, one over the whole corpus. A document's score is its
summed log-ratio of the two divided by its number of n-grams, and every document whose score reaches
a fixed threshold passes. Base rules on word counts and repeated five-word windows come first.

All counts of one document are made inside its row; the corpus counts shuffle one row a bucket and task.
The bucket weights (a number that is a parameter) are collected and go back as a constant.
Trusted are all documents labelled quality 1, and the raw counts cover all documents. The trusted ids are counted
first: up to BROADCAST_MOST of them are broadcast, and no text is shuffled; more join by a shuffle of doc_id and text.

Cases: a null or empty text, or one of separators only, has no words and fails the base rules; repeated rows
each get their result; without trusted texts all log-ratios are even and the base rules decide; an
empty table gives no rows; other columns are left aside. A row needs memory for a few longs a word.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 16384
SMOOTHING = 0.5
THRESHOLD = -0.11
BROADCAST_MOST = 500_000
WINDOW = 5
LEAST_WORDS = 10


def with_words(docs: DataFrame) -> DataFrame:
    """``words`` and their hashes ``word_keys`` of the whole text."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    return docs.withColumn("words", words).withColumn("word_keys", F.transform("words", lambda w: F.xxhash64(w)))


def _at(i: Column, step: int) -> Column:
    return F.get("word_keys", i + step)


def ngram_buckets(n_buckets: int = BUCKETS) -> tuple[Column, Column]:
    """The buckets of the words and of the pairs of neighbours."""
    single = F.transform("word_keys", lambda h: F.pmod(h, F.lit(n_buckets)).cast("int"))
    places = F.when(F.size("word_keys") > 1, F.sequence(F.lit(0), F.size("word_keys") - 2)).otherwise(F.array().cast("array<int>"))
    pairs = F.transform(places, lambda i: F.pmod(F.xxhash64(_at(i, 0), _at(i, 1)), F.lit(n_buckets)).cast("int"))
    return single, pairs


def repeated_words(window: int = WINDOW) -> Column:
    """Words inside windows that the text holds twice or more; needs ``sorted_windows``.

    Windows are sorted by hash, equal neighbours are marked, and the marked places, again in order, are
    joined into covered stretches. A text without equal windows, the usual case, stops after a distinct count.
    """
    same = lambda x, j, step: F.coalesce(F.get("sorted_windows", j + step)["h"] == x["h"], F.lit(False))
    marked = F.sort_array(F.transform(F.filter("sorted_windows", lambda x, j: same(x, j, -1) | same(x, j, 1)), lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("int").alias("end"))
    step = lambda a, p: F.struct(
        (a["n"] + (p + window - F.greatest(p, a["end"])).cast("long")).alias("n"), (p + F.lit(window)).cast("int").alias("end")
    )
    return F.aggregate(marked, start, step, lambda a: a["n"])


def base_counts(docs: DataFrame) -> DataFrame:
    """The base columns beside ``words`` and ``word_keys``."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    places = F.when(F.size("word_keys") >= WINDOW, F.sequence(F.lit(0), F.size("word_keys") - WINDOW)).otherwise(F.array().cast("array<int>"))
    df = with_words(docs).withColumn("lines", lines)
    df = df.withColumn("window_keys", F.transform(places, lambda i: F.xxhash64(*[_at(i, j) for j in range(WINDOW)])))
    again = F.size(F.array_distinct("window_keys")) < F.size("window_keys")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = F.sort_array(F.transform("window_keys", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("sorted_windows", F.when(again, ordered).otherwise(none))
    return df.select(
        *docs.columns, "word_keys",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words().alias("n_repeat_words"),
    )


def log_ratios(docs: DataFrame, labels: DataFrame, n_buckets: int = BUCKETS, broadcast_most: int = BROADCAST_MOST) -> list[float]:
    """The log-likelihood ratio of each bucket, trusted texts to the whole corpus."""
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("trusted_id")).distinct()
    trusted = F.broadcast(trusted) if trusted.count() <= broadcast_most else trusted.hint("merge")
    rows = docs.select("doc_id", "text").join(trusted, F.col("doc_id") == F.col("trusted_id"), "left")
    single, pairs = ngram_buckets(n_buckets)
    rows = with_words(rows).select(F.col("trusted_id").isNotNull().cast("int").alias("trusted"), F.explode(F.concat(single, pairs)).alias("bucket"))
    found = rows.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target")).collect()
    raw, target = [0] * n_buckets, [0] * n_buckets
    for x in found:
        raw[x["bucket"]], target[x["bucket"]] = x["raw"], x["target"]
    if not sum(target):
        return [0.0] * n_buckets
    base = math.log((sum(raw) + SMOOTHING * n_buckets) / (sum(target) + SMOOTHING * n_buckets))
    return [round(math.log((t + SMOOTHING) / (r + SMOOTHING)) + base, 6) for t, r in zip(target, raw)]


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base columns, base_failed, score (log-ratio an n-gram) and kept of every document."""
    ratios = log_ratios(docs, labels)
    table = F.split(F.lit(" ".join(map(repr, ratios))), " ").cast("array<double>")
    single, pairs = ngram_buckets()
    total = lambda col: F.aggregate(col, F.lit(0.0), lambda a, b: a + F.get(table, b))
    df = base_counts(docs.select("doc_id", "text")).withColumn("summed", total(single) + total(pairs))
    df = df.withColumn("score", F.when(F.col("n_words") > 0, F.col("summed") / (2 * F.col("n_words") - 1)).otherwise(0.0))
    df = df.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    kept = ~F.col("base_failed") & (F.col("score") >= threshold)
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "score")
