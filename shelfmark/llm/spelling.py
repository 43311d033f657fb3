"""Operator 11, grouping of spelling variants by asymmetric q-chunks.

Words are counted over all texts (``word_counts``). Two words are near at one inserted, deleted or replaced code point. Of two words the
shorter one (of equally long ones, either) gives two disjoint chunks, its first and its last ``length // 2`` code points;
the other gives its positional grams of that size. One edit leaves one of the two chunks whole, and moves it by one place at most, so
near words share a chunk and a gram whose places differ by one at most. Grams farther than that from both chunks of a word
of the same length or one less can't join, so they aren't made: a word has six grams at most for each of the two lengths. Both sides join by (length of the
shorter word, which chunk, its text); the distance of each pair is then computed.

A gram that more than GROUP_MOST words give (a common stem or ending) would pair them all. Words that meet in such a group
are joined by a finer key instead, the whole word but for one code point: near words of one length share the rest around
the place where they differ, and the longer of two others without one code point is the shorter. Such groups
hold near words alone, at most one for each letter, so their pairs are results; nothing is left out. The decision is taken by group, and pairs from both ways are
made distinct.

Cases: a null text has no words; a null doc_id is written as nothing before the colon that the damage hashes; rows with one doc_id
count each; an empty table gives no rows; other columns are left aside. Memory follows the longest text. A word of any length is
handled; only its parts are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.staging import Scratch

LEAST_LENGTH, LEAST_COUNT = 6, 5
DAMAGE_STEP = 199
FORM_TIMES = 5
GROUP_MOST = 2_000
RUN = "[A-Za-z\\u00C0-\\u00FF]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n: the runs of letters of all texts, A-Z in lower case, some of them short of a letter by the damage rule."""
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"{RUN}{{{LEAST_LENGTH},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    rows = rows.select("doc", F.translate("run", _UPPER, _LOWER).alias("run")).withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = rows.select(F.when(F.col("h") % DAMAGE_STEP == 0, short).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH))


def _key(length: Column, side: str, text: Column) -> Column:
    """``side`` and the length of the shorter word stand in the key with the chunk's text."""
    return F.concat(length.cast("string"), F.lit(side), text)


def chunks(words: DataFrame) -> DataFrame:
    """key and word: the first and the last half of each word."""
    n, half = F.col("length"), F.floor(F.col("length") / 2).cast("int")
    both = F.array(_key(n, "<", F.substring(F.col("word"), F.lit(1), half)), _key(n, ">", F.substring(F.col("word"), n - half + 1, half)))
    return words.select("word", "length", F.explode(both).alias("key"))


def grams(words: DataFrame) -> DataFrame:
    """key and word: the positional grams that lie within one place of a chunk of an equally long or one shorter word."""
    w, n = F.col("word"), F.col("length")

    def of(length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        places = [("<", F.lit(0)), ("<", F.lit(1)), *((">", length - half + i) for i in (-1, 0, 1))]
        return [F.when((at >= 0) & (at + half <= n), _key(length, side, F.substring(w, at + 1, half))) for side, at in places]

    return words.select("word", "length", F.explode(F.array_distinct(F.array_compact(F.array(*of(n), *of(n - 1))))).alias("key"))


def _near(pairs: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those at one edit; all lengths differ by one at most."""
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def _without_one(words: DataFrame) -> DataFrame:
    """word, place and rest: each word without the code point at each place."""
    at = F.explode(F.sequence(F.lit(0), F.col("length") - 1))
    rows = words.select("word", "length", at.alias("place"))
    rest = F.concat(F.substring(F.col("word"), F.lit(1), F.col("place")), F.substring(F.col("word"), F.col("place") + 2, F.col("length")))
    return rows.select("word", "place", rest.alias("rest"))


def _fine_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """All near pairs of these words."""
    rest = scratch.staged(_without_one(words), "words-without-one")
    x, y = rest.select(F.col("word").alias("a"), "place", "rest"), rest.select(F.col("word").alias("b"), "place", "rest")
    replaced = x.join(y, ["place", "rest"]).where("a < b").select("a", "b")
    deleted = words.select(F.col("word").alias("a")).join(rest.select(F.col("word").alias("b"), F.col("rest").alias("a")), "a").select("a", "b")
    return replaced.unionByName(deleted)


def near_pairs(words: DataFrame, group_most: int = GROUP_MOST, owner: Scratch | None = None) -> DataFrame:
    """Each pair (a, b) of ``words`` (word) at one edit, once; a is not the longer one."""
    scratch = Scratch(words.sparkSession)
    words = words.select("word", F.length("word").alias("length"))
    x, y = scratch.staged(chunks(words), "word-chunks"), scratch.staged(grams(words), "word-grams")
    held = y.groupBy("key").agg(F.count("*").alias("n"))
    common = scratch.staged(held.where(F.col("n") > group_most).select("key"), "common-grams")
    shorter = F.struct(F.col("x.length"), F.col("x.word")) < F.struct(F.col("y.length"), F.col("y.word"))
    few = x.join(common, "key", "left_anti").alias("x").join(y.alias("y"), "key").where(shorter)
    found = _near(few.select(F.col("x.word").alias("a"), F.col("y.word").alias("b")))
    if common.limit(1).count():  # else no group is common, and the finer keys have no words
        hot = x.select("key", "word", "length").unionByName(y.select("key", "word", "length")).join(common, "key", "left_semi").select("word", "length").distinct()
        found = found.unionByName(_near(_fine_pairs(scratch.staged(hot, "common-words"), scratch)))
    out = scratch.staged(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-words")
    scratch.clear(keep=1)
    if owner:
        owner.paths += scratch.paths
    return out


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, n_near, form and form_n of ``words`` (word, n), whose near pairs are ``pairs`` (a, b)."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    with_n = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("its")), "b")
    best = with_n.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("its")).alias("less"), "b")).alias("x"))
    best = best.select(F.col("a").alias("word"), "n_near", F.col("x.b").alias("best"), (-F.col("x.less")).alias("best_n"))
    wins = F.coalesce(F.col("best_n") >= FORM_TIMES * F.col("n"), F.lit(False))
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(wins, F.col("best")).alias("form"), F.when(wins, F.col("best_n")).alias("form_n")
    )


def roots(of: DataFrame, scratch: Scratch) -> DataFrame:
    """word and root of every word that has a form, by doubling the way from form to form.

    A form occurs at least FORM_TIMES as often, so ways have no circle and about log(n) steps; few rounds are enough.
    """
    now = scratch.staged(of.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        later = scratch.staged(now.join(ahead, "root", "left").select("word", F.coalesce("farther", "root").alias("root"), F.col("farther").isNotNull().alias("moved")), "roots")
        now = later.select("word", "root")
        if not later.where("moved").limit(1).count():
            return now


def spelling_variants(docs: DataFrame, group_most: int = GROUP_MOST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs`` (doc_id, text) that occurs often enough."""
    scratch = Scratch(docs.sparkSession)
    words = scratch.staged(word_counts(docs), "words")
    of = scratch.staged(forms(words, near_pairs(words, group_most, scratch)), "forms")
    out = of.join(roots(of, scratch), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    out = Scratch(docs.sparkSession).staged(out, "spelling-variants")
    scratch.clear()
    return out
