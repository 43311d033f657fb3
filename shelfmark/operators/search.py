"""Batch corpus search over tables: postings, five axes and their fusion. No axis makes a cross join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators import index, match
from shelfmark.operators.windows import global_rank
from shelfmark.session import staged

#: Letters with diacritics and what stands for them.
ACCENTED, PLAIN = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ", "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"


def terms_of(col: str):
    plain = F.lower(F.translate(F.coalesce(F.col(col), F.lit("")), ACCENTED, PLAIN))
    return F.regexp_extract_all(plain, F.lit(r"([a-z0-9@._+-]+)"), F.lit(1))


def build_postings(docs: DataFrame) -> DataFrame:
    """term, doc_id, pos: every token of every text, with @ . - _ + kept inside."""
    return docs.select("doc_id", F.posexplode(terms_of("text")).alias("pos", "term")).select("term", "doc_id", "pos")


def _lookup(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """The rows of these keys; of a kept index only their folders are read."""
    found = rows.where(F.col(key).isin(*values))
    if "folder" not in rows.columns:
        return found
    return found.where(F.col("folder").isin(sorted({index.folder_number(x) for x in values})))


def search_term(postings: DataFrame, word: str) -> DataFrame:
    """Documents with the term, or with a term of that prefix (``foo*``)."""
    return match.search(postings, match.prefix(word[:-1]) if word.endswith("*") else match.term(word))


def search_phrase(postings: DataFrame, words: list[str]) -> DataFrame:
    """Documents where the words follow one another, and how often; a word may stand more than once."""
    return match.search(postings, match.phrase(*words))


def search_boolean(postings: DataFrame, all_of: list[str], none_of: list[str]) -> DataFrame:
    """Documents with all of some words and none of others; any other expression is for ``match.search``."""
    e = match.All(tuple([*map(match.term, all_of), *(~match.term(x) for x in none_of)]))
    return match.search(postings, e).select("doc_id")


def search_regex(docs: DataFrame, pattern: str) -> DataFrame:
    return docs.where(F.regexp_like("text", F.lit(pattern))).select("doc_id")


def search_fields(docs: DataFrame, fields: DataFrame, field: str, like: str) -> DataFrame:
    return docs.join(fields.where((F.col("field") == field) & F.col("value").like(like)).select("doc_id"), "doc_id", "left_semi")


#: Rows of a query's rarest terms that find its first documents, and how many of those are scored (at least ``top``).
SEED_ROWS, SEEDS = 500, 20
_ROUNDING = 1e-6


def build_term_sets(docs: DataFrame) -> DataFrame:
    """term, doc_id, nd: the different tokens of every text, with their number."""
    return docs.select("doc_id", F.array_distinct(terms_of("text")).alias("d")).select("doc_id", F.size("d").alias("nd"), F.explode("d").alias("term")).select("term", "doc_id", "nd")


def _overlaps(pairs: DataFrame, held: DataFrame, asked: DataFrame) -> DataFrame:
    """query_id, doc_id and score of the pairs, from all terms that a document has of those asked for."""
    sets = held.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.first("nd").alias("nd"), F.collect_set("term").alias("d"))
    both = pairs.join(asked, "query_id").join(sets, "doc_id").withColumn("k", F.size(F.array_intersect("d", "terms")))
    return both.select("query_id", "doc_id", F.round(F.col("k") / (F.col("nd") + F.size("terms") - F.col("k")), 6).alias("score"))


def jaccard_candidates(docs: DataFrame, queries: DataFrame, top: int, kept: index.Index | None = None) -> tuple[DataFrame, DataFrame]:
    """The scored pairs (query_id, doc_id, score) among which are each query's ``top``, and the pairs that were only bounded.

    Terms go from rare to frequent. Of the documents of a query's rarest terms the most promising are scored first; the score of the ``top``-th is what others have to
    reach, and the more terms a document has, the more of them must be shared. A document that must share m of a query's n terms has one of the first n - m + 1, so a
    posting makes a pair only if its term stands that early for its document's size. With c of the first p terms shared, c + n - p are shared at most
    and c at least: pairs that by the first can't reach what others reach by the second are left before their token sets are read.
    """
    asked = queries.select("query_id", F.explode(terms_of("text")).alias("term")).groupBy("query_id").agg(F.collect_set("term").alias("terms"))
    asked = staged(asked, "jaccard-queries")
    terms = asked.select("query_id", F.size("terms").alias("nq"), F.explode("terms").alias("term"))
    held = (build_term_sets(docs) if kept is None else kept.rows()).join(terms.select("term").distinct(), "term", "left_semi").select("term", "doc_id", "nd")
    held = staged(held, "jaccard-terms")
    rare = Window.partitionBy("query_id").orderBy("n", "term")
    counts = terms.join(held.groupBy("term").agg(F.count("*").alias("n")), "term")
    ranked = counts.withColumns({"at": F.row_number().over(rare), "rows": F.sum("n").over(rare.rowsBetween(Window.unboundedPreceding, 0))})
    ranked = staged(ranked.withColumn("found", F.count("*").over(Window.partitionBy("query_id"))), "jaccard-ranks")

    met = ranked.where((F.col("rows") <= SEED_ROWS) | (F.col("at") == 1)).join(held, "term").groupBy("query_id", "doc_id", "nq", "nd").agg(F.count("*").alias("c"))
    best = Window.partitionBy("query_id").orderBy(F.desc(F.col("c") / (F.col("nq") + F.col("nd") - F.col("c"))), "doc_id")
    first = staged(met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= max(top, SEEDS)).select("query_id", "doc_id"), "jaccard-seeds")
    scored = staged(_overlaps(first, held, asked), "jaccard-first")
    nth = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))).where(F.col("rank") == top).select("query_id", F.col("score").alias("least"))

    # a score of s takes s / (1 + s) of the two sizes together as shared terms; terms that no document holds aren't shared, so ``found`` of nq count
    need = lambda least: F.greatest(F.lit(1), F.ceil((F.col(least) - _ROUNDING) * (F.col("nq") + F.col("nd")) / (1 + F.col(least)) - _ROUNDING))
    first_terms = F.col("found") - need("least") + 1
    ranked = ranked.join(nth, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    near = ranked.join(held, "term").where((F.col("at") <= first_terms) & (F.col("nd") >= need("least")))
    met = near.groupBy("query_id", "doc_id", "nq", "nd", "least", "found").agg(F.count("*").alias("c")).withColumn("upto", first_terms)
    met = staged(met.join(first, ["query_id", "doc_id"], "left_anti"), "jaccard-met")
    sure = met.select("query_id", (F.col("c") / (F.col("nq") + F.col("nd") - F.col("c"))).alias("score")).unionByName(scored.select("query_id", "score"))
    better = sure.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))).where(F.col("rank") == top).select("query_id", F.col("score").alias("better"))
    met = met.join(better, "query_id", "left").withColumn("better", F.coalesce("better", F.lit(0.0)))
    met = met.withColumn("open", F.least(F.col("c") + F.col("found") - F.col("upto"), F.col("nd")) >= need("better"))
    more = _overlaps(met.where("open").select("query_id", "doc_id"), held, asked)
    return scored.unionByName(more), met.where(~F.col("open"))


def search_jaccard(docs: DataFrame, queries: DataFrame, top: int = 5, kept: index.Index | None = None) -> DataFrame:
    """Each query's best documents by token Jaccard, from the kept term sets where an index is given; ties go by doc_id."""
    scored, _ = jaccard_candidates(docs, queries, top, kept)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "doc_id", "score", "rank")


def search_vectors(vectors: DataFrame, query: list[float], top: int) -> DataFrame:
    """The vectors of the highest cosine with one stated query vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with("embedding", q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, b: a + b)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, b: a + b.cast("double") * b.cast("double")))
    length = sum(x * x for x in query) ** 0.5
    return vectors.select("vec_id", F.round(dot / (norm * length), 5).alias("cosine")).orderBy(F.desc("cosine"), "vec_id").limit(top)


def fuse(axes: dict[str, DataFrame], weights: dict[str, float], k: int = 60) -> DataFrame:
    """Reciprocal rank fusion of axes (doc_id, score): summed weight / (k + rank), and the axes that gave it."""
    rows = None
    for name, df in axes.items():
        ranked = global_rank(df, "score", "doc_id", descending=True)
        part = ranked.select("doc_id", (F.lit(weights[name]) / (k + F.col("rank"))).alias("part"), F.lit(name).alias("axis"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("doc_id").agg(F.round(F.sum("part"), 6).alias("score"), F.array_join(F.array_sort(F.collect_set("axis")), ",").alias("axes"))


def trigrams_of(col: str) -> Column:
    """All runs of three characters, in one pass over the text."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(col), F.lit(""))), F.lit("(?s)(?=(.{3}))"), F.lit(1))


def build_trigrams(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.explode(F.array_distinct(trigrams_of("text"))).alias("gram"))


POSTINGS = index.Kind("postings", "term", build_postings)
TERM_SETS = index.Kind("term-sets", "term", build_term_sets)
TRIGRAMS = index.Kind("trigrams", "gram", build_trigrams)


def search_substring(docs: DataFrame, trigrams: DataFrame, needle: str) -> DataFrame:
    """Documents that hold the needle: all its trigrams first, then the text itself."""
    grams = sorted({needle.lower()[i : i + 3] for i in range(len(needle) - 2)})
    near = _lookup(trigrams, "gram", grams).groupBy("doc_id").agg(F.count("*").alias("k")).where(F.col("k") == len(grams))
    return docs.join(near, "doc_id", "left_semi").where(F.contains(F.lower("text"), F.lit(needle.lower()))).select("doc_id")


def changed_docs(new: DataFrame, old: DataFrame) -> DataFrame:
    """New documents and those whose time changed or is unknown."""
    return new.join(old.select("doc_id", F.col("mtime").alias("_old")), "doc_id", "left").where("_old is null or mtime is null or _old <> mtime").drop("_old")


def scan_needles(payloads: DataFrame, needles: list[str], least: int, most: int, preview: int = 200) -> DataFrame:
    """id, needle, at (from 1) and the text from there, for payloads (id, size, text) of a size in range; one scan for all needles."""
    hits = F.filter(F.transform(F.array(*map(F.lit, needles)), lambda n: F.struct(n.alias("needle"), F.position(n, F.col("text")).alias("at"))), lambda h: h["at"] > 0)
    found = payloads.where(F.col("size").between(least, most)).select("id", "text", F.explode(hits).alias("h"))
    return found.select("id", "h.needle", "h.at", F.substring("text", F.col("h.at"), F.lit(preview)).alias("preview"))
