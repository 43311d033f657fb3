"""Joins between catalog tables. None is a cross join; lookups that are small tables are left to the optimizer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import text as tx
from shelfmark.session import staged


def resolve_year(inventory: DataFrame, lookup: DataFrame) -> DataFrame:
    """year: the path's, else the looked-up one; year_source tells which."""
    j = inventory.join(lookup.select("record_id", F.col("year").alias("looked_up")), "record_id", "left")
    source = F.when(F.col("path_year").isNotNull(), "path").when(F.col("looked_up").isNotNull(), "lookup").otherwise("none")
    return j.withColumn("year", F.coalesce("path_year", "looked_up")).withColumn("year_source", source).drop("looked_up")


def missing_records(records: DataFrame, files: DataFrame, first: int, last: int, limit: int | None = None) -> DataFrame:
    gap = records.where(F.col("year").between(first, last)).join(files.select("record_id"), "record_id", "left_anti")
    return gap.orderBy(F.desc("year"), "record_id").limit(limit) if limit else gap


def not_yet_held(attempts: DataFrame, records: DataFrame) -> DataFrame:
    return attempts.join(records.where("has_file").select("record_id"), "record_id", "left_anti")


def todo(pool: DataFrame, *done: DataFrame, key: str = "record_id") -> DataFrame:
    for d in done:
        pool = pool.join(d.select(key), key, "left_anti")
    return pool


def coverage_by_year(records: DataFrame, files: DataFrame) -> DataFrame:
    held = files.select("record_id").distinct().withColumn("held", F.lit(1))
    return records.join(held, "record_id", "left").groupBy("year").agg(F.count("*").alias("n"), F.count("held").alias("held"))


def canonical_preview(files: DataFrame) -> DataFrame:
    best = files.groupBy("record_id").agg(F.min("priority").alias("priority"))
    return files.join(best, ["record_id", "priority"])


def excluded_with_files(records: DataFrame, files: DataFrame, types: list[str]) -> DataFrame:
    out = records.where(F.col("product_type").isin(*types)).join(files.select("record_id"), "record_id")
    return out.groupBy("product_type").agg(F.countDistinct("record_id").alias("n"))


def contacts_for(links: DataFrame, contacts: DataFrame) -> DataFrame:
    """One row a record with its contacts, corresponding first, then by papers, then by name."""
    j = links.join(contacts, "contact_id", "left")
    order = F.struct((~F.col("corresponding")).alias("c"), (-F.col("papers")).alias("p"), F.col("name"))
    return j.groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["name"]).alias("names"))


def best_text(texts: DataFrame, key: str = "record_id") -> DataFrame:
    return texts.groupBy(key).agg(F.max_by("path", F.struct("size", "path")).alias("path"), F.max("size").alias("size"))


def join_with_report(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    flagged = left.join(right.withColumn("_hit", F.lit(True)), key, "left")
    report = flagged.agg(F.count("*").alias("total"), F.count("_hit").alias("matched"), (F.count("*") - F.count("_hit")).alias("unmatched")).withColumn("join_key", F.lit(key))
    return flagged.withColumn("match", F.coalesce(F.when(F.col("_hit"), "MATCHED"), F.lit("UNKNOWN"))).drop("_hit"), report


def crosswalk(verdicts: DataFrame, findability: DataFrame) -> DataFrame:
    tier = F.when((F.col("verdict") == "YES") & F.col("findability").isin("FOUND_DEPOSIT", "FOUND_RUNNABLE"), 1).when(F.col("verdict").isin("YES", "MAYBE") & F.startswith("findability", F.lit("FOUND")), 2)
    return verdicts.join(findability, "doc_id").withColumn("tier", tier)


def crosswalk_rate(crossed: DataFrame) -> DataFrame:
    """n, tier_1, tier_2 and rate: the share of judged documents that have a tier."""
    one = crossed.agg(F.count("*").alias("n"), F.count_if(F.col("tier") == 1).alias("tier_1"), F.count_if(F.col("tier") == 2).alias("tier_2"))
    return one.withColumn("rate", F.round(F.try_divide(F.col("tier_1") + F.col("tier_2"), F.col("n")), 6))


def merge_variants(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Best of two format variants: a's value, else b's, and which variants hold the id."""
    x = a.select(key, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("in_a"))
    y = b.select(key, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("in_b"))
    j = x.join(y, key, "full")
    return j.select(key, *[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in columns], F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b"))


def validate_signals(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """doc_id, kind, value and the first candidate (by ``pos``) that the registry resolves."""
    ok = F.col("status").between(200, 299) | F.col("status").isin(301, 302, 303, 307, 308, 403)
    good = registry.where(ok).select("kind", F.col("value").alias("candidate"), "resource_type", F.lit(True).alias("_hit"))
    hits = candidates.join(good, ["kind", "candidate"], "left")
    first = F.min(F.when(F.col("_hit"), F.struct("pos", "candidate", "resource_type")))
    return hits.groupBy("doc_id", "kind", "value").agg(first.alias("f")).select("doc_id", "kind", "value", F.col("f.candidate").alias("resolved"), "f.resource_type")


def triangulate(bindings: DataFrame, authors: DataFrame, generic: list[str]) -> DataFrame:
    """Per binding and author source: whether a name and an affiliation agree."""
    j = bindings.join(authors, "record_id")
    domain = F.substring_index("email", "@", -1)
    return j.groupBy("record_id", "email", "source").agg(
        F.max(tx.name_overlap(F.col("name_hint"), F.col("name")) >= 0.5).alias("found_name"),
        F.max(tx.affil_matches_domain(domain, F.col("affiliation"), generic, [])).alias("found_affil"),
    )


#: Titles of a surname that may hold a set of tokens before it is looked up only together with one more; comparisons a record that the sets left at the end may ask for.
HOT_TITLES = 100
TITLES_PER_TASK = 20_000
BITMAP_LEAST, BITMAP_MOST = 1 << 16, 1 << 26


def _may_be_asked(rows: DataFrame, asked: DataFrame, *key: str) -> DataFrame:
    """The ``rows`` whose key is among those of ``asked``, and few others: a bitmap of the keys' hashes decides, in words of 64 bits."""
    keys = asked.select(F.xxhash64(*key).alias("one")).distinct()
    size = min(max(BITMAP_LEAST, 8 << keys.count().bit_length()), BITMAP_MOST)
    word = F.shiftrightunsigned(F.col("one").bitwiseAND(F.lit(size - 1)), 6)
    bit = F.expr("shiftleft(1L, cast(one & 63 as int))")
    bits = F.broadcast(staged(keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")), "titles-bits"))
    return rows.withColumn("one", F.xxhash64(*key)).withColumn("word", word).join(bits, "word").where(bit.bitwiseAND(F.col("bits")) != 0).drop("one", "word", "bits")


def match_titles(records: DataFrame, preprints: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Each record's first preprint (by id) of the same surname whose title matches.

    A match holds ``need = ceil(threshold * n)`` of a record's n tokens, so it misses ``spare = n - need`` of them at most. Tokens are numbered, and lie on both sides from the
    one that the fewest titles of the surname hold to the one that most hold. The first of a record's tokens that a match holds is among its first ``spare + 1``. One that up to HOT_TITLES
    titles hold is looked up, and those titles are compared; a more frequent one is looked up with each next token that a match may hold, those pairs that are still frequent with a third, and
    so on, until a set has ``need`` tokens, when its first preprint is the answer, or the frequent sets that are left ask for HOT_TITLES comparisons a record at most. So comparisons grow as the
    records do, however many titles there are. Equal token sets of one surname, on either side, are one row there, so that copies of a title never pair up. A record without tokens matches nothing.
    """
    one, bit = F.monotonically_increasing_id(), F.expr("shiftleft(1L, cast(id & 63 as int))")
    at = lambda c: F.get(c, F.col("at") - 1)
    numbers = F.sort_array(F.collect_list(F.struct("n", "id"))).getField("id")
    rare = F.count_if(F.col("n") <= HOT_TITLES).cast("int").alias("rare")
    q = records.select("record_id", "surname", F.sort_array(F.array_except(tx.tokens(F.col("title")), F.array(*map(F.lit, tx.STOP_WORDS)))).alias("q"))
    q = staged(q.where("surname is not null"), "titles-records")
    asked = staged(q.select("surname", "q").distinct().withColumn("asked", one), "titles-asked")
    p = preprints.where("surname is not null").groupBy("surname", F.sort_array(tx.tokens(F.col("title"))).alias("t")).agg(F.min("preprint_id").alias("preprint_id"))
    p = staged(p.withColumn("title", one), "titles-preprints")
    tokens = p.select("title", "surname", F.explode("t").alias("token"), "preprint_id")
    held = staged(tokens.groupBy("token", "surname").agg(F.count("*").alias("n"), F.min("preprint_id").alias("first")).withColumn("id", one), "titles-tokens")

    each = asked.select("asked", "surname", F.ceil(F.lit(threshold) * F.size("q")).cast("int").alias("need"), F.explode("q").alias("token")).join(held, ["token", "surname"])
    found = [each.where("need <= 1").select("asked", F.col("first").alias("preprint_id"))]
    own = each.where("need > 1").groupBy("asked", "need").agg(numbers.alias("q"), F.bit_or(bit).alias("bits"), rare)
    own = staged(own.withColumn("spare", F.size("q") - F.col("need")).where("spare >= 0"), "titles-own")
    useful = held.join(own.select(F.explode("q").alias("id")).distinct(), "id", "left_semi")
    titles = tokens.join(useful, ["token", "surname"]).groupBy("title", "preprint_id").agg(numbers.alias("t"), F.bit_or(bit).alias("held_bits"), rare).where("size(t) > 1")
    titles = staged(titles.repartition(p.count() // TITLES_PER_TASK + 1, "title"), "titles-numbered")

    def compare(a: DataFrame, b: DataFrame) -> None:
        """Bits that the other side lacks are missed tokens; sets are compared only where those are few enough. Titles of a key are dealt in parts of about HOT_TITLES."""
        near = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not("held_bits"))) <= F.col("spare")
        fits = F.size(F.array_intersect("q", "t")) >= F.col("need")
        a = a.select("key", "asked", "need", "spare", "bits", "q", F.explode(F.expr(f"sequence(0, (n - 1) div {HOT_TITLES})")).alias("part"))
        b = b.select("key", "preprint_id", "held_bits", "t", F.expr(f"pmod(title, (n - 1) div {HOT_TITLES} + 1)").alias("part"))
        found.append(a.join(b, ["key", "part"]).where(near & fits).select("asked", "preprint_id"))

    few = F.lit(1).alias("n")
    compare(own.select("*", few, F.explode(F.expr("slice(q, 1, least(rare, spare + 1))")).alias("key")), titles.select("*", few, F.explode(F.expr("slice(t, 1, rare)")).alias("key")))
    front = own.where("rare <= spare").withColumn("at", F.explode(F.expr("sequence(rare + 1, spare + 1)"))).withColumn("key", at("q"))
    rows = titles.where("size(t) > rare").withColumn("at", F.explode(F.expr("sequence(rare + 1, size(t))"))).withColumn("key", at("t"))
    most, size, hot = HOT_TITLES * asked.count(), 1, F.col("n") > HOT_TITLES
    while not front.isEmpty():
        size += 1
        front = front.withColumn("at", F.explode(F.sequence(F.col("at") + 1, F.col("spare") + size))).withColumn("next", at("q"))
        rows = rows.where("at < size(t)").withColumn("at", F.explode(F.expr("sequence(at + 1, size(t))"))).select("title", "preprint_id", "key", "at", at("t").alias("next"), one.alias("set"))
        of = Window.partitionBy("key", "next")
        rows = _may_be_asked(rows, front, "key", "next").select("key", "next", "title", "at", *[f.over(of).alias(c) for c, f in (("set", F.min("set")), ("n", F.count("*")), ("first", F.min("preprint_id")))])
        rows = staged(rows, "titles-sets")
        front = front.select("asked", "need", "spare", "bits", "q", "at", "key", "next").join(rows.select("key", "next", "set", "n", "first").distinct(), ["key", "next"])
        front, rows = staged(front.drop("key", "next").withColumnRenamed("set", "key"), "titles-front"), rows.select("title", "at", "n", F.col("set").alias("key"))
        found.append(front.where(F.col("need") == size).select("asked", F.col("first").alias("preprint_id")))
        front = front.where(F.col("need") > size)
        left = front.where(hot)
        if (left.agg(F.sum("n")).first()[0] or 0) <= most:
            compare(front, rows.join(titles, "title"))
            break
        compare(front.where(~hot), rows.where(~hot).join(titles, "title"))
        front, rows = left.drop("n", "first"), rows.where(hot).join(left.select("key").distinct(), "key", "left_semi").join(titles, "title")
    best = reduce(DataFrame.unionByName, found).groupBy("asked").agg(F.min("preprint_id").alias("preprint_id")).join(asked, "asked")
    return q.join(best, ["surname", "q"]).groupBy("record_id").agg(F.min("preprint_id").alias("preprint_id"))


def probe_transitions(a: DataFrame, b: DataFrame) -> DataFrame:
    j = a.select("record_id", F.col("bucket").alias("before")).join(b.select("record_id", F.col("bucket").alias("after")), "record_id", "full")
    change = F.when(F.col("before").eqNullSafe(F.col("after")), "same").when(F.col("after") == "ok", "unlocked").when(F.col("before") == "ok", "lost").otherwise("other")
    return j.withColumn("change", change).groupBy("before", "after", "change").agg(F.count("*").alias("n"))


def probe_net(transitions: DataFrame, least: float = 0.05) -> DataFrame:
    """n, unlocked, lost, net (their difference's share of all) and noise (its size is below ``least``)."""
    of = lambda change: F.coalesce(F.sum(F.when(F.col("change") == change, F.col("n"))), F.lit(0))
    one = transitions.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), of("unlocked").alias("unlocked"), of("lost").alias("lost"))
    net = F.coalesce(F.try_divide(F.col("unlocked") - F.col("lost"), F.col("n")), F.lit(0.0))
    return one.withColumn("net", F.round(net, 6)).withColumn("noise", F.abs(net) < least)


#: Integrity statuses from best to worst.
STATUS_ORDER = ("good", "image", "truncated", "zero", "error")


def union_status(frames: list[DataFrame]) -> DataFrame:
    rank = F.array_position(F.array(*map(F.lit, STATUS_ORDER)), F.col("status"))
    allof = frames[0]
    for f in frames[1:]:
        allof = allof.unionByName(f)
    return allof.groupBy("record_id").agg(F.min_by("status", F.struct(rank.alias("r"), F.col("status"))).alias("status"))


def store_gap(local: DataFrame, source: DataFrame) -> DataFrame:
    a, b = local.groupBy("store").agg(F.count("*").alias("local")), source.groupBy("store").agg(F.count("*").alias("source"))
    j = a.join(b, "store", "full").na.fill(0, ["local", "source"])
    return j.withColumn("gap", F.col("source") - F.col("local"))


def apply_canonical(records: DataFrame, picks: DataFrame) -> DataFrame:
    """The chosen file's attributes on each record; a pick without a record makes a stub."""
    p = picks.select("record_id", F.col("path").alias("p_path"), F.col("size").alias("p_size"))
    j = records.join(p, "record_id", "full")
    return j.select("record_id", "title", F.coalesce("p_path", "canonical_path").alias("canonical_path"), F.col("p_size").alias("canonical_size"), F.coalesce(F.col("p_path").isNotNull() | F.col("has_file"), F.lit(False)).alias("has_file"))


def unhashed_multi(files: DataFrame) -> DataFrame:
    many = files.groupBy("record_id").agg(F.count("*").alias("n")).where("n >= 2")
    return files.where("sha256 is null").join(many, "record_id", "left_semi")


def pending_batch(queue: DataFrame, records: DataFrame, n: int) -> DataFrame:
    """The next n pending items with what the fetch needs of their records."""
    j = queue.where("status = 'pending'").join(records.select("record_id", "doi", "year"), "record_id")
    return j.orderBy("enqueued_ts", "record_id").limit(n)


def canonical_with_year(files: DataFrame, records: DataFrame) -> DataFrame:
    return files.join(records.select("record_id", F.col("year").alias("record_year")), "record_id", "left")


def doi_urls_by_table(records: DataFrame, templates: DataFrame) -> DataFrame:
    """record_id, doi, url for each template (prefix, template) of the DOI's prefix; the rules are a table, joined on the prefix."""
    suffix = F.regexp_extract("doi", "^[^/]*/(.*)$", 1)
    j = records.select("record_id", "doi", F.substring_index("doi", "/", 1).alias("prefix")).join(templates, "prefix")
    return j.select("record_id", "doi", F.replace(F.replace("template", F.lit("{doi}"), F.col("doi")), F.lit("{suffix}"), suffix).alias("url"))


def source_plan(records: DataFrame, rules: list[tuple[str, object]]) -> DataFrame:
    """record_id, pos, source: the sources whose condition holds, in the order of the rules."""
    names = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]))
    return records.select("record_id", F.posexplode(names).alias("pos", "source"))


def pick_report_path(paths: DataFrame) -> DataFrame:
    """Each record's best report file: a report folder +10, TeX +3, a later version +1, a negative result -5; backups are out."""
    low = F.lower(F.substring_index("path", "/", -1))
    ok = F.contains(low, F.lit("report")) & F.regexp_like(low, F.lit(r"\.(tex|md)$")) & ~F.contains(low, F.lit("bak")) & ~F.startswith(low, F.lit("."))
    score = (
        F.when(F.contains("path", F.lit("/report/")) | F.endswith("path", F.lit("/REPORT.md")), 10).otherwise(0) + F.when(F.endswith(low, F.lit(".tex")), 3).otherwise(0)
        + F.when(F.regexp_like(low, F.lit("v6|v2")), 1).otherwise(0) - F.when(F.contains(low, F.lit("no-go")), 5).otherwise(0)
    )
    best = paths.where(ok).groupBy("record_id").agg(F.max(F.struct(score.alias("score"), F.col("path"))).alias("b"))
    return best.select("record_id", "b.score", "b.path")
