"""Operator 9, resolving not-modified revisits in web captures.

A revisit record holds the headers of a 304 answer and no body. It is joined, by canonical URL, to the latest earlier
full response, whose validators must agree: entity tags by weak comparison where the revisit has one, else
the modification time, else the payload digest. A resolved revisit gets the response's payload and its
headers, in which the revisit's permitted headers replace the response's.

The as-of join is two-level, so that a URL with a great part of all captures is spread over time: inside a
(URL, hour) by a window, and over a URL's hours by one row an hour. A revisit's own fields go with it; the responses'
fields and payloads don't take part and join at the end, by URL, time and record id. Revisits without an
earlier response don't join. A response of more than one in HOT_MOST revisits, of which there are fewer than HOT_MOST,
is repeated in the join for parts of its revisits, so that they are spread over tasks.

Payloads are read last: of the responses only those go into the join's shuffle that a bitmap of the found ones holds, of about eight bits
a found response and BITMAP_MOST bits at most (so it is broadcast). Beyond an eighth as many it holds ever more responses that no
revisit asks for, which the join drops, as it does those that it holds by chance.

Cases: a revisit with no canonical URL, no earlier response, no validator or one that disagrees is kept with
that status and null payload; responses at one instant rank by record id; an equal time is not earlier; a null
record id is one like others, of a revisit (kept) or a response (found, its response_id null);
repeated revisits each get their result; empty tables give no rows; other columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.staging import staged

#: Header fields that a 304 answer may update (lower case).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that don't name a resource.
TRACKING = r"^(ref|utm_[a-z]+)="
HOUR, DAY = 3_600, 86_400
HOT_MOST = 10_000
HOT_PART = 1_000
BITMAP_LEAST, BITMAP_MOST = 1 << 16, 1 << 26
CAPTURE = "record_id string, kind string, url string, ts long, etag string, last_modified string, digest string, headers map<string,string>, payload string"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path, and sorted parameters that name a resource."""
    plain = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(plain, "^([^/?]*)", 1)), r"^www\.", ""), ":(80|443)$", "")
    path = F.regexp_extract(plain, r"^[^/?]*([^?]*)", 1)
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_like(p, F.lit(TRACKING))))
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures made from a page table: each page's full response and three later or earlier revisits.

    Times follow page_id. Of the revisits, by page_id and number, some carry another entity tag, some only a
    modification time, some a digest, some no validator at all, and some come before the response.
    """
    stamp = lambda t: F.date_format(F.timestamp_seconds(t), "yyyy-MM-dd HH:mm:ss")
    p = pages.select("page_id", "url", "html").withColumn("t0", F.lit(1_700_000_000) + F.col("page_id") * 600)
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.col("html").cast("binary")), 1, 16), F.lit('"'))
    p = p.withColumn("tag", tag).withColumn("modified", stamp(F.col("t0") - DAY)).withColumn("sum", F.sha1(F.col("html").cast("binary")))
    full = p.select(
        F.concat(F.lit("full-"), "page_id").alias("record_id"), F.lit("response").alias("kind"), "url", F.col("t0").alias("ts"), F.col("tag").alias("etag"),
        F.col("modified").alias("last_modified"), F.col("sum").alias("digest"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), "tag", F.lit("date"), stamp(F.col("t0")), F.lit("cache-control"), F.lit("max-age=60")).alias("headers"),
        F.col("html").alias("payload"),
    )
    r = p.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).withColumn("case", (F.col("page_id") + F.col("n")) % 7)
    at = F.when(F.col("case") == 6, F.col("t0") - F.col("n") * 60).otherwise(F.col("t0") + F.col("n") * (DAY - 977) + 1)
    r = r.withColumn("at", at)
    other = F.concat(F.regexp_replace("url", "#.*$", ""), F.when(F.col("n") == 2, F.lit("#part")).otherwise(""))
    seen_tag = F.when(F.col("case") == 0, '"other"').when(F.col("case").isin(1, 2, 3), None).otherwise(F.when(F.col("n") == 1, F.concat(F.lit("W/"), "tag")).otherwise(F.col("tag")))
    again = r.select(
        F.concat(F.lit("again-"), "page_id", F.lit("-"), "n").alias("record_id"), F.lit("revisit").alias("kind"), other.alias("url"), F.col("at").alias("ts"), seen_tag.alias("etag"),
        F.when(F.col("case").isin(1), F.col("modified")).alias("last_modified"), F.when(F.col("case").isin(2), F.col("sum")).alias("digest"),
        F.create_map(F.lit("date"), stamp(F.col("at")), F.lit("cache-control"), F.concat(F.lit("max-age="), F.col("n") * 10), F.lit("server"), F.lit("not permitted")).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return full.unionByName(again)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def _id_key(name: str) -> Column:
    """A key that tells a null id from all others and is not null itself."""
    return F.coalesce(F.concat(F.lit("="), name), F.lit(""))


def asked_for(responses: DataFrame, asked: DataFrame) -> DataFrame:
    """The ``responses`` whose key ``one`` is among those of ``asked``, and few others: a bitmap of the keys' low bits decides, in words of 64 bits."""
    keys = asked.select("one").distinct()
    size = min(max(BITMAP_LEAST, 8 << keys.count().bit_length()), BITMAP_MOST)
    word = F.shiftrightunsigned(F.col("one").bitwiseAND(F.lit(size - 1)), 6)
    bit = F.expr("shiftleft(1L, cast(one & 63 as int))")
    bits = keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    bits = F.broadcast(staged(bits, "revisits-asked"))
    return responses.withColumn("word", word).join(bits, "word").where(bit.bitwiseAND(F.col("bits")) != 0).drop("word", "bits")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """record_id, canonical_url, ts, response_id, status, headers and payload of every revisit."""
    own = F.when(F.col("kind") == "revisit", F.struct("etag", "last_modified", "digest", "headers", F.monotonically_increasing_id().alias("row")))
    light = captures.select("record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), "ts", F.floor(F.col("ts") / HOUR).alias("hour"), own.alias("own"))
    mark = F.when(F.col("kind") == "response", F.struct("ts", "record_id"))
    timed = light.where("canonical_url is not null and ts is not null")
    earlier = Window.partitionBy("canonical_url", "hour").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = timed.withColumn("near", F.max(mark).over(earlier)).where("kind = 'revisit'")
    hours = timed.groupBy("canonical_url", "hour").agg(F.max(mark).alias("last"))
    before = Window.partitionBy("canonical_url").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select("canonical_url", "hour", F.max("last").over(before).alias("far")).where("far is not null")
    at = F.coalesce("near", "far")
    found = near.join(hours, ["canonical_url", "hour"], "left").select("record_id", "canonical_url", "ts", "own", at["record_id"].alias("response_id"), at["ts"].alias("response_ts"))
    lost = light.where("kind = 'revisit' and (canonical_url is null or ts is null)")
    lost = lost.select("record_id", "canonical_url", "ts", "own", F.lit(None).cast("string").alias("response_id"), F.lit(None).cast("long").alias("response_ts"))
    found = found.unionByName(lost).select("record_id", "canonical_url", "ts", "own.etag", "own.last_modified", "own.digest", F.col("own.headers").alias("new_headers"), "own.row", "response_id", "response_ts")
    found = staged(found.withColumn("key", _id_key("response_id")), "revisits-found")

    full = captures.where("kind = 'response'").select(
        canonical_url(F.col("url")).alias("r_url"), F.col("ts").alias("r_ts"), _id_key("record_id").alias("r_key"),
        F.col("etag").alias("r_etag"), F.col("last_modified").alias("r_modified"), F.col("digest").alias("r_digest"),
        F.col("headers").alias("old_headers"), F.col("payload").alias("r_payload"),
    )
    full = full.where("r_url is not null and r_ts is not null")
    one = F.xxhash64("canonical_url", "response_ts", "key")
    linked = found.where("response_ts is not null").withColumn("one", one)
    least = max(HOT_PART, linked.count() // HOT_MOST)
    hot = linked.groupBy("one").agg(F.count("*").alias("n")).where(F.col("n") > least)
    hot = F.broadcast(staged(hot.select("one", F.ceil(F.col("n") / least).cast("int").alias("parts")), "revisits-hot"))
    linked = linked.join(hot, "one", "left").withColumn("part", F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1))).cast("int"))
    full = asked_for(full.withColumn("one", F.xxhash64("r_url", "r_ts", "r_key")), linked).join(hot, "one", "left")
    full = full.withColumn("r_part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    # a record id names one record, and so do URL and time where there is none; grouped by the columns of the join, payloads are dealt out once
    parts = ("r_etag", "r_modified", "r_digest", "old_headers", "r_payload")
    full = full.groupBy("r_url", "r_ts", "r_key", "r_part").agg(F.max_by(F.struct(*parts), F.struct(*parts[:3], F.xxhash64("r_payload").alias("sum"))).alias("x"))
    full = full.select("r_url", "r_ts", "r_key", "r_part", "x.*")
    same = (F.col("canonical_url") == F.col("r_url")) & (F.col("response_ts") == F.col("r_ts")) & (F.col("key") == F.col("r_key")) & (F.col("part") == F.col("r_part"))
    both = linked.drop("one", "parts").join(full, same, "left").unionByName(found.where("response_ts is null"), allowMissingColumns=True)
    agrees = (
        F.when(F.col("etag").isNotNull(), _weak(F.col("etag")) == _weak(F.col("r_etag")))
        .when(F.col("last_modified").isNotNull(), F.col("last_modified") == F.col("r_modified"))
        .when(F.col("digest").isNotNull(), F.col("digest") == F.col("r_digest"))
    )
    none = F.col("etag").isNull() & F.col("last_modified").isNull() & F.col("digest").isNull()
    status = F.when(F.col("response_ts").isNull(), "no_earlier_response").when(none, "no_validator").when(F.coalesce(agrees, F.lit(False)), "resolved").otherwise("validator_mismatch")
    both = both.withColumn("status", status)
    empty = F.create_map().cast("map<string,string>")
    permitted = F.map_filter(F.coalesce("new_headers", empty), lambda k, v: F.lower(k).isin(*PERMITTED))
    rest = F.map_filter(F.coalesce("old_headers", empty), lambda k, v: ~F.array_contains(F.transform(F.map_keys(permitted), lambda x: F.lower(x)), F.lower(k)))
    resolved = F.col("status") == "resolved"
    return both.select(
        "record_id", "canonical_url", "ts", "response_id", "status",
        F.when(resolved, F.map_concat(rest, permitted)).alias("headers"), F.when(resolved, F.col("r_payload")).alias("payload"),
    )


def revisit_digest(pages: DataFrame) -> DataFrame:
    """Every revisit's answer, its headers as sorted lines and its payload as length and MD5."""
    r = resolve_revisits(captures_of_pages(pages))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(F.lower(e["key"]), F.lit(": "), e["value"]))), "; ")
    return r.select(
        "record_id", "canonical_url", "ts", "response_id", "status", lines.alias("headers"),
        F.length("payload").cast("long").alias("payload_chars"), F.md5(F.col("payload").cast("binary")).alias("payload_md5"),
    )
