"""Golden rows, invariants and idempotence of catalog operators, and the queries against their SQL."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions import ids
from shelfmark.functions import text as tx
from shelfmark.operators import merges, reports, windows
from shelfmark.plans import queries as q
from shelfmark.sources import readers
from shelfmark.streaming import streams

SF = "/root/testdata/sf0.001"


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(("name", "mode", "want"), [("a/123.PDF", "suffix", "123"), ("abc.pdf", "suffix", None), ("PDF-4_1339457_x", "digits", "1339457"), ("2101.00001", "digits", None)])
def test_record_ids(spark, name, mode, want):
    assert one(spark, name, "string", lambda c: ids.record_id_from_name(c, mode)) == want


@pytest.mark.parametrize(("date", "mode", "want"), [("2020-04-15T00:00:00Z", "robust", 2020), ("04/15/2020", "catalog", 2020), ("2020", "catalog", None), ("2020", "lookup", 2020), ("n.d.", "robust", None), (None, "robust", None), ("04/15/2020", "layout", None)])
def test_years(spark, date, mode, want):
    assert one(spark, date, "string", lambda c: ids.pub_year(c, mode)) == want


@pytest.mark.parametrize(("raw", "first"), [("10.1234/abc.", "10.1234/abc"), ("10.1234/abc", "10.1234/abc")])
def test_doi_candidates(spark, raw, first):
    assert first in one(spark, raw, "string", ids.doi_candidates)


@pytest.mark.parametrize(
    ("raw", "primary", "extras"),
    [("a@x.org or b@y.org", "a@x.org", ["b@y.org"]), ("a@x.org; b@y.org", "a@x.org", ["b@y.org"]), ("a@x.org, b@y.org, c@z.org", "a@x.org", ["b@y.org", "c@z.org"]), ("<a@x.org>", "a@x.org", []), ("a@x.org", "a@x.org", []), ("", "", []), (None, None, []), ("nobody", "nobody", [])],
)
def test_split_addresses(spark, raw, primary, extras):
    x = one(spark, raw, "string", tx.split_multi_email)
    assert (x["primary"], x["extras"]) == (primary, extras)


def test_no_address_is_lost(spark):
    many = "; ".join(f"a{i}@x.org" for i in range(1500))
    x = one(spark, many, "string", tx.split_multi_email)
    assert len(x["extras"]) == 1499 and x["extras"][-1] == "a1499@x.org"
    assert one(spark, "z" * 5000 + " late@x.org", "string", tx.extract_emails) == ["late@x.org"]


def test_tables_of_a_run_need_a_shared_folder():
    from types import SimpleNamespace

    from shelfmark.session import shared_folder

    unset = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: unset, master="spark://host:7077"), conf=unset)
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_folder(cluster)
    named = SimpleNamespace(get=lambda *_: "hdfs://n/x/")
    assert shared_folder(SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: named))) == "hdfs://n/x"


def test_hidden_address(spark):
    assert one(spark, "write to ann at example dot org", "string", tx.extract_emails) == ["ann@example.org"]


def test_title_scores(spark):
    rows = [(1, "The  Great Title here", "great title"), (2, "nothing alike", "zzz"), (3, None, "x"), (4, "abcd", "abce")]
    got = {x["i"]: x["title_score"] for x in tx.title_scores(spark.createDataFrame(rows, "i int, text string, title string")).collect()}
    assert got[1] == 1.0 and got[3] == 0.0 and 0.7 < got[4] < 0.8


def test_block_upsert_is_idempotent(spark):
    body = "text"
    first = one(spark, body, "string", lambda c: tx.upsert_block(c, F.lit("new"), "<s>", "</s>"))
    again = one(spark, first["text"], "string", lambda c: tx.upsert_block(c, F.lit("new"), "<s>", "</s>"))
    assert (first["status"], again["status"], again["text"]) == ("inserted", "idempotent", first["text"])


def test_merges_twice_change_nothing(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (3, "d")], "k int, v string")
    once = merges.insert_ignore(old, new, "k")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, merges.insert_ignore(once, new, "k").collect()))
    plain = merges.insert_replace(new, ["k"], [F.desc("v")])
    up = merges.upsert(old, plain, "k", ["v"], [], [])
    twice = merges.upsert(up.drop("change"), plain, "k", ["v"], [], [])
    assert sorted(map(tuple, up.drop("change").collect())) == sorted(map(tuple, twice.drop("change").collect()))


def test_exclusion_keeps_every_row_once(spark):
    r = spark.createDataFrame([("1", "Dataset"), ("2", None), ("3", "Thesis")], "record_id string, product_type string")
    left, decisions = merges.exclude_records(r, F.col("product_type") == "Dataset", "t")
    assert left.count() + decisions.count() == r.count() and decisions.first()["record_id"] == "1"


def test_canonical_methods(spark):
    rows = [
        (1, "a", "alpha", "p1", 10, "h", 0.0), (2, "b", "alpha", "p2", 0, "h", 0.0), (3, "b", "beta", "p3", 9, "g", 0.0), (4, "c", "beta", "p4", 5, "s", 0.0), (5, "c", "alpha", "p5", 5, None, 0.0),
        (6, "d", "alpha", "p6", 5, "x", 0.49), (7, "d", "beta", "p7", 6, "y", 0.5), (8, "e", "beta", "p8", 5, "x", 0.0), (9, "e", "alpha", "p9", 7, "y", None), (10, "f", "gamma", "p", 7, "x", 0.0), (11, "f", "beta", "q", 7, "y", 0.0),
        (12, "g", "beta", "r", 3, "x", 0.9), (13, "g", "alpha", "s", 8, "y", 0.9), (14, "h", "other", "t", 4, None, 0.0), (15, "h", "gamma", "u", 4, None, 0.0), (16, "z", "alpha", "v", None, None, 0.0),
    ]
    f = spark.createDataFrame(rows, "instance_id long, record_id string, source string, path string, size long, sha256 string, title_score double")
    picks = windows.pick_canonical(f, q.PRIORITIES)
    got = {x["record_id"]: (x["instance_id"], x["method"], x["confidence"]) for x in picks.collect()}
    assert got == {
        "a": (1, "single_instance", 1.0), "b": (3, "single_instance", 1.0), "c": (5, "duplicate_byte_identical", 1.0), "d": (7, "title_extract_match", 0.5),
        "e": (9, "size_largest", 0.8), "f": (11, "source_priority", 0.6), "g": (13, "title_extract_match", 0.9), "h": (15, "source_priority", 0.6),
    }
    assert sorted(x["instance_id"] for x in windows.rejected_files(f, picks).collect()) == [4, 6, 8, 10, 12, 14]


@pytest.mark.parametrize(
    ("raw", "key", "want"),
    [('{"a": 1}', "a", "1"), ('```json\n{"a": "x"}\n```', "a", "x"), ('ok {"note": "{x}", "a": 2}', "a", "2"), ('{"a": true, "b": "of', "a", "true"), ("nothing", "a", None), (None, "a", None)],
)
def test_answers(spark, raw, key, want):
    x = tx.parse_answers(spark.createDataFrame([(raw,)], "raw string"), "raw").first()
    assert (x["answer"][key] if x["answer"] else None) == want and (x["error"] is None) == (want is not None)


def test_hash_slice_is_exact(spark):
    import hashlib

    for text in ("a", "xyz", ""):
        assert one(spark, text, "string", lambda c: windows.hash_slice(c, 97)) == int(hashlib.sha256(text.encode()).hexdigest(), 16) % 97


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/12.PDF", "a/x.pdf", "3.pdf", "4.txt"):
        (tmp_path / name).write_bytes(b"%PDF")
    assert readers.scan_files(spark, str(tmp_path), "s").count() == 2
    (tmp_path / "Org_Name__2020.jsonl").write_text('{"record_id": "1"}\nnot json\n{"record_id": "2"}\n')
    schema = spark.createDataFrame([], "record_id string").schema
    assert readers.read_jsonl(spark, str(tmp_path / "Org_Name__2020.jsonl"), schema).count() == 2
    shards = readers.read_org_year_shards(spark, str(tmp_path / "*.jsonl"), schema).collect()
    assert {(x["org"], x["year"]) for x in shards} == {("Org Name", 2020)} and len(shards) == 2
    df = spark.createDataFrame([('---\n{"k": "v"}\n---\nbody',), ("plain",)], "t string")
    got = readers.split_front_matter(df, "t", spark.createDataFrame([], "k string").schema).collect()
    assert {(x["front"]["k"] if x["front"] else None, x["body"]) for x in got} == {("v", "body"), (None, "plain")}


def test_streams_equal_their_batch_twins(spark, tmp_path):
    t = q.Tables(spark, SF)
    t.attempts.select("ts", "source", "http_status", "record_id").withColumn("ts", F.col("ts").cast("timestamp")).repartition(3).write.parquet(str(tmp_path / "in"))
    batch = spark.read.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    run = streams.progress(stream).writeStream.format("memory").queryName("progress").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted(map(tuple, spark.table("progress").collect())) == sorted(map(tuple, streams.progress(batch).collect()))


def test_breaker(spark, tmp_path):
    rows = [(i, "s", 503) for i in range(12)] + [(i, "t", 503 if i % 2 else 200) for i in range(12)]
    df = spark.createDataFrame(rows, "i int, source string, http_status int").select(F.timestamp_seconds("i").alias("ts"), "source", "http_status")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    run = streams.breaker(stream).writeStream.format("memory").queryName("breaker").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    assert [(x["source"], x["state"]) for x in spark.table("breaker").collect()] == [("s", "disabled")]


def test_resumed_stream_gives_each_id_once(spark, tmp_path):
    df = spark.createDataFrame([(i, f"r{i % 4}") for i in range(12)], "i int, record_id string").select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i")).alias("ts"), "record_id").coalesce(1)

    def run():
        stream = streams.stream_todo(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
        return sorted(x["record_id"] for x in spark.read.parquet(str(tmp_path / "out")).collect())

    df.write.parquet(str(tmp_path / "in"))
    assert run() == ["r0", "r1", "r2", "r3"]
    df.unionByName(df.limit(1).withColumn("record_id", F.lit("new"))).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == ["new", "r0", "r1", "r2", "r3"]


def test_run_record_and_missing_columns(spark):
    now = datetime(2024, 1, 1)
    x = merges.run_record(spark, "import", {"a": "b"}, {"added": 2}, now, now, "n").first()
    assert (x["run_type"], x["params"], x["added"], x["updated"], x["errors"], x["notes"]) == ("import", {"a": "b"}, 2, 0, 0, "n")
    with pytest.raises(ValueError):
        schemas.ensure_columns(spark.createDataFrame([(1,)], "a int"), schemas.FILES, ("record_id",))


def test_consensus_of_spread_scores(spark):
    s = spark.createDataFrame([(1, "a", "YES", 1.0), (1, "b", "NO", 5.0), (1, "c", "NO", 9.0)], "item_id int, judge string, verdict string, score double")
    x = reports.consensus(s).first()
    assert (x["score"], x["flagged"], x["verdict"]) == (5.0, True, "NO")


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df = q.queries()[name](spark, SF)
    want = con.sql(q.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)

    def plain(rows, names):
        at = [names.index(c) for c in columns]
        tidy = lambda v: round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) or type(v).__name__ == "Decimal" else str(v)
        return sorted([tuple(tidy(r[i]) for i in at) for r in rows], key=repr)

    assert plain(df.collect(), df.columns) == plain(want.fetchall(), want.columns)


def test_breaker_enables_again(spark, tmp_path):
    at = lambda rows: spark.createDataFrame(rows, "i int, source string, http_status int").select(F.timestamp_seconds(F.col("i") + 100_000).alias("ts"), "source", "http_status")
    # s fails twelve times, goes on failing while disabled, and comes back after the cooldown; t never fails eleven times in a row
    rows = [(i, "s", 503) for i in range(30)] + [(700, "s", 200)] + [(i, "t", 503 if i % 2 else 200) for i in range(30)]
    at(rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, source string, http_status int").parquet(str(tmp_path / "in"))

    def run():
        streams.breaker(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination(120)
        return sorted((x["source"], int(x["ts"].timestamp()) - 100_000, x["state"]) for x in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == [("s", 10, "disabled"), ("s", 610, "enabled")]
    # disabled again, and enabled by the watermark alone
    at([(i, "s", 500) for i in range(800, 811)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run()[-1] == ("s", 810, "disabled")
    at([(5000, "t", 200)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run()[-2:] == [("s", 810, "disabled"), ("s", 1410, "enabled")]


def test_todo_stream_forgets_nothing(spark, tmp_path):
    made = lambda rows: spark.createDataFrame(rows, "i int, record_id string").select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i")).alias("ts"), "record_id").coalesce(1)
    done = spark.createDataFrame([("old",)], "record_id string")
    made([(0, "a"), (1, "old")]).write.parquet(str(tmp_path / "in"))

    def run():
        stream = streams.stream_todo(spark.readStream.schema("ts timestamp, record_id string").parquet(str(tmp_path / "in")), done)
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
        return sorted(x["record_id"] for x in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == ["a"]
    made([(7200, "a"), (7201, "b")]).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == ["a", "b"]


def test_maintained_queue_equals_the_batch_one(spark, tmp_path):
    t = q.Tables(spark, SF)
    rows = t.bucketed.withColumn("ts", F.col("ts").cast("timestamp"))
    rows.where("attempt_id % 2 = 0").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))

    def run():
        streams.maintain_queue(stream, str(tmp_path / "queue"), str(tmp_path / "at"), buckets=8).trigger(availableNow=True).start().awaitTermination()
        got = streams.kept_queue(rows, str(tmp_path / "queue"), buckets=8)
        want = streams.queue_from_attempts(spark.read.parquet(str(tmp_path / "in")))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))

    run()
    rows.where("attempt_id % 2 = 1 and record_id < '3'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()


def test_queue_states(spark):
    rows = [("a", 1, "x", "not_found"), ("a", 2, "y", "other"), ("b", 1, "x", "empty"), ("b", 2, "y", "empty"), ("c", 1, "x", "empty"), ("d", 1, streams.NO_LOOKUP, "timeout_or_exception")]
    df = spark.createDataFrame([(r, i, s, b, f"e{i}") for r, i, s, b in rows], "record_id string, attempt_id int, source string, bucket string, error string").withColumn("ts", F.timestamp_seconds("attempt_id"))
    got = {x["record_id"]: (x["status"], x["reason"], x["last_error"], x["resolved_via"], x["attempts"]) for x in streams.queue_from_attempts(df, ("x", "y")).collect()}
    assert got == {"a": ("recovered", "not_found", "e1", "y", 2), "b": ("exhausted", "empty", "e2", None, 2), "c": ("pending", "empty", "e1", None, 1), "d": ("failed_no_doi", "timeout_or_exception", "e1", None, 1)}


def test_ranks_of_few_keys(spark):
    rows = [(i, i % 2 if i % 7 else None, f"t{i * 7919 % 1000:04d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "i int, k int, name string")
    for descending in (False, True):
        for tie in ("name", "i"):
            got = {x["i"]: x["rank"] for x in windows.global_rank(df, "k", tie, descending, 16).collect()}
            order = sorted(rows, key=lambda r: (r[1] is None, (-r[1] if descending else r[1]) if r[1] is not None else 0, r[2] if tie == "name" else r[0]))
            assert got == {r[0]: n for n, r in enumerate(order, 1)}


def test_runs_over_days(spark):
    status = [500] * 3 + [200] + [500] * 9 + [200] * 2 + [500] * 4
    rows = [(i, "s", i * 20_000, x) for i, x in enumerate(status)] + [(100, "u", 0, 200), (101, "v", 5, 503)]
    df = spark.createDataFrame(rows, "attempt_id int, source string, at int, http_status int").withColumn("ts", F.timestamp_seconds("at"))
    assert {(x["source"], x["longest"]) for x in windows.consecutive_errors(df).collect()} == {("s", 9), ("v", 1)}


def test_first_success_counts_what_came_before(spark):
    rows = [("a", 1, 10, False), ("a", 2, 10, True), ("a", 3, 5, False), ("a", 4, 20, False), ("b", 5, 1, True), ("c", 6, 1, False)]
    df = spark.createDataFrame(rows, "record_id string, attempt_id int, at int, ok boolean").withColumn("ts", F.timestamp_seconds("at")).withColumn("source", F.concat(F.lit("s"), "attempt_id"))
    assert {tuple(x) for x in windows.first_success(df).collect()} == {("a", "s2", 2), ("b", "s5", 0)}


@pytest.mark.parametrize(
    ("raw", "want"),
    [("10.1234/abc5Abstract", ["10.1234/abc5Abstract", "10.1234/abc5", "10.1234/abc5Abstrac", "10.1234/abc5Abstra", "10.1234/abc5Abstr"]), ("10.1234/abc).}", ["10.1234/abc).}", "10.1234/abc"]), ("x", [])],
)
def test_doi_candidates_in_order(spark, raw, want):
    assert one(spark, raw, "string", ids.doi_candidates) == want


def test_sources_and_sinks(spark, tmp_path):
    schema = spark.createDataFrame([], "record_id string, n int").schema
    rows = spark.createDataFrame([("1", 2), ("3", 4)], schema)
    readers.append_results(rows, str(tmp_path / "rows"))
    readers.append_results(rows, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 4
    for fmt, sep in (("csv", ","), ("tsv", "\t")):
        readers.write_report(rows.select("n", "record_id"), str(tmp_path / fmt), ["record_id", "n"], fmt)
        assert sorted(map(tuple, readers.read_delimited(spark, str(tmp_path / fmt), schema, sep).collect())) == [("1", 2), ("3", 4)]
    readers.write_report(rows, str(tmp_path / "json"), ["n"], "json")
    assert spark.read.json(str(tmp_path / "json")).columns == ["n"]
    (tmp_path / "short.tsv").write_text("record_id\tn\n1\t2\nonly\n5\t6\n")
    assert sorted(x["record_id"] for x in readers.read_delimited(spark, str(tmp_path / "short.tsv"), schema).collect()) == ["1", "5"]
    (tmp_path / "12_final.txt").write_text("whole\ntext")
    assert [tuple(x) for x in readers.read_documents(spark, str(tmp_path / "12_*.txt")).collect()] == [("12", "12_final", "whole\ntext")]
    (tmp_path / "a.bin").write_bytes(b"%PDF-1")
    x = readers.read_payloads(spark, str(tmp_path / "a.bin")).first()
    assert (x["size"], x["magic"], len(x["sha256"])) == (6, "25504446", 64)
    log = readers.parse_run_log(spark.createDataFrame([("n=3 ok=2.5 end",)], "value string")).collect()
    assert [(x["key"], x["value"]) for x in log] == [("n", 3.0), ("ok", 2.5)]
    rows.write.parquet(str(tmp_path / "cat" / "records.parquet"))
    assert readers.read_catalog(spark, str(tmp_path / "cat"), ("records",))["records"].count() == 2
    page = '<meta name="citation_author" content="Doe, Ann"><meta name="citation_doi" content="10.1/x"><meta name="citation_pdf_url" content="u.pdf">'
    got = readers.extract_page_meta(spark.createDataFrame([(1, page)], "page_id int, html string")).first()
    assert (got["surname"], got["doi"], got["document_url"]) == ("Doe", "10.1/x", "u.pdf")
