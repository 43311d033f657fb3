"""Cases of the reviewer's findings: each failed before its change."""

from __future__ import annotations

import random
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import index, jobs, joins, search
from shelfmark.plans import queries as q
from shelfmark.session import shared_folder
from shelfmark.sources import readers
from shelfmark.streaming import streams


def against_sql(spark, folder, name):
    """The query's rows and its SQL's, for the tables that lie in the folder."""
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    got = q.queries()[name](spark, str(folder))
    sql = con.execute(q.oracle_sql()[name])
    names = [x[0] for x in sql.description]
    return sorted(map(repr, map(tuple, got.select(names).collect()))), sorted(map(repr, sql.fetchall()))


@pytest.mark.parametrize("name", ["b30_emails", "m5_contacts", "m5_contact_bindings"])
def test_a_word_at_before_a_dotted_one_is_no_address_for_the_queries(spark, tmp_path, name):
    texts = ["see reston at leosrm.25@mail4.example.com", "it was at 10.1.2.3", "ann at example dot org", "a@x.org or b@y.org, a@x.org", None]
    spark.createDataFrame([(i, x, "src1") for i, x in enumerate(texts)], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "Smith")], "c_custkey long, c_name string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.sql("select 1L as event_id, 2L as user_id, timestamp'2024-01-01' as ts, 'click' as event_type, 1.0D as value").write.parquet(str(tmp_path / "events.parquet"))
    spark.sql("select 1L as doc_id").selectExpr("doc_id", "1 as quality").write.parquet(str(tmp_path / "labels.parquet"))
    got, want = against_sql(spark, tmp_path, name)
    assert got == want and len(want) == (2 if name == "b30_emails" else 3)


def test_files_are_named_by_tasks_and_not_by_the_driver(spark, tmp_path, monkeypatch):
    from shelfmark.plans import file_queries

    rows = spark.range(300).selectExpr("concat('n', id % 150) as name", "concat('v', id) as value")
    calls = []
    monkeypatch.setattr(readers, "file_system", lambda *a: calls.append(a))
    monkeypatch.setattr(file_queries, "file_system", lambda *a: calls.append(a), raising=False)
    folder = file_queries._named_files(rows, str(tmp_path / "x"), ".txt")
    files = {x.name: sorted(x.read_text().split()) for x in (tmp_path / "x" / "named").iterdir()}
    assert folder == str(tmp_path / "x" / "named") and not calls
    assert files == {f"n{i}.txt": sorted([f"v{i}", f"v{i + 150}"]) for i in range(150)}


def test_a_glob_lists_its_folder_once_and_no_deeper(spark, tmp_path):
    for name in ("a.bin", "b 1%.bin", "c.txt", "sub/d.bin", "k=1/e.bin"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    got = readers.read_payloads(spark, f"{tmp_path}/*.bin")
    assert {x["path"].rsplit("/", 1)[1] for x in got.collect()} == {"a.bin", "b 1%.bin"}
    roots = got._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location().rootPaths()
    assert roots.size() == 1


@pytest.mark.parametrize("kind", [search.POSTINGS, search.TERM_SETS, search.TRIGRAMS])
def test_an_index_makes_keys_once_and_deals_texts_not_rows_to_tasks(spark, kind, monkeypatch):
    monkeypatch.setattr(index, "DOCS_PER_TASK", 5)
    made, tasks = [], []
    watched = index.Kind(kind.name, kind.key, lambda docs: made.append(docs.rdd.getNumPartitions()) or kind.build(docs))
    kept = index.Index(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}", watched)
    monkeypatch.setattr(index.Index, "_row_schema", lambda self: ", ".join([f"{x.name} {x.dataType.simpleString()}" for x in kind.build(spark.createDataFrame([], "doc_id long, text string")).schema] + ["folder int"]))
    write = index.Index._write_rows
    monkeypatch.setattr(index.Index, "_write_rows", lambda self, rows, batch: tasks.append(rows.rdd.getNumPartitions()) or write(self, rows, batch))
    docs = spark.createDataFrame([(i, f"alpha beta{i} beta{i} gamma") for i in range(20)] + [(20, None)], "doc_id long, text string")
    kept.refresh(docs.selectExpr("*", "1L as mtime"))
    assert made == tasks == [5]
    plain = kind.build(docs)
    assert sorted(map(repr, kept.rows().select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    want = {x["doc_id"]: x["n"] for x in plain.groupBy("doc_id").agg({kind.key: "count"}).toDF("doc_id", "n").collect()} if kind is not search.POSTINGS else dict.fromkeys(range(20), 3)
    assert {x["doc_id"]: x["n_keys"] for x in kept.docs().collect()} == want | {20: 0}


@pytest.mark.parametrize("threshold", [0.7, 1.0, 0.34])
def test_titles_that_meet_in_pairs_of_frequent_tokens_match_as_by_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(joins, "HOT_TITLES", 4)
    rnd = random.Random(14)
    title = lambda: [f"t{int(20 * rnd.random() ** 2)}" for _ in range(rnd.randrange(1, 8))]
    records, preprints = [(i, set(title())) for i in range(80)], [(i, set(title())) for i in range(120)]
    want = {str(i): min(found) for i, own in records if (found := [k for k, other in preprints if len(own & other) >= threshold * len(own)])}
    a = spark.createDataFrame([(str(i), "Smith", " ".join(x)) for i, x in records], "record_id string, surname string, title string")
    b = spark.createDataFrame([(i, "Smith", " ".join(x)) for i, x in preprints], "preprint_id long, surname string, title string")
    assert {x["record_id"]: x["preprint_id"] for x in joins.match_titles(a, b, threshold).collect()} == want


def test_titles_that_share_frequent_pairs_are_compared_with_few(spark, monkeypatch):
    """Counts how often two sets are compared, by their bits or as sets: 3 pairs of some 300 titles each a record before, a few sets of 10 titles now."""
    monkeypatch.setattr(joins, "HOT_TITLES", 10)
    rnd, calls = random.Random(15), {name: spark.sparkContext.accumulator(0) for name in ("array_intersect", "bit_count")}
    both, bits = F.udf(lambda a, b: calls["array_intersect"].add(1) or [str(x) for x in a if x in b], "array<string>"), F.udf(lambda x: calls["bit_count"].add(1) or (x & (1 << 64) - 1).bit_count(), "int")
    title = lambda: sorted(rnd.sample([f"t{i}" for i in range(14)], 6))
    records, preprints = [(i, title()) for i in range(200)], [(i, title()) for i in range(2000)]
    asked, held = {tuple(x) for _, x in records}, {tuple(x): i for i, x in reversed(preprints)}
    want = {str(i): min(found) for i, own in records if (found := [k for other, k in held.items() if len({*own} & {*other}) >= 5])}
    a = spark.createDataFrame([(str(i), "Smith", " ".join(x)) for i, x in records], "record_id string, surname string, title string")
    b = spark.createDataFrame([(i, "Smith", " ".join(x)) for i, x in preprints], "preprint_id long, surname string, title string")
    monkeypatch.setattr(F, "array_intersect", both)
    monkeypatch.setattr(F, "bit_count", bits)
    assert {x["record_id"]: x["preprint_id"] for x in joins.match_titles(a, b).collect()} == want and len(want) > 100
    assert max(x.value for x in calls.values()) <= 60 * len(asked)


@pytest.mark.parametrize("threshold", [0.7, 1.0, 0.34])
def test_titles_that_meet_in_sets_of_any_size_match_as_by_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(joins, "HOT_TITLES", 1)
    monkeypatch.setattr(joins, "TITLES_PER_TASK", 50, raising=False)
    monkeypatch.setattr(joins, "BITMAP_LEAST", 64, raising=False)
    monkeypatch.setattr(joins, "BITMAP_MOST", 64, raising=False)
    rnd = random.Random(16)
    title = lambda most: [f"t{int(90 * rnd.random() ** 2)}" for _ in range(rnd.randrange(0, most))]
    names = lambda: rnd.choice(["Smith", "Smith", "Lee", None])
    records, preprints = [(i, names(), set(title(10))) for i in range(150)], [(i, names(), set(title(30))) for i in range(250)]
    want = {str(i): min(found) for i, name, own in records if own and (found := [k for k, other, x in preprints if name and name == other and len(own & x) >= threshold * len(own)])}
    a = spark.createDataFrame([(str(i), name, " ".join(x)) for i, name, x in records], "record_id string, surname string, title string")
    b = spark.createDataFrame([(i, name, " ".join(x)) for i, name, x in preprints], "preprint_id long, surname string, title string")
    assert {x["record_id"]: x["preprint_id"] for x in joins.match_titles(a, b, threshold).collect()} == want and len(want) > 20


def _attempts(spark, rows):
    schema = "attempt_id long, record_id string, ts timestamp, source string, http_status int, bytes long, saved_path string, error string"
    return spark.createDataFrame(rows, schema.replace("ts timestamp", "ts string")).withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize("sources", [(), ("x",), ("x", "y"), ("x", "y", "x")])
def test_pending_records_are_those_of_the_queue(spark, sources):
    rnd = random.Random(14)
    pick = lambda: (rnd.choice(["x", "y", "z", None]) if rnd.random() < 0.9 else streams.NO_LOOKUP, rnd.choice(["other", "empty", "not_found", "forbidden", None]))
    rows = [(i, str(rnd.randrange(150)) if i % 40 else None, *pick()) for i in range(400)]
    df = spark.createDataFrame(rows, "attempt_id long, record_id string, source string, bucket string").withColumn("ts", F.timestamp_seconds("attempt_id"))
    want = [x["record_id"] for x in streams.queue_from_attempts(df, sources).where("status = 'pending'").collect()]
    assert sorted(map(repr, want)) == sorted(repr(x["record_id"]) for x in streams.pending_records(df, sources).collect()) and len(want) > 20


def test_a_success_without_a_source_is_a_success(spark):
    rows = [(1, "a", "2024-01-01", None, 200, 5000, "/s", None), (2, "a", "2024-01-02", "x", 404, 0, None, None), (3, "b", "2024-01-02", "x", 404, 0, None, None)]
    records = spark.createDataFrame([("a", None, "Thesis", 2020), ("b", None, "Thesis", 2020)], "record_id string, doi string, product_type string, year int")
    out = jobs.recovery(records, _attempts(spark, rows), spark.createDataFrame([], "record_id string, size long"), [("x", F.lit(True)), ("y", F.lit(True))])
    assert {x["record_id"]: x["status"] for x in out["queue"].collect()} == {"a": "recovered", "b": "pending"}
    assert {x["record_id"] for x in out["plan"].collect()} == {"b"}


@pytest.mark.parametrize("table", ["urls", "plan", "scope"])
def test_attempts_are_aggregated_before_they_are_shuffled_or_sorted(spark, table):
    attempts = _attempts(spark, [(i, str(i // 3), "2024-01-01", "x", 404, 0, None, None) for i in range(30)])
    records = spark.createDataFrame([(str(i), f"10.1/{i}", "Thesis", 2020) for i in range(12)], "record_id string, doi string, product_type string, year int")
    files = spark.createDataFrame([("1", 5), ("2", 0)], "record_id string, size long")
    lookups = spark.createDataFrame([(str(i), "u", None, None, None) for i in range(12)], "record_id string, best_pdf string, others array<string>, best_url string, links array<struct<url:string,content_type:string,intended:string>>")
    templates = spark.createDataFrame([("10.1", "https://t/{doi}")], "prefix string, template string")
    out = jobs.recovery(records, attempts, files, [("x", F.lit(True)), ("y", F.lit(True))], lookups, templates)[table]
    got = [tuple(x) for x in out.collect()]
    left = [str(i) for i in range(10) if i != 1]
    want = {"urls": [(i, 0, "open_access", "u") for i in left] + [(i, 2, "template", f"https://t/10.1/{i}") for i in left], "plan": [(i, k, x) for i in left for k, x in enumerate("xy")], "scope": [(True, False, 9)]}
    assert sorted(got) == sorted(want[table])

    def above(node, path):
        """The nodes over each leaf that holds attempts, the nearest first."""
        if not node.children().size():
            return [path] if "http_status" in node.output().mkString(",") else []
        children = [node.children().apply(i) for i in range(node.children().size())]
        return [x for child in children for x in above(child, [node.nodeName(), *path])]

    found = above(out._jdf.queryExecution().optimizedPlan(), [])
    assert found and all("Aggregate" in x[: next(i for i, name in enumerate([*x, "Join"]) if name in ("Join", "Sort"))] for x in found)
