"""Kept tables and runs: merges against a plain twin, files that stay, batches applied twice, streams without state."""

from __future__ import annotations

import bisect
import difflib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import text as tx
from shelfmark.functions.rules import rule_list
from shelfmark.operators import jobs, reports
from shelfmark.operators.kept import KeptRuns, KeptTable, merge_from, union
from shelfmark.plans import queries as q
from shelfmark.streaming import streams

SF = "/root/testdata/sf0.001"
SCHEMA = "k string, part int, title string, seen int, first int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(df):
    return {(x["k"], x["part"]): (x["title"], x["seen"], x["first"]) for x in df.collect()}


def test_merges_equal_a_plain_twin(spark, tmp_path):
    rnd = random.Random(3)
    kept = KeptTable(spark, str(tmp_path / "t"), ["k", "part"], SCHEMA, 8)
    twin: dict = {}
    assert held(kept.read()) == {}
    for step in range(4):
        new = [(f"k{rnd.randrange(25)}", rnd.randrange(2), rnd.choice([None, f"t{step}"]), step, step) for _ in range(20)] + [(None, 1, "no key", 0, 0), ("n", None, "no key", 0, 0)]
        last: dict = {}
        for r in sorted((r for r in new if r[0] is not None and r[1] is not None), key=lambda r: (r[2] is not None, r[2] or "")):
            last[r[:2]] = r[2:]
        added = sum(key not in twin for key in last)
        after = {key: ((v[0] or twin[key][0]), v[1], twin[key][2]) if key in twin else v for key, v in last.items()}
        updated = sum(key in twin and twin[key] != after[key] for key in last)
        got = kept.merge(frame(spark, new), fill=("title",), replace=("seen",), keep=("first",))
        assert got == {"added": added, "updated": updated}
        twin |= after
        assert held(kept.read()) == twin


def test_first_writer_and_last_writer(spark, tmp_path):
    values = ("title", "seen", "first")
    for name, lists, want in (("ignore", {"keep": values}, ("a", 1, 1)), ("replace", {"replace": values}, (None, 3, 2))):
        kept = KeptTable(spark, str(tmp_path / name), ["k", "part"], SCHEMA, 4)
        kept.merge(frame(spark, [("x", 1, "a", 1, 1)]), **lists)
        kept.merge(frame(spark, [("x", 1, "z", 2, 9), ("x", 1, None, 3, 2)]), order=("seen",), **lists)
        assert held(kept.read()) == {("x", 1): want}
    with pytest.raises(ValueError):
        kept.merge(frame(spark, []), fill=("title",))


def files(path):
    return {str(p) for p in Path(path).rglob("*.parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    kept = KeptTable(spark, str(tmp_path / "t"), ["k", "part"], SCHEMA, 16)
    lists = {"fill": ("title",), "replace": ("seen",), "keep": ("first",)}
    rows = [(f"k{i}", 1, "t", 1, 1) for i in range(200)]
    assert kept.merge(frame(spark, rows), **lists) == {"added": 200, "updated": 0}
    before, number = dict(kept.snapshot()["held"]), kept.snapshot()["number"]
    assert kept.merge(frame(spark, rows), **lists) == {"added": 0, "updated": 0}
    assert kept.snapshot()["number"] == number and kept.snapshot()["held"] == before
    assert kept.merge(frame(spark, [("k7", 1, "new", 1, 1)]), **lists) == {"added": 0, "updated": 1}
    after = kept.snapshot()["held"]
    assert sum(after[b] != before[b] for b in before) == 1 and len(after) == len(before) == 16
    changed = next(int(b) for b in before if after[b] != before[b])
    plan = kept.read([changed])
    assert "k7" in {x["k"] for x in plan.collect()} and len(plan.inputFiles()) < len(kept.read().inputFiles())
    assert kept.read().count() == 200
    assert kept.remove_unread(1) == 0  # the first run still has the other buckets
    kept.merge(frame(spark, [(k, p, t, 2, f) for k, p, t, _, f in rows]), **lists)
    assert kept.remove_unread(1) == 2 and kept.read().where("seen = 2").count() == 200
    assert len({f.split("run=")[1].split("/")[0] for f in files(tmp_path / "t" / "rows")}) == 1


def test_empty_and_repeated_batches(spark, tmp_path):
    kept = KeptTable(spark, str(tmp_path / "t"), ["k", "part"], SCHEMA, 4)
    lists = {"replace": ("title", "seen", "first")}
    assert kept.merge(frame(spark, []), **lists) == {"added": 0, "updated": 0}
    assert kept.merge(frame(spark, [("x", 1, "a", 1, 1)]), **lists, batch=("s", 0)) == {"added": 1, "updated": 0}
    assert kept.merge(frame(spark, [("x", 1, "late", 1, 1)]), **lists, batch=("s", 0)) == {"added": 0, "updated": 0}
    assert kept.merge(frame(spark, []), **lists, batch=("s", 1)) == {"added": 0, "updated": 0}
    assert held(kept.read()) == {("x", 1): ("a", 1, 1)}


def test_a_lost_merge_leaves_the_table(spark, tmp_path, monkeypatch):
    kept = KeptTable(spark, str(tmp_path / "t"), ["k", "part"], SCHEMA, 4)
    lists = {"replace": ("title", "seen", "first")}
    kept.merge(frame(spark, [("x", 1, "a", 1, 1)]), **lists)
    with monkeypatch.context() as m:
        m.setattr(kept.snapshots, "publish", lambda s: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            kept.merge(frame(spark, [("x", 1, "b", 2, 2)]), **lists)
    assert held(kept.read()) == {("x", 1): ("a", 1, 1)}
    kept.merge(frame(spark, [("x", 1, "b", 2, 2)]), **lists)
    assert held(kept.read()) == {("x", 1): ("b", 2, 2)}
    with pytest.raises(RuntimeError):
        kept.snapshots.publish({"number": 1})


RULES = {"n": F.sum, "least": F.min, "tags": union}


def test_runs_merge_as_one(spark, tmp_path):
    rnd = random.Random(5)
    kept = KeptRuns(spark, str(tmp_path / "r"), ["k"], "k string, n long, least int, tags array<string>", RULES, 4)
    allof = []
    for step in range(6):
        rows = [(rnd.choice([None, "a", "b", f"k{rnd.randrange(30)}"]), 1, rnd.randrange(100), [rnd.choice("xyz")]) for _ in range(20)]
        allof += rows
        df = spark.createDataFrame(rows, "k string, n long, least int, tags array<string>")
        kept.add(df, ("s", step))
        assert kept.add(df, ("s", step)) == 0
    want: dict = {}
    for k, n, least, tags in allof:
        a = want.get(k, (0, 1000, []))
        want[k] = (a[0] + n, min(a[1], least), sorted({*a[2], *tags}))
    got = {x["k"]: (x["n"], x["least"], sorted(x["tags"])) for x in kept.read().collect()}
    assert got == want
    assert len(kept.snapshot()["runs"]) < 6
    some = kept.read([1])
    assert {x["k"] for x in some.collect()} == {k for k in want if k is not None and spark.range(1).select(F.pmod(F.hash(F.lit(k)), F.lit(4))).first()[0] == 1} | ({None} if spark.range(1).select(F.pmod(F.hash(F.lit(None).cast("string")), F.lit(4))).first()[0] == 1 else set())


def test_runs_stay_few_and_rows_are_rewritten_seldom():
    sizes, written = [], 0
    for _ in range(1000):
        sizes.append(100)
        written += 100
        start = merge_from(sizes)
        if start is not None:
            sizes[start:] = [sum(sizes[start:])]
            written += sizes[-1]
    assert sum(sizes) == 100_000 and len(sizes) <= 16 and written <= 6 * 100_000
    assert merge_from([10**6, 5, 5, 5]) is None and merge_from([10**6, 5, 5, 5, 5]) == 1 and merge_from([]) is None


def test_todo_ledger_holds_the_state(spark, tmp_path):
    rows = lambda ids: spark.createDataFrame([(x,) for x in ids], "record_id string").coalesce(1)
    done = rows(["old"])
    rows(["a", "a", "old", None]).write.parquet(str(tmp_path / "in"))
    place, at = str(tmp_path / "ledger"), str(tmp_path / "at")

    def run(checkpoint=at):
        source = spark.readStream.schema("record_id string").parquet(str(tmp_path / "in"))
        run = streams.resume_todo(source, place, checkpoint, done, 4).trigger(availableNow=True).start()
        run.awaitTermination()
        assert all(not p.get("stateOperators") for p in run.recentProgress)
        return sorted(((x["record_id"] or "", x["since"]) for x in streams.todo_since(spark, place, buckets=4).collect()))

    assert run() == [("", 0), ("a", 0)]
    rows(["a", "b", None, "old"]).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == [("", 0), ("a", 0), ("b", 1)]
    assert [x["record_id"] for x in streams.todo_since(spark, place, 0, 4).collect()] == ["b"]
    assert run(str(tmp_path / "again")) == [("", 0), ("a", 0), ("b", 1)]  # all files once more, by a new checkpoint


def test_kept_queue_equals_the_batch_one(spark, tmp_path):
    t = q.Tables(spark, SF)
    rows = t.bucketed.withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartition(5, "attempt_id").write.parquet(str(tmp_path / "in"))
    place, sources = str(tmp_path / "queue"), ("click", "view")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def run():
        streams.maintain_queue(stream, place, str(tmp_path / "at"), sources, 8).trigger(availableNow=True).start().awaitTermination()
        got = streams.kept_queue(rows, place, sources, 8)
        want = streams.queue_from_attempts(spark.read.parquet(str(tmp_path / "in")), sources)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        return streams.kept_state(rows, place, sources, 8).snapshot()["runs"]

    assert len(run()) == 2  # four were merged into one
    rows.limit(3).withColumn("record_id", F.lit("new")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run()[-1]["rows"] == 1  # the batch wrote its own record only


def test_merged_sketches_keep_ranks(spark):
    n = 40_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 3)).alias("source"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).alias("ts"),
        F.when(F.col("id") % 50 > 0, F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("bytes"),
    )
    fractions = (0, 0.01, 0.5, 0.99, 1)
    got = {x["source"]: x for x in reports.quantiles_of(reports.attempt_sketches(rows), ["source"], fractions).collect()}
    assert set(got) == {"hot", "s0", "s1", "s2"}
    for source, x in got.items():
        values = sorted(v["bytes"] for v in rows.where((F.col("source") == source) & F.col("bytes").isNotNull()).collect())
        assert (x["n"], x["p0"], x["p100"]) == (len(values), values[0], values[-1])
        for f in fractions:
            assert abs(bisect.bisect_left(values, x[f"p{f * 100:g}"]) / len(values) - f) < 0.01
    nulls = rows.where("bytes is null").limit(3)
    assert {(x["n"], x["p50"]) for x in reports.quantiles_of(reports.attempt_sketches(nulls), ["source"]).collect()} == {(0, None)}
    assert reports.quantiles_of(reports.attempt_sketches(rows.limit(0)), ["source"]).collect() == []


def test_answers_of_every_form_are_judged(spark):
    raw = ['{"verdict": "maybe", "score": "7.5"}', '```json\n{"verdict": "SURE", "score": "x"}\n```', '{"verdict": "NO", "score": 3, "why": "cut', "VERDICT: YES or NO\nWHY: none", "", None]
    df = spark.createDataFrame([(i, "j", x) for i, x in enumerate(raw)], "item_id long, judge string, raw string")
    got = {x["item_id"]: (x["verdict"], x["score"], x["error"] is None) for x in jobs.judge(df, ["YES", "NO", "MAYBE"]).collect()}
    assert got == {0: ("MAYBE", 7.5, True), 1: ("UNCLEAR", None, True), 2: ("NO", 3.0, True), 3: ("YES", None, False), 4: ("UNCLEAR", None, False), 5: ("UNCLEAR", None, False)}


def test_bounds_decide_titles_and_change_no_score(spark):
    rnd = random.Random(8)
    words = ["sigma", "alpha beta", "heat", "é", "of", "zz"]
    made = lambda k: " ".join(rnd.choice(words) for _ in range(rnd.randrange(k)))
    rows = [(i, made(12), made(9)) for i in range(150)] + [(200, None, "x"), (201, "x", None), (202, "heat " * 400, "of heat"), (203, "abcd", "dcba")]
    df = spark.createDataFrame(rows, "i int, text string, title string")
    whole = {x["i"]: x["title_score"] for x in tx.title_scores(df).collect()}
    some = {x["i"]: x["title_score"] for x in tx.title_scores(df, 0.6).collect()}
    assert set(some) == set(whole) and all(some[i] == whole[i] or (some[i] is None and 0 < whole[i] < 0.6) or (some[i] is None and whole[i] == 0) for i in whole)
    assert all(some[i] == whole[i] for i in whole if whole[i] >= 0.6) and sum(x is None for x in some.values()) > 10
    bounds = df.na.fill("").select("i", tx.ratio_bound(F.col("text"), F.col("title")).alias("b"), "text", "title").collect()
    for x in bounds:
        assert x["b"] >= difflib.SequenceMatcher(None, x["text"], x["title"]).ratio() - 1e-12
        assert abs(x["b"] - difflib.SequenceMatcher(None, x["text"], x["title"]).quick_ratio()) < 1e-12


def test_rule_tables_keep_their_order_and_bound(spark):
    table = spark.createDataFrame([(2, "b", "B"), (1, "c", "C"), (2, "a", "A")], "pos int, text string, code string")
    assert rule_list(table, "text", "code") == [("c", "C"), ("a", "A"), ("b", "B")]
    with pytest.raises(ValueError):
        rule_list(spark.range(1001).withColumnRenamed("id", "pos"), "pos")
