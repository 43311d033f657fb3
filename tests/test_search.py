"""Search expressions and kept indexes against brute force."""

from __future__ import annotations

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import index, joins, search
from shelfmark.operators.match import Leaf, Not, Some, keys_of, leaves, phrase, prefix, term, true_when
from shelfmark.operators.match import search as find
from shelfmark.session import shared_folder

WORDS = ["alpha", "alps", "beta", "be", "gamma", "a@b.org", "the", "of"]


def texts(n, seed=1):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(0, 9)))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "Álphá ÁLPS")]


def tokens(text):
    return search_tokens(text or "")


def search_tokens(text):
    return re.findall(r"[a-z0-9@._+-]+", text.translate(str.maketrans(search.ACCENTED, search.PLAIN)).lower())


def count(leaf, words):
    if leaf.open_end:
        return sum(w.startswith(leaf.words[0]) for w in words)
    k = len(leaf.words)
    return sum(tuple(words[i : i + k]) == leaf.words for i in range(len(words) - k + 1))


def grown(rnd, depth):
    if not depth or rnd.random() < 0.3:
        return rnd.choice([term(rnd.choice(WORDS)), prefix(rnd.choice(["al", "b", "gam", "zz"])), phrase(*(rnd.choice(WORDS) for _ in range(rnd.choice([2, 2, 3]))))])
    a, b = grown(rnd, depth - 1), grown(rnd, depth - 1)
    return rnd.choice([a & b, a | b, ~a, a & ~b])


def new_index(spark, kind=search.POSTINGS):
    return index.Index(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}", kind)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, m) for i, t, m in rows], "doc_id long, text string, mtime long")


def all_rows(df):
    return sorted(tuple(x) for x in df.drop("folder").collect())


def test_random_expressions_find_what_brute_force_finds(spark):
    rnd = random.Random(4)
    rows = texts(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = new_index(spark)
    kept.refresh(docs.withColumn("mtime", F.lit(1)))
    postings = kept.rows().cache()
    empty = 0
    for _ in range(25):
        e = grown(rnd, 3)
        held = {i: {x: count(x, tokens(t)) for x in leaves(e)} for i, t in rows}
        want = {i for i, of in held.items() if true_when(e, {x: n > 0 for x, n in of.items()})}
        got = {x["doc_id"]: x["n"] for x in find(postings, e, docs).collect()}
        assert set(got) == want, e
        empty += not want
    assert empty < 15


def test_occurrences_count_outside_negations(spark):
    postings = search.build_postings(spark.createDataFrame([(1, "a b a b c"), (2, "a c"), (3, "b")], "doc_id long, text string"))
    got = {x["doc_id"]: x["n"] for x in find(postings, (phrase("a", "b") | term("b")) & ~term("zz")).collect()}
    assert got == {1: 4, 3: 1}
    assert {x["doc_id"]: x["n"] for x in find(postings, ~Not(term("c"))).collect()} == {1: 1, 2: 1}
    assert find(postings, phrase("a", "a")).count() == 0


def test_what_is_true_without_words_needs_all_documents(spark):
    postings = search.build_postings(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    with pytest.raises(ValueError, match="all documents"):
        find(postings, ~term("a"))
    with pytest.raises(ValueError, match="needs words"):
        find(postings, Leaf(()))
    docs = spark.createDataFrame([(1,), (2,), (2,)], "doc_id long")
    assert [tuple(x) for x in find(postings, ~term("a"), docs).collect()] == [(2, 0)]


def test_only_the_folders_of_the_words_are_read(spark):
    kept = new_index(spark)
    kept.refresh(frame(spark, [(i, t, 1) for i, t in texts(30)]))
    one, short = keys_of(kept.rows(), [phrase("alpha", "beta")]), keys_of(kept.rows(), [prefix("al"), prefix("gam")])
    plan = one._jdf.queryExecution().executedPlan().toString()
    folders = {index.folder_number("alpha"), index.folder_number("beta")}
    assert "folder" in plan and all(str(x) in plan for x in folders)
    assert {x["folder"] for x in one.collect()} == folders
    assert {x["term"] for x in short.collect()} == {"alpha", "alps", "gamma"}
    assert index.folder_number("alphabet") == index.folder_number("alps"[:2] + "p") == spark.range(1).select(index.folder_of(F.lit("alphabet"))).first()[0]


@pytest.mark.parametrize("kind", [search.POSTINGS, search.TRIGRAMS])
def test_a_refreshed_index_equals_a_fresh_one(spark, kind, monkeypatch):
    monkeypatch.setattr(index, "MERGE_AT", 3)
    rnd = random.Random(8)
    now = {i: [t, 1] for i, t in texts(60)}
    kept = new_index(spark, kind)
    for turn in range(6):
        done = kept.refresh(frame(spark, [(i, t, m) for i, (t, m) in now.items()]))
        live = spark.createDataFrame([(i, t) for i, (t, _) in now.items()], "doc_id long, text string")
        assert all_rows(kept.rows()) == all_rows(kind.build(live))
        assert sorted(x["doc_id"] for x in kept.docs().collect()) == sorted(now)
        assert len(kept.snapshot()["batches"]) <= index.MERGE_AT + 1
        if turn:
            assert done == change
        touched, gone = rnd.sample(sorted(now), 4), rnd.sample(sorted(now), 2)
        fresh = {1000 + turn * 10 + k for k in range(3)}
        for i in touched:
            now[i] = [now[i][0] if i % 2 else f"{now[i][0] or ''} new{turn}", now[i][1] + 1]
        now = {i: x for i, x in now.items() if i not in gone} | {i: [f"alpha fresh{turn}", 1] for i in fresh}
        change = {"made": len(set(touched) - set(gone)) + len(fresh), "gone": len(set(touched) | set(gone))}
    assert any(x["n_keys"] > 0 for x in kept.docs().collect())


def test_a_refresh_makes_rows_of_changed_documents_only(spark):
    kept = new_index(spark)
    rows = [(i, t, 1) for i, t in texts(40)]
    kept.refresh(frame(spark, rows))
    assert kept.refresh(frame(spark, rows)) == {"made": 0, "gone": 0} and kept.snapshot()["number"] == 1
    # a text that changes without its time isn't read again
    changed = [(i, "other words", 2 if i == 3 else m) for i, t, m in rows]
    assert kept.refresh(frame(spark, changed)) == {"made": 1, "gone": 1}
    last = kept.snapshot()["batches"][-1]
    batch = spark.read.parquet(f"{kept.path}/rows/batch={last}")
    assert {(x["doc_id"], x["term"]) for x in batch.collect()} == {(3, "other"), (3, "words")}


def test_a_failed_refresh_is_never_seen(spark, monkeypatch):
    kept = new_index(spark)
    kept.refresh(frame(spark, [(1, "alpha", 1), (2, "beta", 1)]))
    monkeypatch.setattr(index.Index, "_publish", lambda self, s: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        kept.refresh(frame(spark, [(1, "gamma", 2)]))
    monkeypatch.undo()
    assert all_rows(kept.rows()) == [("alpha", 1, 0), ("beta", 2, 0)]
    kept.refresh(frame(spark, [(1, "gamma", 2)]))
    assert all_rows(kept.rows()) == [("gamma", 1, 0)]


def test_of_two_refreshes_at_once_one_fails(spark):
    kept = new_index(spark)
    kept.refresh(frame(spark, [(1, "alpha", 1)]))
    old = kept.snapshot()
    kept.refresh(frame(spark, [(1, "beta", 2)]))
    with pytest.raises(RuntimeError, match="came first"):
        kept._publish(old | {"number": 2})
    assert all_rows(kept.rows()) == [("beta", 1, 0)]


def test_a_changed_tokeniser_starts_a_new_index(spark, monkeypatch):
    at = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    index.Index(spark, at, search.POSTINGS).refresh(frame(spark, [(1, "alpha", 1)]))
    monkeypatch.setattr(index, "FORMAT", index.FORMAT + 1)
    assert index.Index(spark, at, search.POSTINGS).snapshot()["number"] == 0


def test_odd_documents_of_an_index(spark):
    kept = new_index(spark)
    assert kept.refresh(frame(spark, [])) == {"made": 0, "gone": 0}
    assert kept.rows().count() == 0 and find(kept.rows(), term("a")).count() == 0
    kept.refresh(frame(spark, [(None, "alpha", 1), (1, None, 1), (2, "old", 1), (2, "newer", 5), (3, "same", 1), (3, "same too", 1), (4, "timeless", None)]))
    assert all_rows(kept.rows()) == [("newer", 2, 0), ("same", 3, 0), ("same", 3, 0), ("timeless", 4, 0), ("too", 3, 1)]
    assert kept.refresh(frame(spark, [(1, None, 1), (2, "newer", 5), (3, "same", 1), (3, "same too", 1), (4, "timely", None)])) == {"made": 1, "gone": 1}
    assert ("timely", 4, 0) in all_rows(kept.rows())


def test_unions_and_terms_of_older_functions(spark):
    postings = search.build_postings(spark.createDataFrame([(1, "a b"), (2, "a"), (3, "b c")], "doc_id long, text string"))
    assert {x["doc_id"] for x in search.search_boolean(postings, ["b"], ["a"]).collect()} == {3}
    assert {x["doc_id"] for x in find(postings, Some((term("c"), term("a")))).collect()} == {1, 2, 3}


def test_trigrams_are_all_runs_of_three(spark):
    text = "Ab\ncdé🙂x" + "long " * 3000
    got = spark.createDataFrame([(1, text), (2, "ab"), (3, None)], "doc_id long, text string")
    rows = {x["gram"] for x in search.build_trigrams(got).where("doc_id = 1").collect()}
    assert {text.lower()[i : i + 3] for i in range(len(text) - 2)} <= rows
    assert search.build_trigrams(got).where("doc_id > 1").count() == 0


def test_best_overlaps_are_those_of_brute_force(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(120)]
    often = lambda: vocabulary[int(len(vocabulary) * rnd.random() ** 3)]
    rows = [(i, " ".join(often() for _ in range(rnd.choice([0, 3, 10, 40, 200])))) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(40)] + [(500, None), (501, "zz zz")]  # copies tie
    asked = [(f"q{i}", " ".join(often() for _ in range(rnd.choice([1, 5, 20, 30])))) for i in range(25)] + [("same", rows[7][1] or "w1"), ("none", "unknown words"), ("empty", ""), ("null", None)]
    docs, queries = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(asked, "query_id string, text string")
    want = set()
    for query_id, text in asked:
        own, scores = set(tokens(text)), []
        for doc_id, other in rows:
            shared = len(own & set(tokens(other)))
            if shared:
                scores.append((-round(shared / (len(own) + len(set(tokens(other))) - shared), 6), doc_id))
        want |= {(query_id, doc_id, -score, rank) for rank, (score, doc_id) in enumerate(sorted(scores)[:5], 1)}
    assert {tuple(x) for x in search.search_jaccard(docs, queries).collect()} == want
    kept = new_index(spark, search.TERM_SETS)
    kept.refresh(docs.withColumn("mtime", F.lit(1)))
    assert {tuple(x) for x in search.search_jaccard(docs, queries, kept=kept).collect()} == want


def test_pairs_that_cannot_be_among_the_best_are_not_scored(spark):
    rnd = random.Random(12)
    rows = [(i, "the of and " + " ".join(f"r{rnd.randrange(3000)}" for _ in range(30))) for i in range(600)]
    asked = [(f"q{i}", rows[i][1]) for i in range(10)]
    docs, queries = spark.createDataFrame(rows + [(1000 + i, rows[i % 10][1]) for i in range(60)], "doc_id long, text string"), spark.createDataFrame(asked, "query_id string, text string")
    scored, bounded = search.jaccard_candidates(docs, queries, 5)
    assert scored.count() + bounded.count() <= 660  # of 6600 pairs that share a term


@pytest.mark.parametrize("threshold", [0.7, 1.0, 0.34])
def test_titles_match_as_by_brute_force(spark, threshold):
    rnd = random.Random(13)
    words = [f"t{i}" for i in range(25)] + ["the", "of", "and"]
    title = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 7)))
    records = [(f"r{i}", "Smith" if i % 2 else rnd.choice(["Lee", "Kim", None]), title()) for i in range(150)] + [("r1", "Smith", "t1 t2"), (None, "Smith", "t3"), ("rn", "Smith", None)]
    preprints = [(i, "Smith" if i % 2 else rnd.choice(["Lee", "Kim", None]), title()) for i in range(150)] + [(900 + i, "Smith", "t1 t2 t3") for i in range(80)]
    stop, want = {"a", "an", "and", "for", "in", "of", "on", "the", "to", "with"}, {}
    for record_id, surname, own in records:
        q = set(tokens(own)) - stop
        for preprint_id, other_name, other in preprints:
            if surname and surname == other_name and q and len(q & set(tokens(other))) >= threshold * len(q):
                want[record_id] = min(want.get(record_id, preprint_id), preprint_id)
    a, b = spark.createDataFrame(records, "record_id string, surname string, title string"), spark.createDataFrame(preprints, "preprint_id long, surname string, title string")
    assert {x["record_id"]: x["preprint_id"] for x in joins.match_titles(a, b, threshold).collect()} == want


def test_copies_of_a_title_do_not_pair_up(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("record_id"), F.lit("Smith").alias("surname"), F.lit("heat flow in rocks").alias("title"), F.col("id").alias("preprint_id"))
    got = joins.match_titles(rows, rows)
    assert got.count() == 20_000 and {x["preprint_id"] for x in got.select("preprint_id").distinct().collect()} == {0}
