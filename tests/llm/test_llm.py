"""The training-data operators against brute force, exact counts and planted cases."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import decontam, langid, lm_scoring, mixing, near_dup, quality_rank, quality_rules, queries, revisits, sharding, token_count
from shelfmark.llm import textkit as tk

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, None, "en", "s"), (2, "", "en", None), (3, " \n\t ", None, "s"), (4, "one", "en", "s"), (5, "é ü ß " * 300, "de", "s"), (6, "one", "en", "s"), (6, "one", "en", "s"), (None, "two three", "en", "s"), (7, "w%d " % 7 * 5, "fr", "t"), (8, " ".join(f"w{i}" for i in range(30_000)), "fr", "t")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string").withColumns({"size": F.lit("clash"), "score": F.lit(0), "rank": F.lit(1), "rep": F.lit(2)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def words(text):
    return WORD.findall(text or "")


def test_word_hashes_are_those_of_words():
    texts = ["a  b\nA b", "", None, "x\x0by", "end ", " ab"]
    got = []
    for s in tk.slices(pa.array(texts), limit=4):
        starts, ends, first = tk.word_bounds(s)
        keys = tk.word_hashes(s, starts, ends)
        got += [keys[first[i] : first[i + 1]].tolist() for i in range(len(s))]
    name = {}
    for text, keys in zip(texts, got):
        own = [w.lower() for w in words(text)]
        assert len(own) == len(keys)
        for w, k in zip(own, keys):
            assert name.setdefault(w, k) == k
    assert len(set(name.values())) == len(name)


def test_shards(docs):
    rows = sharding.shard_digest(docs).collect()
    texts = {x["doc_id"]: x["text"] for x in docs.collect()}
    load, places = Counter(), defaultdict(list)
    for x in rows:
        data = (texts[x["doc_id"]] or "").encode()
        assert (x["size"], x["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        load[x["shard"]] += x["size"]
        places[x["shard"]].append(x["slot"])
    assert len(rows) == len(texts) and set(load) == set(range(16))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) <= 0.05 * sum(load.values()) / 16


def test_slot_map_edits_only_what_it_must():
    sizes = {s: 100 for s in range(64)}
    old = sharding.rebalanced(sharding.first_map(4, 64), sizes)
    assert old.shard_of == sharding.first_map(4, 64).shard_of and old.version == 1
    new = sharding.rebalanced(old, sizes, 5)
    moved = [(a, b) for a, b in zip(old.shard_of, new.shard_of) if a != b]
    assert new.version == 2 and all(b == 4 for _, b in moved) and 10 <= len(moved) <= 14


def test_token_counts_equal_the_tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers

    for pieces in ([("▁", -3.0), ("▁a", -2.0), ("ab", -2.0), ("b", -2.0), ("a", -2.5), ("▁ab", -4.0), ("bb", -4.0), ("c", -1.0), ("bc", -3.0)], token_count.read_vocabulary().pieces):
        own = token_count.PieceCounter(token_count.Vocabulary(tuple(pieces), False))
        t = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
        t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
        rng = np.random.default_rng(3)
        texts = ["", " ", "abc", " abc", "a  b", "▁ab", "zzab zz", "abbbc", "x\ny z", *["".join(rng.choice(list("abcz  "), 12)) for _ in range(200)]]
        for text in texts:
            assert own.text(text) == len(t.encode(text, add_special_tokens=False).ids), text


def test_mixing_keeps_targets(docs):
    rows = mixing.mix(docs).collect()
    per = defaultdict(lambda: [0, 0, 0.0])
    for x in rows:
        assert x["taken"] <= 3 * x["size"]
        per[x["source"]][0] += x["size"]
        per[x["source"]][1] += x["taken"]
        per[x["source"]][2] = x["target"]
    total = sum(v[0] for v in per.values())
    assert abs(sum(v[2] for v in per.values()) - total) < 1e-6 * total
    for size, taken, target in per.values():
        assert abs(taken - target) <= max(0.1 * target, 4 * mixing.BLOCK)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()))


def test_targets_by_water_filling(spark):
    sizes = {"a": 10, "b": 500, "c": 40, None: 7, "d": 3}
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {x["source"]: x["target"] for x in mixing.source_targets(rows).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    target |= {s: level * weight[s] for s in free}
    assert {s: pytest.approx(v) for s, v in target.items()} == got


def test_base_rules_by_brute_force(docs, labels):
    texts = {x["doc_id"]: x["text"] for x in docs.collect()}
    for x in quality_rules.quality_rules(docs, labels).collect():
        text, w = texts[x["doc_id"]] or "", words(texts[x["doc_id"]])
        lines = [line for line in text.split("\n") if WORD.search(line)]
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        many, inside = Counter(windows), set()
        for i, g in enumerate(windows):
            if many[g] > 1:
                inside.update(range(i, i + 5))
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))
        assert tuple(x[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert x["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (x["base_failed"] and x["kept"])


def test_log_ratio_by_brute_force(docs, labels):
    import xxhash

    texts = [(x["doc_id"], words(x["text"])) for x in docs.collect()]
    trusted = {x["doc_id"] for x in labels.where("quality = 1").collect()}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    h = lambda data, seed=42: xxhash.xxh64(data, seed).intdigest()
    raw, target = Counter(), Counter()
    for doc_id, own in texts:
        keys = [h(w.encode()) for w in own]
        grams = [signed(k) % quality_rules.BUCKETS for k in keys]
        grams += [signed(h(b.to_bytes(8, "little"), h(a.to_bytes(8, "little")))) % quality_rules.BUCKETS for a, b in zip(keys, keys[1:])]
        raw.update(grams)
        if doc_id in trusted:
            target.update(grams)
    n, s = quality_rules.BUCKETS, quality_rules.SMOOTHING
    base = np.log((sum(raw.values()) + s * n) / (sum(target.values()) + s * n))
    want = [np.log((target[b] + s) / (raw[b] + s)) + base for b in range(n)]
    assert np.allclose(quality_rules.log_ratios(docs, labels), want, atol=1e-5)


def test_every_trusted_text_counts_however_many(spark):
    d = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 25_000, "good").otherwise("bad").alias("text"))
    d = d.unionByName(spark.createDataFrame([(None, "bad"), (7, "good")], "doc_id long, text string"))
    marks = spark.range(25_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    marks = marks.unionByName(marks.where("doc_id < 9")).unionByName(spark.createDataFrame([(None, 1), (29_000, 0)], "doc_id long, quality int"))
    n, s = 64, quality_rules.SMOOTHING
    base = np.log((30_002 + s * n) / (25_001 + s * n))
    want = {round(np.log((t + s) / (r + s)) + base, 4) for t, r in ((25_001, 25_001), (0, 5_001), (0, 0))}
    for way in ({}, {"broadcast_most": 0}):
        assert {round(x, 4) for x in quality_rules.log_ratios(d, marks, n, **way)} == want


def test_classifier_on_held_out_rows(docs, labels):
    j = quality_rank.quality_digest(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(x["predicted"] == x["quality"] for x in j) >= 0.9 * len(j)
    assert all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.3) for x in j)


def test_languages_on_held_out_rows(docs):
    j = langid.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(x["lang_pred"] == x["lang"] for x in j) >= 0.9 * len(j)


def test_pseudo_likelihood_prefers_seen_order(spark):
    rows = [(i, "the cat sat on the mat and the dog sat on the log " * 20) for i in range(60)]
    df = spark.createDataFrame([*rows, (1000, "log the on sat dog the and mat the on sat cat the " * 5)], "doc_id long, text string")
    got = {x["doc_id"]: x["per_word"] for x in lm_scoring.pseudo_likelihood(df).collect()}
    assert got[0] > got[1000] + 0.2


def test_words_of_one_class_have_their_own_probabilities(spark):
    def hashes(names):
        s = next(tk.slices(pa.array([" ".join(names)])))
        return tk.word_hashes(s, *tk.word_bounds(s)[:2]).astype(np.uint64)

    names = [f"r{i}" for i in range(2000)]
    ones = [w for w, k in zip(names, hashes(names)) if k % lm_scoring.CLASSES == 5]
    seen, rare = ones[0], ones[1]
    filler = " ".join(f"f{i}" for i in range(lm_scoring.FREQUENT))
    rows = [(1, f"f1 f2 {seen} f3 f4"), (2, f"f1 f2 {rare} f3 f4"), (None, f"f1 f2 {seen} f3 f4"), (3, None), (3, f"{seen} {rare} {seen}"), *[(i, filler) for i in range(10, 22)], *[(i, seen) for i in range(30, 36)]]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    n = Counter(w for _, text in rows for w in words(text))
    most = sorted(n, key=lambda w: -n[w])
    assert set(most[: lm_scoring.FREQUENT]) == set(filler.split())
    for way in ({}, {"hot": 0}):
        got = lm_scoring.pseudo_likelihood(df, **way).collect()
        assert len(got) == len(rows)
        one = {x["doc_id"]: x["log_likelihood"] for x in got if x["doc_id"] in (1, 2, None)}
        assert one[1] == pytest.approx(one[None]) and one[1] - one[2] == pytest.approx(np.log(n[seen] / n[rare]), abs=1e-4)
        shares = lm_scoring.WordShares(lm_scoring.word_counts(df), **way)
        total = np.exp(shares.log_total[5])
        assert total == pytest.approx(n[seen] + n[rare])
        assert sorted((x["n_words"], x["log_likelihood"]) for x in got if x["doc_id"] == 3)[0] == (0, 0.0)


def test_gradient_step_lowers_loss():
    n = lm_scoring.Network.seeded()
    rng = np.random.default_rng(0)
    w = rng.integers(0, 20, 512)
    around = np.stack([np.roll(w, -o) for o in lm_scoring.OFFSETS])
    before = -n.log_probability(w, around).mean()
    for _ in range(30):
        n.step(w, around, 0.1)
    assert -n.log_probability(w, around).mean() < before - 0.5


def test_averaged_rows_are_weighted_by_the_words_that_moved_them(spark):
    texts = [("a b c d e " * 120,)] * 4, [("a b x y z " * 40,)] * 4
    frame = lambda rows, n: spark.createDataFrame(spark.sparkContext.parallelize(rows, n), "text string")
    one, other, both = frame(texts[0], 1), frame(texts[1], 1), frame(texts[0] + texts[1], 2)
    frequent = [x["word"] for x in lm_scoring.word_counts(both).orderBy(F.desc("n"), "word").collect()]
    seeded, mean = lm_scoring.Network.seeded(), lm_scoring.train(both, frequent)
    parts = [lm_scoring.train(x, frequent) for x in (one, other)]
    moved = [np.abs(x.near[0] - seeded.near[0]).sum(axis=1) > 0 for x in parts]
    assert moved[0].sum() == 6 and moved[1].sum() == 6  # five words and none
    for i in np.flatnonzero(moved[0] ^ moved[1]):
        assert np.allclose(mean.near[0][i], parts[0 if moved[0][i] else 1].near[0][i], atol=1e-6)
    weights = np.array([3, 1]) / 4
    assert np.allclose(mean.bias, weights[0] * parts[0].bias + weights[1] * parts[1].bias, atol=1e-5)
    still = np.flatnonzero(~moved[0] & ~moved[1])
    assert np.array_equal(mean.near[0][still], seeded.near[0][still])


def test_a_less_frequent_words_probability_follows_its_context(spark):
    rng = np.random.default_rng(3)
    names = [f"n{i}" for i in range(300)]
    rows = []
    for i in range(600):
        k = int(rng.integers(0, 100))
        rows.append((i, f"lead{k} then word{k} ends here {' '.join(rng.choice(names, 8))} " * 3))
    right = [(1000 + k, f"lead{k} then word{k} ends here") for k in range(100)]
    wrong = [(2000 + k, f"lead{k} then word{(k + 37) % 100} ends here") for k in range(100)]
    got = {x["doc_id"]: x["log_likelihood"] for x in lm_scoring.pseudo_likelihood(spark.createDataFrame([*rows * 12, *right, *wrong], "doc_id long, text string").coalesce(2)).collect()}
    assert sum(got[1000 + k] > got[2000 + k] for k in range(100)) >= 95


def test_sums_of_runs():
    rng = np.random.default_rng(1)
    values, keys = rng.normal(0, 1, (3000, 8)), np.sort(rng.zipf(1.5, 3000) % 50)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    order = rng.permutation(3000)
    got = lm_scoring._sums(values, order, first, np.diff(np.append(first, 3000)))
    assert np.allclose(got, [values[order][keys == k].sum(axis=0) for k in np.unique(keys)])


def brute_tiles(a, b, least):
    used_a, used_b, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return covered
        used_a.update(range(best[1], best[1] + best[0]))
        used_b.update(range(best[2], best[2] + best[0]))
        covered += best[0]


def test_tiling_by_brute_force(spark):
    rng = np.random.default_rng(5)
    item = [f"t{i}" for i in rng.integers(0, 40, 40)]
    texts = []
    for _ in range(12):
        parts = [item[0:14], item[14:28], item[28:40], [f"z{i}" for i in range(9)]]
        rng.shuffle(parts)
        texts.append([w for p in parts for w in p][: rng.integers(20, 49)])
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(item).upper() + "."), (8, None), (9, "only two")], "item_id long, text string")
    want = {(i, brute_tiles(t, item, 5)) for i, t in enumerate(texts)}
    for most in (decontam.SEEDS_MOST, 0):
        got = {(x["doc_id"], x["covered_words"]) for x in decontam.overlaps(d, b, seeds_most=most).collect()}
        assert got == {x for x in want if x[1]}


def test_every_benchmark_text_and_document_row_is_searched(spark):
    text = lambda c, n=12: " ".join(f"{c}{i}" for i in range(n))
    b = spark.createDataFrame([(1, text("a")), (1, text("b", 24)), (1, None), (1, text("a")), (None, text("c")), (None, text("d"))], "item_id long, text string")
    rows = [(1, text("a")), (2, text("b", 24)), (2, text("a", 6)), (3, text("c")), (4, text("d")), (None, text("a", 6)), (None, "z " + text("b", 18)), (5, text("a", 6) + " " + text("b", 18)), (6, text("a")), (6, text("a"))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(1, 1, 12, 12), (2, 1, 24, 24), (2, 1, 12, 6), (3, None, 12, 12), (4, None, 12, 12), (None, 1, 12, 6), (None, 1, 24, 18), (5, 1, 24, 18), (6, 1, 12, 12), (6, 1, 12, 12)]
    for most in (decontam.SEEDS_MOST, 0):
        got = [(x["doc_id"], x["item_id"], x["item_words"], x["covered_words"]) for x in decontam.overlaps(d, b, seeds_most=most).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert {x["doc_id"] for x in decontam.decontaminate(d, b).collect()} == {None}


def test_reordered_and_short_passages(spark):
    item = " ".join(f"q{i}" for i in range(30))
    w = item.split()
    rows = [(1, " ".join(["x"] * 50 + w[15:] + ["y"] * 20 + w[:15])), (2, "clean text of other words"), (3, "we say Only, two! here"), (None, item), (4, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(1, item), (2, "only two")], "item_id long, text string")
    assert {(x["doc_id"], x["item_id"]) for x in decontam.contamination(d, b).collect()} == {(1, 1), (3, 2), (None, 1)}
    assert {x["doc_id"] for x in decontam.decontaminate(d, b).collect()} == {2, 4, None}


def test_near_duplicates_of_a_large_edited_group(spark):
    rng = np.random.default_rng(1)
    base = [f"b{i}" for i in range(80)]
    texts = []
    for i in range(150):
        t = list(base)
        for p in rng.choice(80, rng.integers(0, 4), replace=False):
            t[p] = f"e{rng.integers(0, 40)}"
        texts.append(t)
    texts += [texts[3]] * 60 + [[f"u{i}_{j}" for j in range(40)] for i in range(30)]
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [frozenset(tuple(t[i : i + 5]) for i in range(len(t) - 4)) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"]) for x in near_dup.near_duplicates(d).collect()}
    assert got == {i: (len(s), root(i), root(i) == i) for i, s in enumerate(sets)}


def test_odd_sketch_estimates_high_similarity():
    a = tk.mix(np.arange(1000, dtype=np.uint64))
    b = tk.mix(np.arange(80, 1080, dtype=np.uint64))
    ones = sum(int(x).bit_count() for x in (near_dup._odd_sketch(near_dup._samples(a)) ^ near_dup._odd_sketch(near_dup._samples(b))).view(np.uint64))
    assert 10 <= ones <= near_dup.MOST_ONES


def test_only_responses_that_are_asked_for_are_shuffled(spark, monkeypatch):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("one"), "id")
    asked = keys.where("id % 10 = 0")
    got = revisits.asked_for(keys, asked.union(asked)).cache()
    assert got.columns == keys.columns and got.where("id % 10 = 0").count() == 2_000 and got.count() < 5_000
    assert revisits.asked_for(keys, keys.where("id < 0")).count() == 0
    rows = [(f"f{i}", "response", f"http://a.org/{i}", 100, '"t"', None, None, {}, f"p{i}") for i in range(300)]
    rows += [(f"r{i}", "revisit", f"http://a.org/{i}", 200, '"t"', None, None, {}, None) for i in range(0, 300, 2)]
    captures = spark.createDataFrame(rows, revisits.CAPTURE)
    monkeypatch.setattr(revisits, "BITMAP_LEAST", 64)
    for most in (1 << 26, 64):  # the second is full
        monkeypatch.setattr(revisits, "BITMAP_MOST", most)
        assert {(x["record_id"], x["payload"]) for x in revisits.resolve_revisits(captures).collect()} == {(f"r{i}", f"p{i}") for i in range(0, 300, 2)}


def test_revisits(spark):
    full = ("f1", "response", "http://www.A.org:80/p?b=2&a=1&ref=z#x", 100, '"t"', None, None, {"ETag": '"t"', "X": "old", "Date": "d1"}, "body")
    later = ("f2", "response", "http://a.org/p?a=1&b=2", 100 + 3 * 86400, '"u"', None, None, {}, "new")
    again = [("r1", 200, 'W/"t"'), ("r2", 100 + 2 * 86400, '"t"'), ("r3", 100, '"t"'), ("r4", 200, '"no"'), ("r5", 300, None), ("r6", 101 + 3 * 86400, '"u"')]
    rows = [full, later, *[(n, "revisit", "https://a.org/p?a=1&b=2", t, tag, None, None, {"date": "d2", "X": "not permitted"}, None) for n, t, tag in again], ("r7", "revisit", None, 1, "x", None, None, None, None)]
    got = {x["record_id"]: (x["response_id"], x["status"], x["payload"]) for x in revisits.resolve_revisits(spark.createDataFrame(rows, revisits.CAPTURE)).collect()}
    assert got == {
        "r1": ("f1", "resolved", "body"), "r2": ("f1", "resolved", "body"), "r3": (None, "no_earlier_response", None), "r4": ("f1", "validator_mismatch", None),
        "r5": ("f1", "no_validator", None), "r6": ("f2", "resolved", "new"), "r7": (None, "no_earlier_response", None),
    }
    headers = revisits.resolve_revisits(spark.createDataFrame(rows, revisits.CAPTURE)).where("record_id = 'r1'").first()["headers"]
    assert headers == {"ETag": '"t"', "X": "old", "date": "d2"}


def test_captures_without_a_record_id(spark):
    full = [("f1", "http://a.org/p", 100, "body"), (None, "http://b.org/p", 100, "other"), (None, "http://b.org/q", 100, "more")]
    again = [(None, "http://a.org/p", 200, '"t"'), (None, "http://a.org/p", 50, '"t"'), (None, None, 1, '"t"'), ("r1", "http://b.org/p", 200, '"t"'), ("r2", "http://b.org/q", 100 + 3 * 86400, '"t"'), (None, "http://a.org/p", 201, '"no"')]
    rows = [(i, "response", u, t, '"t"', None, None, {}, p) for i, u, t, p in full] + [(i, "revisit", u, t, tag, None, None, {"date": str(t)}, None) for i, u, t, tag in again]
    got = [(x["record_id"], x["ts"], x["response_id"], x["status"], x["payload"]) for x in revisits.resolve_revisits(spark.createDataFrame(rows, revisits.CAPTURE)).collect()]
    want = [
        (None, 200, "f1", "resolved", "body"), (None, 50, None, "no_earlier_response", None), (None, 1, None, "no_earlier_response", None),
        ("r1", 200, None, "resolved", "other"), ("r2", 100 + 3 * 86400, None, "resolved", "more"), (None, 201, "f1", "validator_mismatch", None),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    pages = spark.createDataFrame([(1, "http://a.org", "x"), (None, "http://a.org", "y")], "page_id long, url string, html string")
    assert [x["record_id"] for x in revisits.revisit_digest(pages).collect()].count(None) == 3


def test_long_tiling_makes_the_same_tiles():
    rng = np.random.default_rng(21)
    for _ in range(300):
        letters = tk.mix(np.arange(1, 1 + rng.integers(1, 4), dtype=np.uint64))
        doc, item = letters[rng.integers(0, len(letters), rng.integers(0, 60))], letters[rng.integers(0, len(letters), rng.integers(1, 40))]
        k = min(5, len(item))
        left, right = tk.window_hashes(doc, k), tk.window_hashes(item, k)
        d, i = np.nonzero(left[:, None] == right[None, :])
        assert sorted(decontam.tile_long(doc, item, k)) == sorted(decontam.tile(d, i, k))


def test_repetitive_texts_are_tiled_in_the_memory_of_their_length(spark):
    import resource

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    doc, item = np.full(1_000_000, 7, np.uint64), np.full(2_000, 7, np.uint64)
    seeds = decontam.Seeds([(1, item)])
    assert list(seeds.pairs(doc, np.array([0, len(doc)]))) == [(0, 1, 2000, 2000, 1, 2000)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # KB; all hits would take 32 GB
    d = spark.createDataFrame([(1, "ab ab cd " * 20_000), (2, "x " * 100_000), (3, "cd ab " * 30)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "ab ab cd " * 300), (2, "x " * 50 + "y " * 40), (3, "ab")], "item_id long, text string")
    got = [{tuple(x) for x in decontam.overlaps(d, b, seeds_most=most, hits_most=hits).collect()} for most in (decontam.SEEDS_MOST, 0) for hits in (decontam.HITS_MOST, 1000)]
    assert got[0] == got[1] == got[2] == got[3] and {(x[0], x[1], x[3]) for x in got[0]} >= {(1, 1, 900), (2, 2, 50), (1, 3, 1), (3, 3, 1)}


def test_the_bitmap_holds_every_seed(spark):
    values = [0, -1, 1 << 62, -(1 << 63), 12345, 65535, 65536]
    bits = decontam.seed_bitmap(spark.createDataFrame([(v,) for v in values], "value long"))
    assert decontam._in_bitmap(bits, np.array(values, np.int64)).all() and len(bits) * 64 == decontam.BITMAP_LEAST
    assert decontam._in_bitmap(bits, np.arange(1000, 3000)).sum() == 0


def test_small_sources_meet_their_targets(spark):
    """Sources of 1 to 300 words beside a large one, in documents of all lengths."""
    sizes = {"big": 40_000} | {f"s{n:03}": n for n in [1, 2, 3, 20, 31, 32, 33, 63, 64, 65, 66, 100, 127, 128, 129, 130, 200, 299, 300]}
    rows, rest = [], dict(sizes)
    while rest:
        for source in list(rest):
            n = min(rest[source], [1, 7, 90, 400][len(rows) % 4])
            rows.append((len(rows), source, "w " * n))
            rest[source] -= n
            if not rest[source]:
                del rest[source]
    rows += [(len(rows), "none", ""), (len(rows) + 1, None, "x y z"), (len(rows) + 2, "none", None)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    taken, target, size = Counter(), {}, Counter()
    for x in got:
        taken[x["source"]] += x["taken"]
        size[x["source"]] += x["size"]
        target[x["source"]] = x["target"]
        assert 0 <= x["taken"] <= 3 * x["size"]
    assert {k: v for k, v in size.items() if k not in ("none", None)} == sizes and size[None] == 3
    for source, t in target.items():
        assert abs(taken[source] - t) <= max(0.5, 0.02 * t, size[source] / mixing.LEAST_BLOCKS), (source, size[source], t, taken[source])
        if t == 3 * size[source]:
            assert taken[source] == t


@pytest.mark.parametrize(("size", "n"), [(1, 1), (20, 20), (65, 32), (1000, 32), (5000, 79), (64 * 40, 40)])
def test_blocks_share_all_words_evenly(spark, size, n):
    words = spark.range(size).select(F.lit(size).alias("size"), F.col("id").alias("w")).withColumn("n", mixing.n_blocks(F.col("size")))
    words = words.withColumn("index", mixing.block_of(F.col("w"), F.col("size"), F.col("n")))
    words = words.withColumn("fits", (F.col("w") >= mixing.block_start(F.col("index"), F.col("size"), F.col("n"))) & (F.col("w") < mixing.block_start(F.col("index") + 1, F.col("size"), F.col("n"))))
    per = [x["count"] for x in words.where("fits").groupBy("index").count().collect()]
    assert len(per) == n and sum(per) == size and max(per) - min(per) <= 1 and max(per) <= mixing.BLOCK


def test_edge_rows_and_empty_tables(spark, edge, empty, labels):
    n = len(EDGE)
    none = labels.where("false")
    vocabulary = token_count.Vocabulary((("▁", -1.0), ("o", -1.0)), False)
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6")], "item_id long, text string")
    for d, size in ((edge, n), (empty, 0)):
        assert sharding.shard_digest(d).count() == size
        assert lm_scoring.pseudo_likelihood(d).count() == size
        assert token_count.count_tokens(d, vocabulary).count() == size
        assert mixing.mix_digest(d).count() == size
        assert quality_rules.quality_rules(d, none).count() == size
        assert quality_rank.quality_digest(d, none).count() == size
        assert langid.language_digest(d).count() == size
        assert near_dup.near_duplicates(d).count() == size
        assert decontam.contamination(d, bench).count() == min(size, 1)
        assert decontam.contamination(d, bench.where("false")).count() == 0
    near = {x["doc_id"]: x for x in near_dup.near_duplicates(edge).collect()}
    assert near[1]["n_shingles"] == 0 and near[6]["component_id"] == 4 and near[None]["component_id"] is None and near[None]["kept"]
    lang = {x["doc_id"]: x["lang_pred"] for x in langid.language_digest(edge).collect()}
    assert lang[1] == lang[2] == lang[3] == "und"


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    last = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        last = stage(spark, last, SF).cache()
        assert last.columns == docs.columns and last.count() > 0, name
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() == last.count() and {x["shard"] for x in rows.select("shard").distinct().collect()} <= set(range(16))


def test_queries_and_sql_have_the_same_names():
    assert set(queries.oracle_sql()) <= set(queries.queries()) and len(queries.queries()) == 10


def test_hot_response_and_repeated_responses(spark, monkeypatch):
    monkeypatch.setattr(revisits, "HOT_PART", 10)
    full = [("f1", "http://a.org/p", 100, '"t"', "body"), ("f1", "http://a.org/p", 100, '"s"', "less"), ("f2", "http://b.org/p", 100, '"t"', "other")]
    rows = [(i, "response", u, t, tag, None, None, {}, p) for i, u, t, tag, p in full]
    rows += [(f"r{i % 400}", "revisit", "http://a.org/p", 200 + i // 2, '"t"', None, None, {}, None) for i in range(500)] + [("q", "revisit", "http://b.org/p", 101, '"t"', None, None, {}, None)] * 2
    got = Counter((x["record_id"], x["ts"], x["status"], x["payload"]) for x in revisits.resolve_revisits(spark.createDataFrame(rows, revisits.CAPTURE)).collect())
    assert got == Counter([(f"r{i % 400}", 200 + i // 2, "resolved", "body") for i in range(500)] + [("q", 101, "resolved", "other")] * 2)
    assert revisits.resolve_revisits(spark.createDataFrame([], revisits.CAPTURE)).count() == 0
    clash = spark.createDataFrame(rows[:4], revisits.CAPTURE).withColumns({"key": F.lit(1), "one": F.lit(2), "canonical_url": F.lit("x"), "status": F.lit("y"), "hour": F.lit(1), "n": F.lit(3)})
    assert [x["status"] for x in revisits.resolve_revisits(clash).collect()] == ["resolved"]


def test_mix_stage_keeps_clashing_columns(spark):
    names = ("copies", "copy_no", "mixed_id", "passes", "taken", "c0", "place", "rank", "mark")
    d = spark.createDataFrame([(i, f"w{i} " * (i % 9), None, "s" if i % 3 else None) for i in range(60)] + [(None, None, "en", "s")], "doc_id long, text string, lang string, source string").withColumns({n: F.lit(n) for n in names})
    got = mixing.mixed_documents(d)
    assert got.columns == d.columns
    rows = got.collect()
    assert all(tuple(x[n] for n in names) == names for x in rows) and {x["doc_id"] for x in rows} >= {0, 9, None}
    assert mixing.mixed_documents(d.where("false")).count() == 0


def test_slots_take_every_block_once_a_pass(spark):
    t = spark.createDataFrame([(0, 2560, 2560.0 * 2.5), (1, 6400, 640.0 * 8.5), (2, 0, 0.0)], "place int, source_size long, target double")
    slots = mixing.source_slots(t)
    assert sorted(map(tuple, slots.collect())) == [(0, 40, 0, 100), (1, 100, 100, 185)]
    rows = mixing.slot_blocks(slots, shard_slots=16).collect()
    per = Counter((x["place"], x["index"]) for x in rows)
    assert len(rows) == 185 and all(2 <= per[0, i] <= 3 for i in range(40)) and all(per[1, i] <= 1 for i in range(100))
    shards = Counter(x["shard"] for x in rows)
    assert [shards[i] for i in range(12)] == [16] * 11 + [9]
    assert len({x["k"] for x in rows if x["place"] == 1}) == 85


def test_slot_maps_are_stored_and_read_again(spark, docs, tmp_path):
    store = str(tmp_path / "maps")
    assert sharding.latest_map(spark, store) is None
    first = {x["doc_id"]: x for x in sharding.assign_shards(docs, map_path=store).collect()}
    one = sharding.latest_map(spark, store)
    assert one.n_shards == 16 and {x["map_version"] for x in first.values()} == {one.version}
    again = {x["doc_id"]: x for x in sharding.assign_shards(docs, map_path=store).collect()}
    assert again == first and sharding.latest_map(spark, store) == one
    grown = {x["doc_id"]: x["shard"] for x in sharding.assign_shards(docs, n_shards=17, map_path=store).collect()}
    two = sharding.latest_map(spark, store)
    assert two.version == one.version + 1 and two.n_shards == 17
    moved = [i for i in grown if grown[i] != first[i]["shard"]]
    assert moved and all(two.shard_of[first[i]["virtual_slot"]] == grown[i] for i in grown)


def test_a_part_of_any_length_takes_little_memory():
    import tracemalloc

    own = token_count.PieceCounter(token_count.Vocabulary((("a", -1.0), ("aa", -1.5), ("▁", -1.0)), False))
    tracemalloc.start()
    assert own.part("a" * 400_001) == 200_001
    assert tracemalloc.get_traced_memory()[1] < 10 * 400_001
    tracemalloc.stop()


def test_unlikely_pairs_are_not_tiled_and_none_is_lost(spark):
    rng = np.random.default_rng(8)
    item = [f"t{i}" for i in range(60)]
    texts = [" ".join([f"z{j}" for j in range(3)] + item[a : a + n]) for a, n in zip(rng.integers(0, 40, 30), rng.integers(1, 60, 30))]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[::-1]))], "item_id long, text string")
    for most in (decontam.SEEDS_MOST, 0):
        every = {tuple(x) for x in decontam.overlaps(d, b, seeds_most=most).collect()}
        likely = {tuple(x) for x in decontam.overlaps(d, b, seeds_most=most, least=0.5).collect()}
        assert {x for x in every if x[3] >= 0.5 * x[2]} == {x for x in likely if x[3] >= 0.5 * x[2]} and 0 < len(likely) < len(every)


def brute_components(texts, percent):
    sets = {}
    for i, t in texts.items():
        w = [x.lower() for x in words(t)]
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))) if w else frozenset()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_verdict_of_quality_rules_by_brute_force(docs, labels):
    import xxhash

    ratios = quality_rules.log_ratios(docs, labels)
    texts = {x["doc_id"]: words(x["text"]) for x in docs.collect()}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    h = lambda data, seed=42: xxhash.xxh64(data, seed).intdigest()
    for x in quality_rules.quality_rules(docs, labels).collect():
        keys = [h(w.encode()) for w in texts[x["doc_id"]]]
        grams = [signed(k) % quality_rules.BUCKETS for k in keys]
        grams += [signed(h(b.to_bytes(8, "little"), h(a.to_bytes(8, "little")))) % quality_rules.BUCKETS for a, b in zip(keys, keys[1:])]
        score = sum(ratios[g] for g in grams) / len(grams) if grams else 0.0
        assert x["score"] == pytest.approx(score, abs=1e-9)
        if abs(score - quality_rules.THRESHOLD) > 1e-9:
            assert x["kept"] == (not x["base_failed"] and score >= quality_rules.THRESHOLD)


def test_language_profiles_by_brute_force(docs):
    def grams(text):
        n, text = Counter(), text or ""
        if not any(map(str.isalpha, text)):
            return n
        plain = " " + " ".join("".join(c if c.isalpha() or "̀" <= c <= "ͯ" else " " for c in text.lower()).split()) + " "
        for k in (1, 2, 3):
            for i in range(len(plain) - k + 1):
                g = plain[i : i + k]
                if g != " " and " " not in g[1:-1] and g != "  ":
                    n[g] += 1
        return n

    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    order = lambda n: [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], code(x[0])))][: langid.TOP]
    rows, per = docs.collect(), defaultdict(Counter)
    for x in rows:
        if x["lang"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 5:
            per[x["lang"]].update(grams(x["text"]))
    profiles = {lang: order(n) for lang, n in per.items()}
    assert langid.learn(docs) == {lang: [code(g) for g in p] for lang, p in profiles.items()}
    rank = {lang: {g: i for i, g in enumerate(p)} for lang, p in profiles.items()}
    for x in langid.language_digest(docs).collect():
        own = order(grams(next(r["text"] for r in rows if r["doc_id"] == x["doc_id"])))
        far = {lang: sum(abs(r[g] - i) if g in r else langid.TOP for i, g in enumerate(own)) for lang, r in rank.items()}
        best = min(sorted(far), key=far.get) if own else "und"
        assert x["lang_pred"] == best and x["score"] == pytest.approx(1 - far[best] / (langid.TOP * len(own)) if own else 0.0)


def test_bradley_terry_fit_by_brute_force():
    rng = np.random.default_rng(4)
    k = len(quality_rank.FEATURES)
    x = np.hstack([rng.normal(0, 1, (400, k)), rng.dirichlet(np.ones(quality_rank.HASHED), 400)])
    label = (x[:, 0] - 0.5 * x[:, 3] + rng.normal(0, 0.5, 400) > 0.3).astype(int)
    model = quality_rank.fit(x, label)
    z = (x - model.mean) / model.spread
    z[:, :k] = np.clip(z[:, :k], -8, 8)
    d = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, z.shape[1])
    w, ridge = np.zeros(z.shape[1]), np.repeat([1e-4, quality_rank.HASHED_RIDGE + 50 / len(x)], [k, quality_rank.HASHED])
    for _ in range(800):  # plain gradient descent over every pair
        w -= 0.3 * (-(d.T @ (1 / (1 + np.exp(d @ w)))) / len(d) + ridge * w)
    loss = lambda v: np.log1p(np.exp(-d @ v)).mean() + (ridge * v * v).sum() / 2
    assert loss(model.weights) < loss(w) + 0.02 and np.corrcoef(z @ model.weights, z @ w)[0, 1] > 0.98
    raw = z @ model.weights
    cut = (np.quantile(raw[label == 1], quality_rank.LOW_QUANTILE) + np.quantile(raw[label == 0], quality_rank.HIGH_QUANTILE)) / 2
    assert model.cut == pytest.approx(cut)


def test_scores_are_those_of_the_collected_features(docs, labels):
    text = pa.array([x["text"] for x in docs.limit(60).collect()] + [None, ""])
    model = quality_rank.train(docs, labels)
    k = len(quality_rank.FEATURES)
    for s in tk.slices(text):
        x, bucket, first = quality_rank.features(s)
        z = (np.hstack([x, quality_rank.word_shares(bucket, first)]) - model.mean) / model.spread
        z[:, :k] = np.clip(z[:, :k], -8, 8)
        assert np.allclose(z @ model.weights, model.raw(x, bucket, first), atol=1e-6)


def test_repeated_labelled_ids_are_collected_once(spark):
    d = spark.createDataFrame([(i % 5, f"good words here {i}" if i % 2 else "## $$ ||") for i in range(200)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    assert quality_rank.quality_digest(d, marks).count() == 200


def test_pseudo_likelihood_by_an_independent_forward_pass(spark):
    rng = np.random.default_rng(6)
    names = [f"w{i}" for i in range(6000)]
    texts = [" ".join(rng.choice(names, rng.integers(1, 60), p=np.arange(6000, 0, -1) / 18003000)) for _ in range(400)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    counts = lm_scoring.word_counts(df)
    shares = lm_scoring.WordShares(counts)
    net = lm_scoring.train(df, shares.frequent)
    s = next(tk.slices(pa.array([" ".join(names)])))
    key = dict(zip(names, tk.word_hashes(s, *tk.word_bounds(s)[:2])))
    n = Counter(w for t in texts for w in words(t))
    number = {int(k): i for i, k in enumerate(np.array(shares.frequent, np.int64).view(np.uint64))}
    code = lambda w: number.get(int(key[w]), lm_scoring.FREQUENT + int(key[w]) % lm_scoring.CLASSES)
    per_class = Counter()
    for w, c in n.items():
        per_class[code(w)] += c

    def softmax(v):
        e = np.exp(v - v.max())
        return e / e.sum()

    def score(t):
        w, total = words(t), 0.0
        for i, word in enumerate(w):
            near = [code(w[i + o]) if 0 <= i + o < len(w) else lm_scoring.SIZE for o in lm_scoring.OFFSETS]
            hidden = sum(net.near[p][x].astype(float) for p, x in enumerate(near)) + net.bias
            hidden = hidden / (1 + np.abs(hidden))
            g, m = divmod(code(word), lm_scoring.WIDTH)
            total += np.log(softmax(hidden @ net.group + net.group_bias)[g] * softmax(hidden @ net.out[g] + net.out_bias[g])[m])
            if code(word) >= lm_scoring.FREQUENT:
                total += np.log(n[word] / per_class[code(word)])
        return total

    got = {x["doc_id"]: x["log_likelihood"] for x in lm_scoring.pseudo_likelihood(df).collect()}
    assert all(got[i] == pytest.approx(score(t), rel=1e-4, abs=1e-3) for i, t in enumerate(texts))


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(9)
    vocabulary = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    item = text(30)
    rows = [(i, text(int(rng.integers(40, 90))) if i % 4 else "## $$ || %% " * 12, "en", f"s{i % 3}", 1) for i in range(120)]
    edited = rows[1][1].split()
    edited[10] = "changed"
    rows += [(200, rows[1][1], "en", "s0", 1), (201, " ".join(edited), "en", "s1", 1), (202, text(30) + " " + item, "en", "s2", 1), (203, " ".join(item.split()[15:] + item.split()[:15]), "fr", None, 1)]
    rows += [(None, text(50), None, "s1", 1), (204, None, "en", "s1", 1), (205, "", "en", "s1", 1), (206, text(20_000), "de", "s2", 1)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, names).withColumns({"_gone": F.lit("a"), "copies": F.lit("b"), "score": F.lit("c"), "_found": F.lit("d")})
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(120)] + [(i, 1, 0) for i in range(200, 204)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (1, None), (None, text(12))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = dict(corpus_pipeline.STAGES)
    run = lambda name, d: stage[name](spark, d, str(tmp_path)).cache()
    ids = lambda d: {x["doc_id"] for x in d.collect()}

    good = run("quality_classifier", docs)
    assert good.columns == docs.columns
    assert {i for i in ids(good) if i is None or i < 204} == {x[0] for x in rows if x[1] and not x[1].startswith("##")} - {206}
    texts = {x["doc_id"]: x["text"] for x in good.collect() if x["doc_id"] is not None}
    once = run("near_duplicates", good)
    want = {i for i, root in brute_components(texts, corpus_pipeline.NEAR_PERCENT).items() if i == root}
    assert once.columns == docs.columns and ids(once) == want | {None} and not {200, 201} & want
    clean = run("decontamination", once)
    leaks = {i for i in want if brute_tiles(words(texts[i])[:200], words(item), 5) >= 0.5 * 30}
    assert leaks == {202, 203} and clean.columns == docs.columns and ids(clean) == ids(once) - leaks
    mixed = run("mixing", clean)
    per = {x["doc_id"]: (x["taken"], x["size"]) for x in mixing.mix(clean).collect()}
    copies = Counter(x["doc_id"] for x in mixed.collect())
    assert mixed.columns == docs.columns
    assert all(copies[i] in ((taken // size, taken // size + 1) if size else (1,)) for i, (taken, size) in per.items())
    shards = run("sharding", mixed)
    assert Counter(x["doc_id"] for x in shards.collect()) == copies
    empty = docs.where("false")
    for name in stage:
        assert run(name, empty).count() == 0
