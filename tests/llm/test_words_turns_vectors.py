"""Operators 11 to 13 against brute force: spelling variants, conversation repair, near-duplicate embeddings."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import chat_repair, queries, spelling, vector_dup
from shelfmark.llm.staging import Scratch

SF = "/root/testdata/sf0.001"

# ---- 11: spelling variants


def variants_by_brute_force(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}

    def edits(w):
        letters = set("".join(n))
        out = {w[:i] + w[i + 1 :] for i in range(len(w))}
        for c in letters:
            out |= {w[:i] + c + w[i:] for i in range(len(w) + 1)} | {w[:i] + c + w[i + 1 :] for i in range(len(w))}
        return {x for x in out if x in n and x != w}

    near = {w: edits(w) for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return rows


def variants(df, **more):
    return {(x["word"], x["form"], x["root"], x["n"], x["n_near"], x["form_n"]) for x in spelling.spelling_variants(df, **more).collect()}


def word_docs():
    rnd = random.Random(3)
    stems = ["harbour", "seaside", "wonderful", "écoleélève", "aaaaaaa", "aaaaaaaa", "aaaaaa", "abababab", "Straßenbahn", "×÷×÷×÷"]
    docs = []
    for i in range(300):
        some = []
        for _ in range(40):
            w = list(rnd.choice(stems))
            if rnd.random() < 0.3:
                k, c = rnd.randrange(len(w)), rnd.choice("abcdefé")
                w[k : k + rnd.choice([0, 1])] = [rnd.choice(["", c])]
            some.append("".join(w))
        docs.append((i, " ".join(some)))
    docs += [(1000 + i, "sunflower " * 200 + "sunflowerx " * 30 + "sunflowerxy " * 5) for i in range(2)]
    docs += [(None, "harbour " * 7), (5, None), (6, ""), (7, "1 2 3"), (7, "Harbour HARBOUR harböur"), (8, ("z" * 3000 + " ") * 5 + ("z" * 2999 + " ") * 6)]
    return docs


def test_variants_are_those_of_brute_force(spark):
    docs = word_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"word": F.lit("clash"), "n": F.lit(1), "key": F.lit("k"), "root": F.lit(0)}).repartition(3)
    want = variants_by_brute_force(docs)
    assert len(want) > 100 and any(x[1] and x[1] != x[2] for x in want)
    assert variants(df) == want


def test_common_grams_take_the_finer_key_and_lose_nothing(spark):
    docs = [x for x in word_docs() if len(x[1] or "") < 10_000]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert variants(df, group_most=3) == variants_by_brute_force(docs)


def test_a_pair_shares_a_chunk_and_a_gram(spark):
    words = [("abcdefg",), ("abcdefgh",), ("xabcdefg",), ("abcxefg",), ("abdefg",), ("zzzzzzzz",)]
    df = spark.createDataFrame(words, "word string")
    pairs = {tuple(x) for x in spelling.near_pairs(df, owner=Scratch(spark)).collect()}
    assert pairs == {("abcdefg", "abcdefgh"), ("abcdefg", "xabcdefg"), ("abcdefg", "abcxefg"), ("abcdefg", "abdefg")}


def test_no_words_give_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(none).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, "short")], "doc_id long, text string")).count() == 0


def test_variants_of_documents(spark):
    docs = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {(x["word"], x["form"], x["root"], x["n"], x["n_near"], x["form_n"]) for x in queries.op11_spelling_variants(spark, SF).collect()}
    assert got == variants_by_brute_force(docs)


# ---- 12: conversation repair

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(turns):
    """(cost, audit, roles) by shortest paths over (cost, audit); turns are (initial, must go, truncated)."""
    heap, seen = [(0, "", 0, "", "")], set()
    while heap:
        cost, audit, i, state, roles = heapq.heappop(heap)
        if i == len(turns) and state in ("", "a"):
            return cost, audit, roles
        if (i, state) in seen:
            continue
        if not audit.endswith("I"):  # an audit that ends in inserts may be a part of another
            seen.add((i, state))
        for t in "ua":
            if (state, t) in NEXT and not audit.endswith("III"):
                heapq.heappush(heap, (cost + 2, audit + "I", i, NEXT[state, t], roles + t))
        if i < len(turns):
            initial, gone, cut = turns[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, roles))
            if not gone:
                if (state, initial) in NEXT:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, NEXT[state, initial], roles + initial))
                for t in "ua":
                    if (state, t) in NEXT:
                        heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, NEXT[state, t], roles + t))
    raise AssertionError


def repairs_by_brute_force(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        role, text = show(role), show(text)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        convs[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        turns = [x[0] for x in own if x[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None)
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, roles = cheapest([(x[1][:1], f in ("blank", "duplicate"), int(f == "truncated")) for x, f in zip(own, faults)])
        lines, at, place = [], 0, 0
        for edit in audit:
            if edit == "I":
                lines.append({"u": "user", "a": "assistant"}[roles[place]] + ":")
            else:
                if edit != "D":
                    lines.append((own[at][1] if edit == "K" else {"u": "user", "a": "assistant"}[roles[place]]) + ":" + own[at][2])
                at += 1
            place += edit != "D"
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repairs(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({x["conv_id"] for x in rows}) == len(rows)
    return {x["conv_id"]: tuple(x[n] for n in names) for x in rows}


def test_parse_is_the_cheapest_repair():
    rnd = random.Random(5)
    for _ in range(1500):
        turns = [(rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rnd.random() < 0.15, rnd.random() < 0.2) for _ in range(rnd.randint(0, 7))]
        parse = chat_repair.Parse()
        for role, gone, cut in turns:
            parse.turn(role, "x", gone, cut)
        assert parse.end()[:3] == cheapest([(r[:1], g, int(c)) for r, g, c in turns]), turns


def test_long_conversations_keep_few_stacks():
    rnd = random.Random(6)
    turns = [(rnd.choice(["system", "user", "assistant", "tool"]), rnd.random() < 0.1, rnd.random() < 0.1) for _ in range(3000)]
    parse = chat_repair.Parse()
    for role, gone, cut in turns:
        parse.turn(role, "x", gone, cut)
        assert len(parse.live) <= 16
    cost, audit, roles, _ = parse.end()
    assert (cost, audit, roles) == cheapest([(r[:1], g, int(c)) for r, g, c in turns])


def test_repairs_of_conversations(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert repairs(queries.op12_conversation_repair(spark, SF)) == repairs_by_brute_force(rows)


def odd_conversations():
    rnd = random.Random(7)
    rows = [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (1, None, None, None), (1, None, "user", "x"), (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 9, "", "t."), (3, 0, "system", "only.")]
    rows += [(4, i, rnd.choice(["user", "assistant", "tool", None]), rnd.choice(["Yes. ", "no", "éß?\n\t", "", None, " \x0b ", "!" * 3])) for i in range(400)]
    rows += [(10 + i, t, rnd.choice(["system", "user", "assistant"]), f"t{rnd.randrange(3)}{rnd.choice(['.', '', '!'])}") for i in range(60) for t in range(rnd.randrange(1, 7))]
    rows += [(90, i, "user", "long " * 60_000 + ".") for i in range(3)]
    return rows


def test_repairs_of_odd_conversations(spark):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({"gone": F.lit(5), "fault": F.lit("x"), "nth": F.lit(1), "cost": F.lit(1), "kind": F.lit(0)}).repartition(5)
    assert repairs(chat_repair.repair_digest(df)) == repairs_by_brute_force(rows)
    assert chat_repair.repair_digest(df.limit(0)).count() == 0


def test_repaired_turns_are_those_that_were_hashed(spark):
    df = spark.createDataFrame([x for x in odd_conversations() if x[0] != 90], "conv_id long, turn int, role string, text string")
    rows = chat_repair.damaged(df)
    hashed = {x["conv_id"]: (x["audit"], x["roles"], x["repaired_sha256"]) for x in chat_repair.repair(rows).collect()}
    lines = defaultdict(list)
    for x in chat_repair.repaired_turns(rows).orderBy("place").collect():
        assert x["place"] == len(lines[x["conv_id"]])
        lines[x["conv_id"]].append((x["role"], x["text"]))
    for conv, (audit, roles, sha) in hashed.items():
        own = lines[conv]
        assert "".join(r[:1] for r, _ in own) == roles and re.fullmatch("(s?(ua)+)?", roles)
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in own).encode()).hexdigest() == sha, audit


# ---- 13: near-duplicate embeddings


def links_by_brute_force(rows):
    """{row number: (n_links, component_id)} of (vec_id, label, vector), with ids all different."""
    good = [i for i, (v, label, x) in enumerate(rows) if v is not None and label is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    links, root = Counter(), {i: i for i in good}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(good):
        for j in good[n + 1 :]:
            a, b = np.array(rows[i][2], float), np.array(rows[j][2], float)
            if rows[i][1] == rows[j][1] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                links[i] += 1
                links[j] += 1
                p, q = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[q] = p
    return {rows[i][0]: (links[i], rows[find(i)][0] if i in root else rows[i][0]) for i in range(len(rows))}


def vector_rows():
    rng = np.random.default_rng(4)
    rows = []
    for label in (1, 2, 3):
        base = rng.normal(size=(4, 12))
        for k in range(120):
            x = base[k % 4] + rng.normal(size=12) * [0.12, 0.25, 0.4, 1.0][k % 4] if k % 3 else rng.normal(size=12)
            rows.append((label * 1000 + k, label, [float(v) for v in np.float32(x)]))
    rows += [(5000 + k, 2, rows[130][2]) for k in range(150)]  # copies
    rows += [(6000 + k, 1, [float(v) for v in np.float32(rng.normal(size=12) * 0.01 + 1)]) for k in range(150)]  # near copies
    rows += [(1, 1, None), (2, 1, []), (3, 1, [0.0] * 12), (4, 1, [float("nan")] + [1.0] * 11), (5, 1, [None] + [1.0] * 11), (6, None, [1.0] * 12), (7, 1, [1.0] * 5), (8, 1, [2.0] * 5), (9, 1, [-0.0, 1.0]), (10, 1, [0.0, 1.0])]
    rows += [(11, 3, [1e30] * 12), (12, 3, [1e-30] * 12)]
    return rows


@pytest.mark.parametrize("shard_rows", [2048, 40])
def test_links_are_those_of_brute_force(spark, shard_rows):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({"mark": F.lit("x"), "rep": F.lit(1), "shard": F.lit(0), "n": F.lit(2)}).repartition(4)
    got = vector_dup.vector_duplicates(df, shard_rows=shard_rows).collect()
    assert len(got) == len(rows)
    want = links_by_brute_force(rows)
    assert {x["vec_id"]: (x["n_links"], x["component_id"]) for x in got} == want
    assert all(x["kept"] == (x["vec_id"] == x["component_id"]) for x in got)


def test_null_and_repeated_ids(spark):
    rows = [(None, 1, [1.0, 0.0]), (None, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.01]), (1, 1, [0.0, 1.0]), (9, 1, [0.01, 1.0])]
    got = sorted(tuple(-1 if v is None else v for v in x) for x in vector_dup.vector_duplicates(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect())
    assert got == [(-1, 0, -1, True)] * 2 + [(1, 1, 1, True)] * 3 + [(2, 1, 1, False), (9, 1, 1, False)]
    assert vector_dup.vector_duplicates(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_graph_search_finds_the_nearest():
    rng = np.random.default_rng(9)
    unit = rng.normal(size=(1500, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    graph = vector_dup.Graph.built(unit, np.arange(1500))
    assert len(graph.layers) > 1 and all((x < 1500).all() for x in graph.layers)
    asked = rng.normal(size=(300, 32))
    asked = (asked / np.linalg.norm(asked, axis=1, keepdims=True)).astype(np.float32)
    true = np.argsort(-(asked @ graph.short.T), axis=1)[:, :10]
    found = [np.mean([np.isin(t, f).mean() for t, f in zip(true, graph.search(asked, width)[0])]) for width in (16, 128)]
    assert found[1] > 0.95 and found[1] >= found[0]


def test_beams_widen_until_the_audit_passes(monkeypatch):
    rng = np.random.default_rng(2)
    unit = np.vstack([rng.normal(size=(400, 8)), 3 + rng.normal(size=(300, 8)) * 0.2])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    marks = np.arange(700)
    graph = vector_dup.Graph.built(unit, marks)
    widths, search = [], vector_dup.Graph.search
    monkeypatch.setattr(vector_dup.Graph, "search", lambda self, q, width: widths.append(width) or search(self, q, width))
    q, node = vector_dup.shard_links(graph, unit, marks, width=1)
    assert max(widths) > 1
    exact = unit @ unit.T >= 0.93
    assert len(set(zip(q.tolist(), node.tolist()))) == len(q) and exact[q, node].all() and len(q) >= 0.995 * exact.sum()


def test_a_task_hands_on_classes_not_pairs():
    rng = np.random.default_rng(8)
    unit = 1 + rng.normal(size=(500, 8)) * 0.01
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = np.arange(500) + 7
    out = vector_dup._pair_rows([(ids, ids, np.full(500, 3), vector_dup.Graph.built(unit, ids))], 0.93)
    assert isinstance(out, pa.Table) and out.num_rows == 500 and set(out.column("root").to_pylist()) == {7} and set(out.column("n").to_pylist()) == {3 * 499}


def test_recall_over_whole_tables(spark):
    rows = [(x["vec_id"], x["label"], x["embedding"]) for x in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    total = 0
    for label in {x[1] for x in rows}:
        unit = np.array([x[2] for x in rows if x[1] == label], float)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        total += int((unit @ unit.T >= 0.93).sum()) - len(unit)
    found = queries.op13_vector_duplicates(spark, "/root/testdata/sf0.1").agg(F.sum("n_links")).first()[0]
    assert 0.9 * total <= found <= total
