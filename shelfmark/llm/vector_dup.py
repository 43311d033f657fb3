"""Operator 13, near-duplicate embeddings by hierarchical navigable small-world graphs, one a shard.

Vectors are compared only with those of an equal label and length. Rows with equal label and vector form one class, and
only the class goes on, with the number of its ids. The classes of a label are dealt by hash to shards of about SHARD_ROWS; each shard
gets its own graph: every node has a random level, a layer holds the nodes of its level and above, and a
node's neighbours in a layer are the nearest that aren't nearer to a neighbour already chosen.

Every class then queries every shard of its label. One task takes two shards (or one with itself), so that a link found from either side counts for both.
A search goes down the layers and ends with a beam in the lowest. A query whose whole beam are links gets
a wider one until some of it are not. Every SAMPLE_STEP-th query by hash is also compared with the whole shard: where the beams found fewer than
AUDIT_LINKS of its links, or fewer than AUDIT_NEAREST of the nearest vectors, all queries get beams of
twice the width, until the audit passes; a beam as wide as the shard is replaced by a scan of the shard. Candidates are links
if the cosine in double precision reaches the threshold.

A task hands on one row for each class that has a link: how many ids it is linked with, and the least id of
its component within the task. So copies and near copies of one vector never expand into pairs. Components are united
over tasks by ``connected_components``.

Memory of a task: two shards with their graphs (about 6 MB for 64 dimensions). A graph is sent once for each shard of its label.

Cases: a vector that is null, empty or zero or holds a null or non-finite component, or whose label is null, links with nothing; vectors of
different lengths aren't compared; a null vec_id has a null component, is kept and links with nothing; rows
with one vec_id and an equal vector and label count as one vector; rows of one vec_id with different vectors keep their own links, aren't linked to each other and
share a component; an empty table gives no rows; other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import textkit as tk
from shelfmark.llm.near_dup import connected_components, matched
from shelfmark.llm.staging import Scratch

COSINE = 0.93
SHARD_ROWS = 2048
FAN, BUILD_BEAM, BEAM = 16, 64, 32
SAMPLE_STEP, AUDIT_LINKS, AUDIT_NEAREST = 8, 0.995, 0.9
TASKS_MOST = 10_000
FIRST, BATCH = 64, 256
#: Room for rounding when candidates are compared in single precision.
SLACK = 1e-4


def _lockstep(unit: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of some queries at once: each round every query opens its ``step`` best nodes that are still closed."""
    n, fan = len(queries), links.shape[1]
    ids, sims, closed = np.full((n, width), -1, np.int64), np.full((n, width), -2, np.float32), np.zeros((n, width), bool)
    seen = np.full((n, len(unit)), -1, np.int32)
    k = min(entry.shape[1], width)
    ids[:, :k] = entry[:, :k]
    sims[:, :k] = np.einsum("qkd,qd->qk", unit[entry[:, :k]], queries)
    closed[:, :k] = True
    seen[np.arange(n)[:, None], entry] = 0
    step = min(step, width)
    while True:
        pick = np.argpartition(-np.where(closed, sims, -3), step - 1, axis=1)[:, :step]
        ok = np.take_along_axis(closed, pick, 1)
        if not ok.any():
            return ids, sims
        np.put_along_axis(closed, pick, False, 1)
        near = np.where(ok[:, :, None], links[np.take_along_axis(ids, pick, 1)], -1).reshape(n, step * fan)
        q, at = np.nonzero(near >= 0)
        node = near[q, at]
        fresh = seen[q, node] < 0
        q, at, node = q[fresh], at[fresh], node[fresh]
        seen[q, node] = at
        once = seen[q, node] == at  # of one node reached twice in a round
        q, at, node = q[once], at[once], node[once]
        new_ids, new_sims = np.full(near.shape, -1, np.int64), np.full(near.shape, -2, np.float32)
        new_ids[q, at], new_sims[q, at] = node, np.einsum("ij,ij->i", unit[node], queries[q])
        ids, sims, closed = np.hstack([ids, new_ids]), np.hstack([sims, new_sims]), np.hstack([closed, new_ids >= 0])
        best = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        ids, sims, closed = (np.take_along_axis(x, best, 1) for x in (ids, sims, closed))


def _beam(unit: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    width = max(1, min(width, len(unit)))
    step = max(2, width // 32)
    rows = max(8, 16384 // (step * links.shape[1]))
    parts = [_lockstep(unit, links, queries[at : at + rows], entry[at : at + rows], width, step) for at in range(0, len(queries), rows)]
    if not parts:
        return np.zeros((0, width), np.int64), np.zeros((0, width), np.float32)
    return np.vstack([x[0] for x in parts]), np.vstack([x[1] for x in parts])


def _spread(unit: np.ndarray, cand: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's candidates (-1: none): the nearest that aren't nearer to one chosen before, then the nearest of the rest."""
    order = np.argsort(-sims, axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    held = unit[np.maximum(cand, 0)]
    between = np.matmul(held, held.transpose(0, 2, 1))
    chosen = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        hidden = (chosen & (between[:, j, :] > sims[:, j, None])).any(axis=1)
        chosen[:, j] = (cand[:, j] >= 0) & ~hidden & (chosen.sum(axis=1) < most)
    rank = np.where(chosen, 0, np.where(cand >= 0, 1, 2))
    first = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.full((len(cand), most), -1, np.int32)
    out[:, : first.shape[1]] = np.take_along_axis(cand, first, 1)
    return out


def _link_back(unit: np.ndarray, links: np.ndarray, batch: np.ndarray, picks: np.ndarray) -> None:
    """The batch becomes a neighbour of its neighbours; a list that overflows is chosen anew."""
    most = links.shape[1]
    at, col = np.nonzero(picks >= 0)
    to, by = picks[at, col].astype(np.int64), batch[at]
    order = np.argsort(to, kind="stable")
    to, by = to[order], by[order]
    nodes, starts = np.unique(to, return_index=True)
    full, lists = [], []
    for node, own in zip(nodes, np.split(by, starts[1:])):
        held = links[node]
        both = np.unique(np.concatenate([held[held >= 0], own]))
        if len(both) <= most:
            links[node, : len(both)] = both
        else:
            full.append(node), lists.append(both)
    for low in range(0, len(full), BATCH):
        some, of = np.array(full[low : low + BATCH]), lists[low : low + BATCH]
        cand, sims = np.full((len(some), max(map(len, of))), -1, np.int64), np.full((len(some), max(map(len, of))), -2, np.float32)
        for i, x in enumerate(of):
            cand[i, : len(x)] = x
            sims[i, : len(x)] = unit[x] @ unit[some[i]]
        if cand.shape[1] > 3 * most:
            keep = np.argpartition(-sims, 3 * most, axis=1)[:, : 3 * most]
            cand, sims = np.take_along_axis(cand, keep, 1), np.take_along_axis(sims, keep, 1)
        links[some] = _spread(unit, cand, sims, most)


class Graph:
    """A shard's vectors (``unit``: of length 1, in double precision) and the layers over them, highest first."""

    def __init__(self, unit: np.ndarray, levels: np.ndarray, layers: list[np.ndarray], top: int):
        self.unit, self.levels, self.layers, self.top = unit, levels, layers, top
        self.short = unit.astype(np.float32)

    @staticmethod
    def built(unit: np.ndarray, marks: np.ndarray) -> Graph:
        """The graph over the rows; ``marks`` are long hashes that give each row its level."""
        share = (tk.mix(marks.astype(np.int64).view(np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
        levels = np.minimum(np.floor(-np.log(np.maximum(share, 1e-300)) / np.log(FAN)), 8).astype(np.int32)
        order = np.argsort(-levels, kind="stable")
        graph = Graph(unit, levels, [], int(order[0]))
        for level in range(int(levels.max()), -1, -1):
            graph._add_layer(order[: int((levels >= level).sum())], FAN if level else 2 * FAN)
        return graph

    def _add_layer(self, nodes: np.ndarray, most: int) -> None:
        unit, links = self.short, np.full((len(self.short), most), -1, np.int32)
        first = nodes[:FIRST]
        if len(first) > 1:
            sims = unit[first] @ unit[first].T
            np.fill_diagonal(sims, -2)
            cand = np.broadcast_to(first, sims.shape).copy()
            np.fill_diagonal(cand, -1)
            links[first] = _spread(unit, cand, sims, most)
            _link_back(unit, links, first, links[first])
        done = len(first)
        while done < len(nodes):
            batch = nodes[done : done + min(BATCH, done)]
            ids, sims = _beam(unit, links, unit[batch], self._entry(unit[batch]), BUILD_BEAM)
            own = unit[batch] @ unit[batch].T
            np.fill_diagonal(own, -2)
            top = np.argpartition(-own, min(FAN, len(batch) - 1), axis=1)[:, :FAN]
            mine, its = batch[top], np.take_along_axis(own, top, 1)
            mine[its <= -2] = -1
            picks = _spread(unit, np.hstack([ids, mine]), np.hstack([sims, its]), FAN)
            links[batch, :FAN] = picks
            _link_back(unit, links, batch, picks)
            done += len(batch)
        self.layers.append(links)

    def _entry(self, queries: np.ndarray, layers: list[np.ndarray] | None = None) -> np.ndarray:
        """Each query's nearest nodes as found in the layers so far."""
        at = np.full((len(queries), 1), self.top, np.int64)
        for links in self.layers if layers is None else layers:
            ids, sims = _beam(self.short, links, queries, at, 4)
            at = np.take_along_axis(ids, np.argmax(sims, axis=1)[:, None], 1)
        return at

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each query (single precision), ``width`` near nodes and their cosines, in any order (-1: none)."""
        return _beam(self.short, self.layers[-1], queries, self._entry(queries, self.layers[:-1]), width)


def _wide(graph: Graph, queries: np.ndarray, width: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of all found with at least ``least``; beams full of them are widened, and one as wide as the shard is a scan."""
    rows, found = np.arange(len(queries)), []
    while len(rows) and width < len(graph.short):
        ids, sims = graph.search(queries[rows], width)
        full = (sims >= least).all(axis=1)
        q, k = np.nonzero((sims >= least) & ~full[:, None])
        found.append((rows[q], ids[q, k]))
        rows, width = rows[full], width * 4
    for low in range(0, len(rows), BATCH):
        q, node = np.nonzero(queries[rows[low : low + BATCH]] @ graph.short.T >= least)
        found.append((rows[low + q], node))
    return (np.concatenate([x[i] for x in found]).astype(np.int64) for i in (0, 1)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def shard_links(graph: Graph, unit: np.ndarray, marks: np.ndarray, cosine: float = COSINE, width: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of the links from rows ``unit`` to a shard, with beams as wide as the audit asks for."""
    queries, least = unit.astype(np.float32), np.float32(cosine - SLACK)
    sample = np.flatnonzero(tk.mix(marks.astype(np.int64).view(np.uint64) ^ np.uint64(13)) % np.uint64(SAMPLE_STEP) == 0)
    if len(sample) < 16:
        sample = np.arange(min(len(queries), 16))
    exact = queries[sample] @ graph.short.T
    at, of = np.nonzero(exact >= least)
    true = np.unique(sample[at] * len(graph.short) + of)
    nearest = exact.max(axis=1, initial=-2) - SLACK
    while True:
        q, node = _wide(graph, queries, width, least)
        if width >= len(graph.short):
            break
        got = np.isin(true, q * len(graph.short) + node).sum()
        best = graph.search(queries[sample], width)[1].max(axis=1, initial=-2)
        if got >= AUDIT_LINKS * len(true) and (best >= nearest).sum() >= AUDIT_NEAREST * len(sample):
            break
        width *= 2
    sure = np.einsum("ij,ij->i", unit[q], graph.unit[node]) >= cosine
    return q[sure], node[sure]


def _unit(rows: pa.ChunkedArray, length: int) -> np.ndarray:
    """The vectors scaled to length 1 in double precision."""
    x = rows.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


_SHARD = "label string, length int, shard int, shards int, reps binary, marks binary, copies binary, vectors binary, levels binary, layers array<binary>, top int"


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    label, length, shard = (x.as_py() for x in key)
    rows = rows.sort_by([("rep", "ascending"), ("mark", "ascending")])
    unit, marks = _unit(rows.column("embedding"), length), rows.column("mark").to_numpy()
    graph = Graph.built(unit, marks)
    one = {
        "label": [label], "length": [length], "shard": [shard], "shards": [rows.column("shards")[0].as_py()], "reps": [rows.column("rep").to_numpy().tobytes()],
        "marks": [marks.tobytes()], "copies": [rows.column("copies").to_numpy().tobytes()], "vectors": [unit.tobytes()], "levels": [graph.levels.tobytes()],
        "layers": [[x.tobytes() for x in graph.layers]], "top": [graph.top],
    }
    types = {"length": pa.int32(), "shard": pa.int32(), "shards": pa.int32(), "top": pa.int32(), "layers": pa.list_(pa.binary())}
    return pa.table({k: pa.array(v, types.get(k)) for k, v in one.items()})


def _stored(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
    reps, marks, copies = (np.frombuffer(row[k], np.int64) for k in ("reps", "marks", "copies"))
    unit = np.frombuffer(row["vectors"], np.float64).reshape(len(reps), row["length"])
    layers = [np.frombuffer(x, np.int32).reshape(len(reps), -1) for x in row["layers"]]
    return reps, marks, copies, Graph(unit, np.frombuffer(row["levels"], np.int32), layers, row["top"])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place of each place's component under the links a-b."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _pair_rows(parts: list[tuple], cosine: float) -> pa.Table:
    """rep, mark, how many ids it is linked with and the least rep of its component, of each class with a link between the shards (or in the one)."""
    (reps, marks, copies, graph), last = parts[0], parts[-1]
    if len(parts) == 1:
        q, node = shard_links(graph, graph.unit, marks, cosine)
        low, high = np.minimum(q, node), np.maximum(q, node)
    else:
        q, node = shard_links(graph, last[3].unit, last[1], cosine)
        back, to = shard_links(last[3], graph.unit, marks, cosine)
        low, high = np.concatenate([node, back]), np.concatenate([q, to]) + len(reps)
        reps, marks, copies = (np.concatenate([x, y]) for x, y in zip((reps, marks, copies), last[:3]))
    codes = np.unique(low * len(reps) + high)
    low, high = codes // max(len(reps), 1), codes % max(len(reps), 1)
    other = (low != high) & (reps[low] != reps[high])
    low, high = low[other], high[other]
    n = np.zeros(len(reps), np.int64)
    np.add.at(n, low, copies[high])
    np.add.at(n, high, copies[low])
    order = np.argsort(reps, kind="stable")  # so that the least place is that of the least rep
    place = np.empty(len(reps), np.int64)
    place[order] = np.arange(len(reps))
    root = reps[order][_roots(len(reps), place[low], place[high])][place]
    some = n > 0
    return pa.table({"rep": reps[some], "mark": marks[some], "n": n[some], "root": root[some]})


def _linker(cosine: float):
    def link(rows: pa.Table) -> pa.Table:
        return _pair_rows([_stored(x) for x in rows.sort_by("shard").to_pylist()], cosine)

    return link


def usable() -> F.Column:
    """Whether a row's vector may link: label and id not null, all components finite, not all zero."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def vector_duplicates(vectors: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id long, embedding array, label)."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("embedding", F.when(usable(), F.transform("embedding", lambda v: v + 0.0))).withColumn("length", F.size("embedding"))
    key = [F.xxhash64(F.lit(i), "label", "embedding") for i in (1, 2)]
    rows = scratch.staged(rows.select("vec_id", "label", "length", "embedding", F.when(F.col("length") > 0, key[0]).alias("mark"), F.when(F.col("length") > 0, key[1]).alias("mark2")), "vectors")
    ids = rows.where("mark is not null").groupBy("mark", "mark2", "vec_id").agg(F.min_by(F.struct("label", "length", "embedding"), "vec_id").alias("x"))
    classes = ids.groupBy("mark", "mark2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("x").alias("x"))
    classes = scratch.staged(classes.select("mark", "mark2", "rep", "copies", "x.label", "x.length", "x.embedding", F.xxhash64("x.label", "x.length").alias("kind")), "classes")

    kinds = scratch.staged(classes.groupBy("kind").agg(F.count("*").alias("n")).withColumn("shards", F.ceil(F.col("n") / shard_rows).cast("int")), "kinds")
    counted = kinds.agg(F.sum("shards"), F.sum(F.col("shards") * (F.col("shards") + 1) / 2)).first()
    n_shards, n_pairs = (max(1, min(int(x or 0), TASKS_MOST)) for x in counted)
    dealt = matched(classes, "kind", kinds).withColumn("shard", F.pmod(F.xxhash64("rep", "mark"), F.col("shards")).cast("int"))
    dealt = dealt.select("label", "length", "shard", "shards", "rep", "mark", "copies", "embedding").repartition(n_shards, "label", "length", "shard")
    graphs = scratch.staged(dealt.groupBy("label", "length", "shard").applyInArrow(_build, _SHARD), "graphs")

    pairs = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    pairs = pairs.withColumns({"low": F.least("shard", "other"), "high": F.greatest("shard", "other")}).drop("other")
    held = ["label", "length", "low", "high"]
    found = pairs.repartition(n_pairs, *held).groupBy(*held).applyInArrow(_linker(cosine), "rep long, mark long, n long, root long")
    found = scratch.staged(found, "links")

    shared = ids.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id")
    shared = ids.join(shared, "vec_id", "left_semi").join(classes.select("mark", "mark2", "rep"), ["mark", "mark2"])
    edges = found.select(F.col("rep").alias("u"), F.col("root").alias("v")).unionByName(shared.select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    linked = connected_components(edges, scratch).withColumnsRenamed({"node": "rep"})
    named = classes.join(found.groupBy("rep", "mark").agg(F.sum("n").alias("links")), ["rep", "mark"], "left").join(linked, "rep", "left")
    named = scratch.staged(named.select("mark", "mark2", F.coalesce("component", "rep").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("copies").alias("n")), "named")
    out = rows.select("vec_id", "mark", "mark2").join(named, ["mark", "mark2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    out = Scratch(vectors.sparkSession).staged(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), "vector-duplicates")
    scratch.clear()
    return out
