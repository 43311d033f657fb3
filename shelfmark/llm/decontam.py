"""Operator 8, benchmark decontamination by greedy string tiling.

Texts and benchmark items become words without case and punctuation. Windows of MATCH_WORDS words, by their
running Karp-Rabin values, are the seeds: a document and an item that share one are a candidate pair, and the
seed hits on one diagonal, end to end, are the pair's maximal matches. Tiling marks the longest match whose
words are free on both sides, cuts what it overlaps out of the others, and goes on until no match of
MATCH_WORDS words is left. The share of the item's words under tiles is the pair's coverage, whatever order
the tiles stand in, so reordered passages count in full. An item of fewer words is one seed of its length.

A text that repeats itself has many hits with an item that does: n places of a window in one and m in the other make n times m. Hits are
listed only for pairs of HITS_MOST of them at most. The others are tiled by ``tile_long``, which makes the same tiles without a list of matches: it looks for the greatest
length at which the free words of both sides still have a common window, by Karp-Rabin values of all windows of a length, and marks
such windows one by one. Its memory follows the two texts.

The benchmark's seeds go to every task only if they are at most SEEDS_MOST, which is counted first. Beyond
that, tasks get a bitmap of the seeds' values (BITMAP_MOST bits at most), and only the distinct windows of a document that are in it, of lengths that an item has, are
shuffled to meet the seeds. Pairs whose common windows can't reach the coverage asked for go; for the rest, document and item are joined and tiled. Both
ways use the same tiling functions.

Every distinct text of an item_id is searched by itself, and each document's best coverage over them is the
item_id's. Texts with a null item_id are searched likewise and reported together under a null item_id.

Cases: null or empty texts and items, or ones of punctuation only, match nothing; each row of documents is
searched and reported by itself, whatever its doc_id; a null doc_id is reported as null in ``contamination`` and
stays in ``decontaminate``, which takes out all rows of a doc_id found; empty tables give no rows; other columns
are left aside, and ``decontaminate`` hands them through whatever their names. A text of a million equal words is tiled like others. Memory follows the longest text.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import textkit as tk
from shelfmark.llm.staging import staged

MATCH_WORDS = 5
COVERAGE = 0.5
SEEDS_MOST = 2_000_000
HITS_MOST = 1_000_000
BITMAP_LEAST, BITMAP_MOST = 1 << 16, 1 << 28
PAIR = "doc_id long, item_id long, item_words int, covered_words int, n_tiles int, longest_tile int"

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_FILTER_BITS = 20


def word_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of a slice of texts, and the number of each row's first word."""
    for s in tk.slices(column):
        keep = ~_PUNCTUATION[s.data]
        before = np.zeros(len(keep) + 1, np.int64)
        np.cumsum(keep, out=before[1:])
        plain = tk.Slice(s.first, s.data[keep], before[s.bounds])
        starts, ends, first = tk.word_bounds(plain)
        yield tk.word_hashes(plain, starts, ends), first


def tile(doc_at: np.ndarray, item_at: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in the document, place in the item, words) from the places of equal windows.

    ``length`` is the windows' length in words and the least length of a tile.
    """
    order = np.lexsort((item_at, item_at - doc_at))
    d, i = doc_at[order], item_at[order]
    new = np.ones(len(d), bool)
    new[1:] = (np.diff(d) != 1) | (np.diff(i) != 1)
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(d)))
    heap = [(-int(n) - length + 1, int(i[a]), int(d[a])) for a, n in zip(at, runs)]
    heapq.heapify(heap)
    doc_taken: set[int] = set()
    item_taken: set[int] = set()
    tiles = []
    while heap:
        size, i0, d0 = heapq.heappop(heap)
        free, start = [], None
        for k in range(-size):
            if d0 + k in doc_taken or i0 + k in item_taken:
                if start is not None:
                    free.append((start, k - start))
                start = None
            elif start is None:
                start = k
        if start is not None:
            free.append((start, -size - start))
        if free == [(0, -size)]:
            tiles.append((d0, i0, -size))
            doc_taken.update(range(d0, d0 - size))
            item_taken.update(range(i0, i0 - size))
        else:
            for start, n in free:
                if n >= length:
                    heapq.heappush(heap, (-n, i0 + start, d0 + start))
    return tiles


def reach(item_at: np.ndarray, length: int) -> int:
    """How many words of the item the seeds at these places cover: no tiling covers more."""
    at = np.unique(item_at)
    return int(np.minimum(np.diff(at), length).sum()) + length if len(at) else 0


class _Windows:
    """The Karp-Rabin values of all windows of any length over some words, and which words are still free."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.up, self.down = tk.powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(words * self.up[: self.n], out=self.sums[1:])
        self.taken = np.zeros(self.n + 1, np.int64)

    def free(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of the windows of ``length`` words that are free."""
        if length > self.n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        before = np.concatenate([[0], np.cumsum(self.taken[: self.n])])
        at = np.flatnonzero(before[length:] == before[: self.n - length + 1])
        return at, (self.sums[at + length] - self.sums[at]) * self.down[at]


def tile_long(doc: np.ndarray, item: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """The tiles of ``tile`` from the words of both sides, in memory that follows these."""
    x, y, tiles = _Windows(doc), _Windows(item), []
    high = min(len(doc), len(item))

    def common(size: int) -> bool:
        return size >= length and bool(np.isin(y.free(size)[1], x.free(size)[1]).any())

    while common(length):
        low, top = length, high
        while low < top:  # a common window of a length has one of each smaller length in it
            middle = (low + top + 1) // 2
            low, top = (middle, top) if common(middle) else (low, middle - 1)
        high = low
        at, values = x.free(low)
        order = np.argsort(values, kind="stable")
        at, values = at[order], values[order]
        for i, value in zip(*y.free(low)):
            if y.taken[i] or y.taken[i + low - 1]:
                continue
            same = at[np.searchsorted(values, value, "left") : np.searchsorted(values, value, "right")]
            free = np.flatnonzero((x.taken[same] | x.taken[same + low - 1]) == 0)  # tiles so far are at least as long: one inside would touch an end
            if len(free):
                d = int(same[free].min())
                tiles.append((d, int(i), low))
                x.taken[d : d + low] = 1
                y.taken[i : i + low] = 1
        high = low - 1
        if high < length:
            break
    return tiles


class Seeds:
    """All windows of the benchmark's items, by length and value."""

    def __init__(self, items: list[tuple[int, np.ndarray]], length: int = MATCH_WORDS, hits_most: int = HITS_MOST):
        self.items, self.hits_most = dict(items), hits_most
        self.words = {item: len(words) for item, words in items}
        self.tables = {}
        for k in sorted({min(length, len(words)) for _, words in items if len(words)}):
            own = [(item, tk.window_hashes(words, k)) for item, words in items if min(length, len(words)) == k]
            values = np.concatenate([v for _, v in own])
            ids = np.repeat(np.array([item for item, _ in own], np.int64), [len(v) for _, v in own])
            places = np.concatenate([np.arange(len(v)) for _, v in own])
            order = np.argsort(values, kind="stable")
            maybe = np.zeros(1 << _FILTER_BITS, bool)
            maybe[(values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.tables[k] = (values[order], ids[order], places[order], maybe)

    def pairs(self, words: np.ndarray, first: np.ndarray, least: float = 0.0) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(row, item, item_words, covered_words, n_tiles, longest_tile) of each pair with a seed whose seeds cover a share of ``least`` of the item."""
        for k, (values, ids, places, maybe) in self.tables.items():
            windows = tk.window_hashes(words, k)
            near = np.flatnonzero(maybe[(windows >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            low = np.searchsorted(values, windows[near], "left")
            many = np.searchsorted(values, windows[near], "right") - low
            row = np.searchsorted(first, near, "right") - 1
            inside = (many > 0) & (near + k <= first[np.minimum(row + 1, len(first) - 1)])
            near, low, many, row = near[inside], low[inside], many[inside], row[inside]
            for r in np.unique(row):
                own = slice(*np.searchsorted(row, [r, r + 1]))
                doc_at = near[own] - first[r]
                # a window's hits are known by its first seed's place in the table; equal windows share it
                start, which, times = np.unique(low[own], return_inverse=True, return_counts=True)
                n = many[own][np.unique(which, return_index=True)[1]]
                hit = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                window = np.repeat(np.arange(len(start)), n)
                order = np.argsort(ids[hit], kind="stable")
                hit, window = hit[order], window[order]
                items, begin = np.unique(ids[hit], return_index=True)
                by_window = np.argsort(which, kind="stable")
                ends = np.cumsum(times)
                for item, at, to in zip(items.tolist(), begin, np.append(begin[1:], len(hit))):
                    item_at, of = places[hit[at:to]], window[at:to]
                    if reach(item_at, k) < least * self.words[item]:
                        continue
                    if times[of].sum() > self.hits_most:
                        tiles = tile_long(words[first[r] : first[r + 1]], self.items[item], k)
                    else:
                        m = times[of]
                        places_of = np.repeat(ends[of] - times[of] - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(m.sum())
                        tiles = tile(doc_at[by_window[places_of]], np.repeat(item_at, m), k)
                    yield int(r), item, self.words[item], sum(t[2] for t in tiles), len(tiles), max(t[2] for t in tiles)


def _item_windows(length: int):
    """Rows (item, words, k, value, places) of the distinct windows that an item has as seeds."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for words, first in word_rows(batch.column("text")):
                for r in range(len(first) - 1):
                    own, item = words[first[r] : first[r + 1]], batch.column("item")[at].as_py()
                    at += 1
                    k = min(length, len(own))
                    if k:
                        values, n = np.unique(tk.window_hashes(own, k), return_counts=True)
                        columns = [pa.array([item] * len(n), pa.int64()), pa.array([len(own)] * len(n), pa.int32()), pa.array([k] * len(n), pa.int32()), pa.array(values.view(np.int64)), pa.array(n)]
                        yield pa.RecordBatch.from_arrays(columns, names=["item", "item_words", "k", "value", "places"])

    return rows


def _document_windows(lengths: list[int], bitmap):
    """Rows (row, k, value) of the distinct windows of a document that the bitmap of seeds may hold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bitmap.value
        for batch in batches:
            at = 0
            for words, first in word_rows(batch.column("text")):
                for r in range(len(first) - 1):
                    own, key = words[first[r] : first[r + 1]], batch.column("row")[at].as_py()
                    at += 1
                    for k in lengths:
                        values = np.unique(tk.window_hashes(own, k)).view(np.int64)
                        values = values[_in_bitmap(held, values)]
                        if len(values):
                            columns = [pa.array([key] * len(values), pa.int64()), pa.array([k] * len(values), pa.int32()), pa.array(values)]
                            yield pa.RecordBatch.from_arrays(columns, names=["row", "k", "value"])

    return rows


def _in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.int64(len(bits) * 64 - 1)
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def seed_bitmap(seeds: DataFrame) -> np.ndarray:
    """A bitmap of the low bits of the seeds' values, about eight bits a seed; it is put together in the tasks and bounded by BITMAP_MOST bits."""
    size = min(max(BITMAP_LEAST, 8 << max(1, seeds.count()).bit_length()), BITMAP_MOST)
    place = F.col("value").bitwiseAND(F.lit(size - 1))
    one = F.expr(f"shiftleft(1L, int((value & {size - 1}L) & 63))")
    words = seeds.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return bits


def _tile_pairs(length: int, least: float, hits_most: int):
    """Tiles of rows (row, item, text, item_text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                (own, _), (item, _) = (next(word_rows(batch.column(c).slice(i, 1))) for c in ("text", "item_text"))
                seeds = Seeds([(0, item)], length, hits_most)
                out += [(batch.column("row")[i].as_py(), batch.column("item")[i].as_py(), *x[2:]) for x in seeds.pairs(own, np.array([0, len(own)]), least)]
            names = ["row", "item", "item_words", "covered_words", "n_tiles", "longest_tile"]
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], kind) for j, kind in enumerate([pa.int64(), pa.int64(), *[pa.int32()] * 4])], names=names)

    return rows


def _rank(found: tuple[int, int, int, int]) -> tuple[float, int, int, int]:
    """Orders (item_words, covered_words, n_tiles, longest_tile) by coverage, then by the other figures."""
    words, covered, n, longest = found
    return covered / words, covered, longest, n


def overlaps(docs: DataFrame, benchmark: DataFrame, length: int = MATCH_WORDS, seeds_most: int = SEEDS_MOST, least: float = 0.0, hits_most: int = HITS_MOST) -> DataFrame:
    """Every (document row, item_id) pair that shares a seed, with its tiles' coverage of the item_id's best covered text.

    Pairs whose seeds alone show that their coverage stays below ``least`` aren't tiled and are left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= 2 * seeds_most:  # a word and its separator take two bytes at least, so seeds can't be more than half of that
        found = items.orderBy("item_id", "text").toArrow().combine_chunks()
        known: list[tuple[int, np.ndarray]] = []
        ids = found.column("item_id").to_pylist()
        for words, first in word_rows(found.column("text").combine_chunks() if found.num_rows else pa.array([], pa.string())):
            known += [(len(known) + r, words[first[r] : first[r + 1]]) for r in range(len(first) - 1)]
        seeds = Seeds(known, length, hits_most)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, out = 0, []
                for words, first in word_rows(batch.column("text")):
                    best: dict[tuple[int, int | None], tuple[int, int, int, int]] = {}
                    for r, item, *figures in seeds.pairs(words, first, least):
                        pair = r, ids[item]
                        best[pair] = max(best.get(pair, tuple(figures)), tuple(figures), key=_rank)
                    out += [(batch.column("doc_id")[at + r].as_py(), item_id, *figures) for (r, item_id), figures in best.items()]
                    at += len(first) - 1
                names = ["doc_id", "item_id", "item_words", "covered_words", "n_tiles", "longest_tile"]
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], kind) for j, kind in enumerate(kinds)], names=names)

        return docs.mapInArrow(search, PAIR)
    # rows and texts get keys of their own, written once so that a lost task can't deal them anew
    items = staged(items.withColumn("item", F.monotonically_increasing_id()), "decontam-items")
    docs = staged(docs.withColumn("row", F.monotonically_increasing_id()), "decontam-documents")
    seeds = staged(items.select("item", "text").mapInArrow(_item_windows(length), "item long, item_words int, k int, value long, places long"), "decontam-seeds")
    lengths = sorted(x["k"] for x in seeds.select("k").distinct().collect())
    bitmap = docs.sparkSession.sparkContext.broadcast(seed_bitmap(seeds))
    here = docs.select("row", "text").mapInArrow(_document_windows(lengths, bitmap), "row long, k int, value long")
    met = here.join(seeds, ["k", "value"]).groupBy("row", "item", "item_words", "k").agg(F.sum("places").alias("places"))
    near = staged(met.where(F.col("places") * F.col("k") >= F.lit(least) * F.col("item_words")).select("row", "item"), "decontam-pairs")
    texts = near.join(items.select("item", F.col("text").alias("item_text")), "item").join(docs.select("row", "text"), "row").select("row", "item", "text", "item_text")
    pairs = texts.mapInArrow(_tile_pairs(length, least, hits_most), PAIR.replace("doc_id", "row").replace("item_id", "item"))
    pairs = pairs.join(items.select("item", "item_id"), "item")
    share = (F.col("covered_words") / F.col("item_words")).alias("share")
    best = pairs.groupBy("row", "item_id").agg(F.max(F.struct(share, "covered_words", "longest_tile", "n_tiles", "item_words")).alias("best"))
    return best.join(docs.select("row", "doc_id"), "row").select("doc_id", "item_id", *[f"best.{x}" for x in ("item_words", "covered_words", "n_tiles", "longest_tile")])


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The pairs whose coverage reaches the threshold."""
    share = F.col("covered_words") / F.col("item_words")
    return overlaps(docs, benchmark, least=coverage).withColumn("coverage", share).where(F.col("coverage") >= coverage)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold benchmark items."""
    found = contamination(docs, benchmark).select(F.col("doc_id").alias("_found")).distinct()
    at = docs.columns.index("doc_id")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # so that no name can clash
    return plain.join(found, F.col(f"c{at}") == F.col("_found"), "left_anti").toDF(*docs.columns)
