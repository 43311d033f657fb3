"""Vectorised word hashing over Arrow string columns.

Words are maximal runs of bytes other than space and 0x09-0x0D, as in the pattern
``[^\\x20\\x09-\\x0D]+``; the separators are ASCII, so bytes and code points agree on word ends. A column
is worked on in slices of about a megabyte, so memory follows the slice or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if size > 16 * SLICE_BYTES:
            return tables
        _powers[:] = tables
    return _powers


def powers(n: int) -> list[np.ndarray]:
    """The powers 0 to n - 1 of the base of window values, and of its inverse."""
    return [x[:n] for x in _power_tables(n)]


class Slice:
    """Some consecutive rows of a text column: their bytes and the rows' bounds in them."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.data, self.bounds = first, data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The column's rows in slices of at most ``limit`` bytes, or of one row; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield Slice(at, raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


def word_bounds(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of the slice, and the number of the first word of each row (and of none)."""
    word = ~IS_SPACE[s.data]
    cut = np.zeros(len(word) + 1, bool)
    cut[s.bounds] = True
    before = np.empty(len(word), bool)
    before[:1] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(len(word), bool)
    after[-1:] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, s.bounds)


def word_hashes(s: Slice, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = LOWER) -> np.ndarray:
    """A 64-bit hash of each word, its bytes first put through ``table``.

    Prefix sums of byte values times powers of an odd base give every word's polynomial in one pass; the
    inverse power takes the word's place out of it.
    """
    up, down = _power_tables(len(s.data) + 1)
    sums = np.zeros(len(s.data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[table[s.data]] * up[: len(s.data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The Karp-Rabin value of each run of ``k`` words (place i: words i to i + k - 1), finalised."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= _BASE
        out += words[j : j + n]
    return mix(out + _U(k))


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """The sorted distinct window hashes of one text; with fewer than ``k`` words, the whole sequence as one."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(words, min(k, len(words))))


def long_list(rows: list[np.ndarray]) -> pa.Array:
    """An Arrow list<int64> column of unsigned rows."""
    ends = np.cumsum([0, *(len(x) for x in rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
