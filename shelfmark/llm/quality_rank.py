"""Operator 6, a quality classifier by Bradley-Terry pairwise ranking.

Every text becomes a few dense features (shares of character classes, repetition, word and line shapes) and the
shares of its words in HASHED buckets of a word hash, all counted by vectorised passes over its bytes. From labelled rows,
preference pairs (a good text over a bad one) are drawn, and logistic loss on their feature differences gives a linear
score: the Bradley-Terry model. The cut is a score quantile, midway between a low quantile of the good and a high one of the bad
training scores; a logistic curve through it turns scores into 0 to 1, with CUT_VALUE at the cut.

The fit uses a bounded sample, at most SAMPLE_MOST labelled ids by the order of a hash, which are
broadcast and whose features (one row an id) are collected; every document is scored.

Cases: a null or empty text has all-zero shares and a score like others; repeated rows get equal scores; of rows that share a
labelled doc_id the least by features is learned from; if
one of the two labels is missing in the sample, every score is the share of label 1; an empty table gives no
rows; other columns are left aside, and ``keep_good`` hands them through. Memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import textkit as tk

SAMPLE_MOST = 20_000
PAIRS = 4_096
STEPS = 600
HASHED = 256
HASHED_RIDGE = 1e-2
GATHER_ROWS = 256
CUT_VALUE = 0.3
LOW_QUANTILE, HIGH_QUANTILE = 0.02, 0.98
SEED = 7

FEATURES = ("log_words", "word_length", "upper", "digits", "marks", "stops", "exclaims", "pipes", "other_punctuation", "line_breaks", "repeat_next", "distinct", "top_word", "suffix_marks")

_class = np.zeros((256, 8), np.float32)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@^~=+_\\", b".,;:", b"!?", b"|", b"'\"()[]{}/-", b"\n")):
    _class[list(_chars), _k] = 1


def _by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def features(s: tk.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row of dense features for each text of the slice; the word hash bucket of every word, and each text's first word."""
    starts, ends, first = tk.word_bounds(s)
    words = tk.word_hashes(s, starts, ends)
    n_words = np.diff(first).astype(np.float64)
    n_bytes = np.maximum(np.diff(s.bounds), 1).astype(np.float64)
    per_word = np.maximum(n_words, 1)
    out = np.zeros((len(s), len(FEATURES)))
    out[:, 0] = np.log1p(n_words)
    out[:, 1] = _by_row(ends - starts, first) / per_word / 10
    for k in range(8):
        counted = _by_row(_class[s.data, k], s.bounds)
        out[:, 2 + k] = counted / (n_bytes if k in (0, 1) else per_word)
    row = np.repeat(np.arange(len(s)), np.diff(first))
    if len(words):
        again = np.zeros(len(words))
        again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
        out[:, 10] = _by_row(again, first) / per_word
        order = np.lexsort((words, row))
        new = np.ones(len(words), bool)
        new[1:] = (words[order][1:] != words[order][:-1]) | (row[order][1:] != row[order][:-1])
        out[:, 11] = np.bincount(row[order][new], minlength=len(s)) / per_word
        at = np.flatnonzero(new)
        most = np.zeros(len(s))
        np.maximum.at(most, row[order][at], np.diff(np.append(at, len(words))))
        out[:, 12] = most / per_word
        last = s.data[ends - 1]
        out[:, 13] = _by_row(_class[last, 2] + _class[last, 4], first) / per_word
    return out, (words >> np.uint64(56)).astype(np.int64) % HASHED, first


def word_shares(bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The share of each bucket in the words of each text."""
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    counts = np.bincount(row * HASHED + bucket, minlength=len(n) * HASHED).reshape(len(n), HASHED)
    return counts / np.maximum(n, 1)[:, None]


@dataclass(frozen=True)
class RankModel:
    """Weights on standardised features, the dense ones first; ``cut`` and ``scale`` place the 0-to-1 curve."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    scale: float

    def raw(self, x: np.ndarray, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
        k = len(FEATURES)
        dense = standard(x, self.mean[:k], self.spread[:k]) @ self.weights[:k]
        each = self.weights[k:] / self.spread[k:]
        return dense + _by_row(each[bucket], first) / np.maximum(np.diff(first), 1) - each @ self.mean[k:]

    def score(self, x: np.ndarray, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
        z = np.clip(self.scale * (self.raw(x, bucket, first) - self.cut), -30, 30) + np.log(CUT_VALUE / (1 - CUT_VALUE))
        return 1 / (1 + np.exp(-z))


def standard(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / spread, -8, 8)


def fit(x: np.ndarray, label: np.ndarray, seed: int = SEED) -> RankModel:
    """Bradley-Terry by logistic loss on differences of (good, bad) pairs, drawn anew for each of STEPS Adam steps; dense features come first in ``x``."""
    k, width = len(FEATURES), len(FEATURES) + HASHED
    mean, spread = (x.mean(axis=0), x.std(axis=0) + 1e-3) if len(x) else (np.zeros(width), np.ones(width))
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        share = float(label.mean()) if len(label) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        shift = np.log(share / (1 - share)) - np.log(CUT_VALUE / (1 - CUT_VALUE))
        return RankModel(mean, spread, np.zeros(width), -shift, 1.0)
    rng = np.random.default_rng(seed)
    z = (x - mean) / spread
    z[:, :k] = np.clip(z[:, :k], -8, 8)
    ridge = np.repeat([1e-4, HASHED_RIDGE + 50 / len(x)], [k, HASHED])
    w = np.zeros(width)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        difference = z[rng.choice(good, PAIRS)] - z[rng.choice(bad, PAIRS)]
        loss_slope = -1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))
        g = difference.T @ loss_slope / PAIRS + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (1 - t / (STEPS + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    raw = z @ w
    cut = float(np.quantile(raw[good], LOW_QUANTILE) + np.quantile(raw[bad], HIGH_QUANTILE)) / 2
    apart = float(np.median(raw[good]) - np.median(raw[bad]))
    return RankModel(mean, spread, w, cut, 10 / max(apart, 1e-6))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5; a null id counts as 0, held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, sample_most: int = SAMPLE_MOST) -> RankModel:
    """The model of the labelled rows whose fold isn't 0."""
    chosen = labels.where("quality in (0, 1)").where(fold() != 0).groupBy(F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("labelled"), "labelled").limit(sample_most)

    width = len(FEATURES) + HASHED

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in tk.slices(batch.column("text")):
                x, bucket, first = features(s)
                for at in range(0, len(s), GATHER_ROWS):  # short texts make many rows of a slice
                    own = first[at : at + GATHER_ROWS + 1]
                    part = np.hstack([x[at : at + GATHER_ROWS], word_shares(bucket[own[0] : own[-1]], own - own[0])]).astype(np.float32)
                    ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
                    rows = batch.slice(s.first + at, len(part))
                    yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("quality"), pa.ListArray.from_arrays(ends, pa.array(part.ravel()))], names=["doc_id", "quality", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).select("doc_id", "quality", "text")
    found = rows.mapInArrow(gather, "doc_id long, quality int, x array<float>")
    found = found.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("x").alias("x")).toArrow().sort_by("doc_id")
    x = found.column("x").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(found.num_rows, len(FEATURES) + HASHED)
    return fit(x, found.column("quality").to_numpy())


def score_documents(docs: DataFrame, model: RankModel) -> DataFrame:
    """doc_id and score (0 to 1) of every document."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(*features(s)) for s in tk.slices(batch.column("text"))] or [np.zeros(0)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, score double")


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_documents(docs, train(docs, labels))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= CUT_VALUE).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns; rows never leave their task."""
    model = train(docs, labels)
    at = docs.columns.index("text")

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(*features(s)) for s in tk.slices(batch.column(at))] or [np.zeros(0)]
            yield batch.filter(pa.array(np.concatenate(scores) >= CUT_VALUE))

    return docs.mapInArrow(accept, docs.schema)
