"""Operator 2, language-model scoring by masked pseudo-likelihood.

A window network predicts every word from the two words on either side: position-specific embeddings
of the four neighbours are added, pass through x / (1 + |x|), and a softmax over groups of the vocabulary and one inside
the word's group give its probability as their product. The network's vocabulary is the corpus's FREQUENT most
frequent words, counted over all documents, in groups of falling frequency, and CLASSES hash classes for the rest.
A word of a class has the class's probability times the word's share of the class's occurrences in the corpus, so
every word has its own probability, and those of all words sum to 1. A document's score is the sum of its words'
conditional log-probabilities.

The counts of all words are a table that grows with the corpus. HOT of them, the most frequent, go to every task;
each document's other words leave the tasks as rows (word, times), which join the table by a shuffle. No word
outside the HOT first can be in more than one of HOT occurrences, so none makes a large group.

Training is data-parallel over the whole corpus: each task starts from one seeded network, takes numpy
gradient steps over all its texts, shorter for parameters with large gradients so far, and sends the rows of parameters
that it moved, weighted by the words that moved them, so that tasks without a word don't dilute what others learned of it.
What training gathers follows the number of tasks and so the input; the driver gets one network.
The result depends on how rows are dealt to tasks, as that of any parameter averaging does; the same
layout gives the same network.

Cases: a null or empty text has no words and the score 0; repeated rows get equal scores; a corpus without
words leaves the seeded network; a word that the counts don't hold, in texts outside the corpus, counts as seen once;
an empty table gives no rows; other columns are left aside. Words are told apart by 64-bit hashes. Work is done in
slices, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import textkit as tk
from shelfmark.llm.staging import staged

FREQUENT, CLASSES = 4032, 64
SIZE = FREQUENT + CLASSES
HOT = 65_536
GROUPS = WIDTH = 64  # their product is SIZE
HIDDEN = 32  # divides both, as all parameters are sent in rows of it
OFFSETS = (-2, -1, 1, 2)
BATCH = 8192
RATE = 0.1
SEED = 11
_ONES = np.ones(WIDTH, np.float32)


@dataclass
class Network:
    """Neighbour tables (offset, word or none, hidden), hidden bias, and weights and biases of the two softmaxes.

    A learner has beside them, for each row of a neighbour table and each softmax, the sum of its squared
    gradients, by which its steps shrink, and how many words moved it.
    """

    near: np.ndarray
    bias: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def seeded(seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        none = lambda *shape: np.zeros(shape, np.float32)
        return Network(draw(len(OFFSETS), SIZE + 1, HIDDEN), none(HIDDEN), draw(HIDDEN, GROUPS), none(GROUPS), draw(GROUPS, HIDDEN, WIDTH), none(GROUPS, WIDTH))

    def __post_init__(self) -> None:
        self.near_squares = np.full((len(OFFSETS), SIZE + 1), 1e-8, np.float32)
        self.near_seen = np.zeros((len(OFFSETS), SIZE + 1), np.int64)
        self.squares = np.full((2, GROUPS + 1), 1e-8)
        self.own_seen = np.zeros(GROUPS, np.int64)

    def rows(self) -> np.ndarray:
        """All parameters in rows of HIDDEN."""
        return np.concatenate([getattr(self, x.name).reshape(-1, HIDDEN) for x in fields(self)])

    def row_weights(self) -> np.ndarray:
        """How many words moved each of the rows."""
        own, total = self.own_seen, self.own_seen.sum()
        return np.concatenate([self.near_seen.ravel(), np.full(1 + GROUPS + GROUPS // HIDDEN, total), np.repeat(own, WIDTH), np.repeat(own, WIDTH // HIDDEN)])

    @staticmethod
    def of_rows(rows: np.ndarray) -> Network:
        made = Network.seeded()
        at = 0
        for x in fields(made):
            value = getattr(made, x.name)
            n = value.size // HIDDEN
            setattr(made, x.name, rows[at : at + n].reshape(value.shape).astype(np.float32))
            at += n
        return made

    def _forward(self, words: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray], list[slice]]:
        """Hidden values, exponentials of both softmaxes and their sums, the words' own places in them, and the rows of each group; ``words`` stand in order of groups."""
        hidden = self.near[0].take(around[0], axis=0)
        for p in range(1, len(OFFSETS)):
            hidden += self.near[p].take(around[p], axis=0)
        hidden += self.bias
        hidden /= 1 + np.abs(hidden)
        ends = np.searchsorted(words, np.arange(GROUPS + 1) * WIDTH)
        rows = [slice(ends[g], ends[g + 1]) for g in range(GROUPS) if ends[g] < ends[g + 1]]
        odds = np.empty((2, len(words), WIDTH), np.float32)
        np.matmul(hidden, self.group, out=odds[0])
        odds[0] += self.group_bias
        own = words // WIDTH
        for its in rows:
            np.matmul(hidden[its], self.out[own[its.start]], out=odds[1, its])
            odds[1, its] += self.out_bias[own[its.start]]
        np.clip(odds, -40, 40, out=odds)
        np.exp(odds, out=odds)
        return hidden, odds, odds @ _ONES, (own, words - own * WIDTH), rows

    def log_probability(self, words: np.ndarray, around: np.ndarray) -> np.ndarray:
        order = np.argsort(words.astype(np.uint16), kind="stable")
        _, odds, sums, own, _ = self._forward(words[order], around.take(order, axis=1))
        n = np.arange(len(words))
        out = np.empty(len(words))
        out[order] = np.log(odds[0, n, own[0]].astype(np.float64) / sums[0] * odds[1, n, own[1]] / sums[1])
        return out

    def step(self, words: np.ndarray, around: np.ndarray, rate: float) -> None:
        n = len(words)
        order = np.argsort(words.astype(np.uint16), kind="stable")
        around = around.take(order, axis=1)
        hidden, slope, sums, own, rows = self._forward(words[order], around)
        slope /= sums[:, :, None]
        for k in range(2):
            slope[k, np.arange(n), own[k]] -= 1
        back = slope[0] @ self.group.T
        self._descend(0, GROUPS, self.group, self.group_bias, hidden, slope[0], rate)
        for its in rows:
            g, part = int(own[0][its.start]), slope[1, its]
            back[its] += part @ self.out[g].T
            self._descend(1, g, self.out[g], self.out_bias[g], hidden[its], part, rate)
            self.own_seen[g] += len(part)
        back *= (1 - np.abs(hidden)) ** 2
        move = np.ones(n, np.float32) @ back
        self.squares[0, 0] += float(move @ move) / HIDDEN
        self.bias -= move * np.float32(rate / np.sqrt(self.squares[0, 0]))
        for p in range(len(OFFSETS)):
            at = np.argsort(around[p].astype(np.uint16), kind="stable")
            near = around[p][at]
            first = np.flatnonzero(np.diff(near, prepend=-1))
            its, times = near[first], np.diff(np.append(first, n))
            move = _sums(back, at, first, times)
            self.near_squares[p, its] += np.einsum("ij,ij->i", move, move) / HIDDEN
            self.near[p, its] -= move * (np.float32(rate) / np.sqrt(self.near_squares[p, its]))[:, None]
            self.near_seen[p, its] += times

    def _descend(self, k: int, at: int, weights: np.ndarray, bias: np.ndarray, hidden: np.ndarray, slope: np.ndarray, rate: float) -> None:
        """One step of a softmax's weights and bias, in place, by its gradient over the root of its squares."""
        move, shift = hidden.T @ slope, np.ones(len(slope), np.float32) @ slope
        self.squares[k, at] += (float(np.vdot(move, move)) + float(shift @ shift)) / (move.size + shift.size)
        scale = np.float32(rate / np.sqrt(self.squares[k, at]))
        weights -= move * scale
        bias -= shift * scale


def _sums(values: np.ndarray, order: np.ndarray, first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The sums of runs of ``values`` in ``order``, each from its first on: few long runs one by one, short ones by place in the run."""
    values = values.take(order, axis=0)
    out = values.take(first, axis=0)
    short = np.flatnonzero((times > 1) & (times <= 16))
    for k in range(1, 16):
        short = short[times[short] > k]
        out[short] += values.take(first[short] + k, axis=0)
    ones = np.ones(len(values), values.dtype)
    for i in np.flatnonzero(times > 16):
        np.matmul(ones[: times[i]], values[first[i] : first[i] + times[i]], out=out[i])
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of all texts, by hash, A-Z lower-cased.

    Tasks count each slice's words and send one row a distinct word.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in tk.slices(batch.column("text")):
                found, n = np.unique(tk.word_hashes(s, *tk.word_bounds(s)[:2]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["word", "n"])

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class WordShares:
    """Each class's occurrences in the corpus, and those of its HOT most frequent words; ``frequent`` are the first of them."""

    def __init__(self, counts: DataFrame, hot: int = HOT):
        top = counts.orderBy(F.desc("n"), "word").limit(max(hot, FREQUENT)).toArrow()
        words, n = top.column("word").to_numpy(), top.column("n").to_numpy()
        self.frequent: list[int] = words[:FREQUENT].tolist()
        keys = words.view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.log_n = keys[order], np.log(n[order])
        total = np.zeros(CLASSES, np.int64)
        for x in counts.groupBy(class_of("word").alias("class")).agg(F.sum("n").alias("n")).collect():
            total[x["class"]] = x["n"]
        np.subtract.at(total, (keys[:FREQUENT] % np.uint64(CLASSES)).astype(np.int64), n[:FREQUENT])
        self.log_total = np.log(np.maximum(total, 1))

    def log_share(self, words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of each word's share of its class, and whether its own count is still to be multiplied in."""
        out, later = np.zeros(len(words)), np.zeros(len(words), bool)
        at = np.flatnonzero(words >= FREQUENT)
        out[at] = -self.log_total[words[at] - FREQUENT]
        if len(self.keys) and len(at):
            place = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
            hot = self.keys[place] == keys[at]
            out[at[hot]] += self.log_n[place[hot]]
            at = at[~hot]
        later[at] = True
        return out, later


def class_of(word: str) -> Column:
    """The hash class of a word's unsigned 64-bit hash; CLASSES is a power of 2, so the sign makes no difference."""
    return F.pmod(F.col(word), F.lit(CLASSES)).cast("int")


class Coder:
    """Word numbers of slices: the frequent words' own, others by hash class."""

    def __init__(self, frequent: list[int]):
        keys = np.array(frequent, np.int64).view(np.uint64)
        self.numbers = np.argsort(keys)
        self.keys = keys[self.numbers]

    def __call__(self, s: tk.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, their neighbours' numbers (SIZE for none) by offset, each row's first word, and the words' hashes."""
        starts, ends, first = tk.word_bounds(s)
        keys = tk.word_hashes(s, starts, ends)
        words = (FREQUENT + keys % np.uint64(CLASSES)).astype(np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            same = self.keys[at] == keys
            words[same] = self.numbers[at[same]]
        row = np.repeat(np.arange(len(s)), np.diff(first))
        around = np.full((len(OFFSETS), len(words)), SIZE, np.int64)
        for p, offset in enumerate(OFFSETS):
            to, of = (slice(-offset, None), slice(None, offset)) if offset < 0 else (slice(None, -offset), slice(offset, None))
            if len(words) > abs(offset):
                around[p, to] = np.where(row[to] == row[of], words[of], SIZE)
        return words, around, first, keys


def train(docs: DataFrame, frequent: list[int]) -> Network:
    """The average of the networks that the tasks train on their texts, each row weighted by the words that moved it.

    A task sends the rows that it moved, of at most the network's size; they are summed where their numbers are dealt
    to, and one row a number reaches the driver. A row that no word moved stays as seeded.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, network = Coder(frequent), Network.seeded()
        for batch in batches:
            for s in tk.slices(batch.column("text")):
                words, around, _, _ = code(s)
                for at in range(0, len(words), BATCH):
                    network.step(words[at : at + BATCH], around[:, at : at + BATCH], RATE)
        weights = network.row_weights()
        yield from _parts(np.flatnonzero(weights), weights, network.rows())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            places = batch.column("place").to_numpy()
            if total is None:
                n = len(Network.seeded().rows())
                total, weights = np.zeros((n, HIDDEN)), np.zeros(n, np.int64)
            its = batch.column("weight").to_numpy()
            np.add.at(total, places, _values(batch.column("values"), np.float32) * its[:, None].astype(np.float64))
            np.add.at(weights, places, its)
        if total is not None:
            yield from _parts(np.flatnonzero(weights), weights, total)

    shape = "place long, weight long, values binary"
    sums = docs.select("text").mapInArrow(learn, shape).repartition("place").mapInArrow(add, shape).toArrow()
    rows = Network.seeded().rows().astype(np.float64)
    if len(sums):
        values = _values(sums.column("values"), np.float64)
        rows[sums.column("place").to_numpy()] = values / sums.column("weight").to_numpy()[:, None]
    return Network.of_rows(rows)


def _values(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, HIDDEN)


def _parts(places: np.ndarray, weights: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows at ``places`` with their weights, as bytes, some at a time."""
    for at in range(0, len(places), BATCH):
        part = places[at : at + BATCH]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(weights[part]), pa.array([x.tobytes() for x in values[part]], pa.binary())], names=["place", "weight", "values"]
        )


def score_documents(docs: DataFrame, counts: DataFrame, shares: WordShares, network: Network) -> DataFrame:
    """doc_id, n_words, log_likelihood (summed over the text's words) and per_word of every document."""
    shape = "key long, doc_id long, n_words long, known double, words array<long>, times array<long>"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Coder(shares.frequent)
        for batch in batches:
            n_words, totals, rest, times, ends = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0]
            for s in tk.slices(batch.column("text")):
                words, around, first, keys = code(s)
                share, later = shares.log_share(words, keys)
                each = np.zeros(len(words) + 1)
                for at in range(0, len(words), BATCH):
                    part = words[at : at + BATCH]
                    each[at + 1 : at + 1 + len(part)] = network.log_probability(part, around[:, at : at + BATCH])
                each[1:] += share
                total = np.cumsum(each)
                n_words.append(np.diff(first))
                totals.append(total[first[1:]] - total[first[:-1]])
                # each row's words without a count, with their times in the row
                row, key = np.repeat(np.arange(len(s)), np.diff(first))[later], keys[later].view(np.int64)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                new = np.ones(len(row), bool)
                new[1:] = (np.diff(row) != 0) | (key[1:] != key[:-1])
                begin = np.flatnonzero(new)
                rest.append(key[begin])
                times.append(np.diff(np.append(begin, len(row))))
                ends += (ends[-1] + np.cumsum(np.bincount(row[begin], minlength=len(s)))).tolist()
            ends_array = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends_array, pa.array(np.concatenate(x).astype(np.int64))) for x in (rest, times)]
            columns = [batch.column("key"), batch.column("doc_id"), pa.array(np.concatenate(n_words)), pa.array(np.concatenate(totals)), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "n_words", "known", "words", "times"])

    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(rows.mapInArrow(score, shape), "lm-scores")
    rest = rows.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select("key", F.col("w.words").alias("word"), "w.times")
    rest = rest.join(counts, "word", "left").groupBy("key").agg(F.sum(F.col("times") * F.log(F.coalesce("n", F.lit(1)))).alias("more"))
    scored = rows.select("key", "doc_id", "n_words", "known").join(rest, "key", "left")
    scored = scored.select("doc_id", "n_words", (F.col("known") + F.coalesce("more", F.lit(0.0))).alias("log_likelihood"))
    return scored.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def pseudo_likelihood(docs: DataFrame, hot: int = HOT) -> DataFrame:
    counts = staged(word_counts(docs), "lm-words")
    shares = WordShares(counts, hot)
    return score_documents(docs, counts, shares, train(docs, shares.frequent))
