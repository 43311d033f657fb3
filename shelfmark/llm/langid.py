"""Operator 7, language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three characters of the lower-cased words, with a mark
at word ends) in order. An n-gram is its characters' code points side by side in one integer, so different n-grams
never share a rank. Language profiles are counted over all training rows: each task sums its
counts per language and sends one row a language and n-gram, and only the top of each profile is collected. A
document's own profile is compared with each language's by the out-of-place distance: the sum of rank
differences, with the profile's length for n-grams the language lacks. The smallest distance wins, ties
going to the first language by code point; the score is 1 less the distance's share of its largest value.

Cases: a text that is null or without a letter is ``und`` with score 0; a null language isn't learned;
repeated rows get equal results; without any training row every text is ``und`` with score 0; an empty table
gives no rows; other columns are left aside. Memory follows the longest text, while counting TALLY_MOST n-grams, and
while predicting the profiles (TOP entries a language).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.quality_rank import fold

TOP = 300
TALLY_MOST = 2_000_000
CHAR_BITS = np.uint64(21)
SPACE = 0x20


@cache
def _kinds() -> np.ndarray:
    """For every code point: 2 a letter, 1 a mark that goes with letters, 0 all else."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], np.uint8)


def ngrams(text: str | None) -> np.ndarray:
    """The text's n-grams with repeats, none that is or spans a word end inside; empty if the text has no letter."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[chars]
    if not (kind == 2).any():
        return np.zeros(0, np.uint64)
    data = np.full(len(chars) + 2, SPACE, np.uint64)
    data[1:-1] = np.where(kind > 0, chars, SPACE)
    gap = data == SPACE
    keep = ~gap
    keep[0] = True
    keep[1:] |= ~gap[:-1]
    data, gap = data[keep], gap[keep]
    pairs = data[:-1] << CHAR_BITS | data[1:]
    triples = pairs[:-1] << CHAR_BITS | data[2:]
    return np.concatenate([data[~gap], pairs, triples[~gap[1:-1]]])


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order, and how often each stands there."""
    codes = np.sort(codes)
    at = np.flatnonzero(np.diff(codes, prepend=codes[:1] ^ np.uint64(1))) if len(codes) else np.zeros(0, np.int64)
    return codes[at], np.diff(np.append(at, len(codes)))


def profile(codes: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams in order, ties by number."""
    found, n = counted(codes)
    if len(found) > top:
        near = n >= np.partition(n, len(n) - top)[len(n) - top]
        found, n = found[near], n[near]
    return found[np.argsort(-n, kind="stable")][:top]


def learn(docs: DataFrame, top: int = TOP) -> dict[str, list[int]]:
    """Each language's profile, from the rows with a language and a fold other than 0."""

    def sums(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            codes, n = counted(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n)], names=["lang", "code", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                codes = ngrams(text.as_py())
                held.setdefault(lang, []).append(codes)
                size += len(codes)
                if size > TALLY_MOST:
                    yield from sums(held)
                    held, size = {}, 0
        yield from sums(held)

    rows = docs.where("lang is not null and text is not null").where(fold() != 0).select("lang", "text")
    found = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).orderBy("lang", "rank").collect()
    out: dict[str, list[int]] = {}
    for x in best:
        out.setdefault(x["lang"], []).append(x["code"])
    return out


class Profiles:
    """The languages' profiles by n-gram: for each one the languages that list it and its ranks there."""

    def __init__(self, profiles: dict[str, list[int]], top: int = TOP):
        self.langs, self.top = sorted(profiles), top
        codes = np.array([c for lang in self.langs for c in profiles[lang]], np.int64).view(np.uint64)
        lang = np.repeat(np.arange(len(self.langs)), [len(profiles[x]) for x in self.langs])
        rank = np.array([r for x in self.langs for r in range(len(profiles[x]))], np.int64)
        order = np.argsort(codes, kind="stable")
        self.lang, self.rank = lang[order], rank[order]
        self.codes, n = counted(codes)
        self.first = np.cumsum(np.append(0, n))

    def distances(self, own: np.ndarray) -> np.ndarray:
        """The out-of-place distance of a document's profile to every language's."""
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        place = np.flatnonzero(self.codes[at] == own)
        begin, n = self.first[at[place]], np.diff(self.first)[at[place]]
        entry = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        nearer = self.top - np.abs(self.rank[entry] - np.repeat(place, n))
        return self.top * len(own) - np.bincount(self.lang[entry], nearer, len(self.langs))


def identify(docs: DataFrame, profiles: dict[str, list[int]], top: int = TOP) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    known = Profiles(profiles, top)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            preds, scores = [], []
            for text in batch.column("text"):
                own = profile(ngrams(text.as_py()), top)
                if not known.langs or not len(own):
                    preds.append("und"), scores.append(0.0)
                    continue
                far = known.distances(own)
                best = int(far.argmin())
                preds.append(known.langs[best]), scores.append(1.0 - float(far[best]) / (top * len(own)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")


def language_digest(docs: DataFrame) -> DataFrame:
    found = identify(docs, learn(docs))
    return found.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")
