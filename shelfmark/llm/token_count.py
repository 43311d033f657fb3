"""Operator 3, token counts of a unigram vocabulary without making the tokens.

A text is split as a Metaspace pre-tokenizer does: a space becomes the word mark, one is put in front, and each mark starts
a new part. Over a part, an Aho-Corasick automaton lists every vocabulary piece that ends at each character,
and dynamic programming keeps the best score and the number of pieces. Ties follow the tokenizer: among
equal scores the path whose last piece starts first stays. A character that no piece of one character
covers may stand alone at the lowest score less 10; at the end a run of such characters is one
unknown piece, or, with byte fallback, one piece a byte.

Parts are alike across texts, so each worker remembers the counts of the parts it has met, within a
bound after which it starts anew. The vocabulary is read once from a path on the driver and goes to the
tasks with the function (its size is the tokenizer's, a few MB).

Cases: a null text has 0 tokens, as has an empty one; repeated rows get equal counts; an empty table gives no
rows; other columns are left aside. Memory follows the longest text; counting a part, of whatever length, takes
memory for as many places as the longest piece has characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMORY_PARTS = 1_000_000
REMEMBERED_LENGTH = 64
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; ``byte_fallback`` if all 256 byte pieces are among them."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool


def read_vocabulary(path: str = DEFAULT_MODEL) -> Vocabulary:
    """The pieces of a sentencepiece model file, control and unknown pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return Vocabulary(tuple((model.id_to_piece(i), model.get_score(i)) for i in ids), sum(model.is_byte(i) for i in range(model.get_piece_size())) == 256)


class PieceCounter:
    """Counts pieces part by part."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max((len(piece) for piece, _ in vocabulary.pieces), default=1)
        self.single = {piece for piece, _ in vocabulary.pieces if len(piece) == 1}
        self.unknown = min((score for _, score in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = vocabulary.byte_fallback
        self.known: dict[str, int] = {}

    def part(self, part: str) -> int:
        """The number of pieces of one part."""
        # a piece reaches back no further than the longest one, so only that many places are kept, in a ring
        size = self.longest + 1
        best: list[float | None] = [None] * size
        count, loose = [0] * size, [False] * size
        best[0] = 0.0
        matches = self.automaton.iter(part)
        ahead = next(matches, None)
        for end in range(1, len(part) + 1):
            here, char = end % size, part[end - 1]
            top: float | None = None
            # longest first, as the automaton follows its failure links
            while ahead is not None and ahead[0] == end - 1:
                length, score = ahead[1]
                before = best[(end - length) % size]
                if before is not None:
                    total = before + score
                    if top is None or total > top:
                        top, count[here], loose[here] = total, count[(end - length) % size] + 1, False
                ahead = next(matches, None)
            last = (end - 1) % size
            if char not in self.single and best[last] is not None:
                total = best[last] + self.unknown
                if top is None or total > top:
                    if self.byte_fallback:
                        more = len(char.encode("utf-8", "surrogatepass"))
                    else:
                        more = 0 if loose[last] else 1
                    top, count[here], loose[here] = total, count[last] + more, True
            best[here] = top
        return count[len(part) % size]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        total, known = 0, self.known
        first, *words = text.split(" ")
        if first:  # a text that begins with a space or a mark gets no other mark
            words.append(first) if first[0] != MARK else words.append(first[1:])
        elif not words:
            return 0
        for word in words:
            n = known.get(word)
            if n is None:
                n = sum(self.part(p) for p in _parts(MARK + word))
                if len(word) <= REMEMBERED_LENGTH:
                    if len(known) >= MEMORY_PARTS:
                        known.clear()
                    known[word] = n
            total += n
        return total


def _parts(text: str) -> list[str]:
    """The text cut before each mark."""
    head, *rest = text.split(MARK)
    return ([head] if head else []) + [MARK + x for x in rest]


_counters: dict[Vocabulary, PieceCounter] = {}


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and n_tokens of every document's whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _counters:
            _counters.clear()
            _counters[vocabulary] = PieceCounter(vocabulary)
        counter = _counters[vocabulary]
        for batch in batches:
            totals = [counter.text(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(totals, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_tokens long")
