"""Token counts by count-only Viterbi over a unigram vocabulary.

A unigram tokenizer splits a text into the pieces with the largest sum of
scores.  Only the number of pieces is wanted, so dynamic programming carries
the best score and its piece count for each end position, and no back pointers.
An Aho-Corasick automaton over the vocabulary enumerates all pieces that end at
a position, longest first.  Tie rules are the tokenizer's: a later candidate
must be strictly better, candidates of an end come by ascending start; a
character that is no piece gets the smallest score less 10 as an unknown piece,
tried last, and counts one piece for each of its UTF-8 bytes (byte fallback).

Spaces read as U+2581, with one put before the text.  No piece has U+2581 after
another character, so a text falls into independent chunks (U+2581 run plus what
follows) and each distinct chunk is solved once per task; the cache is bounded.
The vocabulary is a file of a public tokenizer, read on the driver; its size
does not depend on the corpus.

Nulls: a null or empty text has 0 tokens; a null id is kept.  Rows are counted
one by one.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 200_000                 # distinct chunks kept in a task
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def load_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """Ordinary pieces with their scores (control, unknown and byte pieces match no text)."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=path)
    return [(p.id_to_piece(i), p.get_score(i)) for i in range(len(p))
            if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]


class PieceCounter:
    """Counts the pieces of chunks and texts."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for piece, score in pieces:
            self.machine.add_word(piece, (len(piece), score))
        if pieces:
            self.machine.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.cache: dict[str, int] = {}

    def chunk(self, text: str) -> int:
        """Pieces of the best split."""
        score, count = [0.0], [0]
        best = pieces = None
        end = 1                                     # the end that is being decided
        single, unknown = self.single, self.unknown
        for last, (size, value) in (self.machine.iter(text) if len(self.machine) else ()):
            while end <= last:                      # its matches are over: settle it
                self._settle(text[end - 1], best, pieces, score, count, single, unknown)
                best, end = None, end + 1
            total = score[end - size] + value       # longest piece first: by ascending start
            if best is None or total > best:
                best, pieces = total, count[end - size] + 1
        while end <= len(text):
            self._settle(text[end - 1], best, pieces, score, count, single, unknown)
            best, end = None, end + 1
        return count[-1]

    @staticmethod
    def _settle(char, best, pieces, score, count, single, unknown) -> None:
        if char not in single and (best is None or score[-1] + unknown > best):
            best, pieces = score[-1] + unknown, count[-1] + len(char.encode())
        score.append(best)
        count.append(pieces)

    def text(self, text: str) -> int:
        if not text:
            return 0
        total, cache = 0, self.cache
        for chunk in _CHUNK.findall(SPACE + text.replace(" ", SPACE)):
            n = cache.get(chunk)
            if n is None:
                if len(cache) >= CACHE:
                    cache.clear()
                n = self.chunk(chunk)
                if len(chunk) <= 64:
                    cache[chunk] = n
            total += n
        return total


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens)."""
    if any(SPACE in p.lstrip(SPACE) for p, _ in pieces):
        raise ValueError("a piece has a space after another character: texts can't be cut at spaces")
    base = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(shared.value)
        for batch in batches:
            n = [counter.text(x.as_py() or "") for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=[id_col, "n_tokens"])

    return base.mapInArrow(run, f"`{id_col}` {base.schema[id_col].dataType.simpleString()}, n_tokens long")
