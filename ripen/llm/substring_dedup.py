"""Substring dedup with repeated-phrase automata.

Every word covered by a window of ``window`` consecutive words whose word
sequence also starts earlier in the corpus (smaller id, or same document and
earlier start) is removed.  Plan:

1. *Seeds.*  Each window is represented by the smallest hash of its
   ``SEED``-word phrases (a minimiser), so equal windows share a seed.  One
   shuffle of 8-byte hashes counts them over the whole corpus.
2. *Pre-filter.*  Seeds found twice set bits in a bitmap of fixed size
   (``FILTER_BITS``), the only thing that is broadcast.  It can only let too
   much through: a full bitmap costs more shuffle and changes no result.
   Windows under a frequent seed (a common short line in many contexts) must
   also pass a second bitmap, of window hashes found twice, and are then their
   own seeds, so that no seed gathers an unbounded number of contexts.
3. *Confirm.*  Runs of surviving windows ("segments") are grouped by their
   exact words with map-side combining: a passage found in a third of all
   documents becomes one row with its count and first place.
4. *Automata.*  Segments are sharded by seed.  Each shard confirms the windows
   found twice or more, compiles maximal passages with a common first place
   into one Aho-Corasick automaton over word numbers, and streams its segments
   through it to locate every passage.
5. *Places.*  Located passages are joined back to every place of the segment
   (an equi-join that AQE may split at a hot key), collected per document, and
   the words outside them are kept.

Nulls: a null text has no words; a null id sorts before all others and comes
back null.  Rows with the same id are one document for the ordering, so equal
windows at the same start of two such rows are both first.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import SPACE_WORDS, Words, blocks, gather, signed, sliding_min, spaced, text_buffer

SEED = 8                        # words in a seed phrase
FILTER_BITS = 1 << 27           # 16 MB: the size of each broadcast bitmap, whatever the corpus
FREQUENT = 1000                 # from this count on, a seed's windows are checked and sharded one by one
BLOCK = 1 << 19                 # bytes of text hashed at once
SHARD_SEEDS = 2_000             # seeds for one automaton
_LOWEST = -(1 << 63)


def _bit(x: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = x & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _bitmaps(counted: DataFrame, **which: str) -> list[np.ndarray]:
    """Bitmaps of FILTER_BITS bits of the column ``h``, one for each condition.

    At most FILTER_BITS / 64 rows reach the driver, however large the corpus.
    """
    bit = "shiftleft(1L, cast(h & 63L as int))"
    rows = (counted.groupBy(F.expr(f"shiftright(h & {FILTER_BITS - 1}L, 6)").alias("word"))
            .agg(*(F.expr(f"bit_or(if({cond}, {bit}, 0L))").alias(name) for name, cond in which.items())).toArrow())
    out = []
    for name in which:
        bits = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
        bits[rows["word"].to_numpy()] = rows[name].to_numpy().view(np.uint64)
        out.append(bits)
    return out


class _Windows:
    """Seeds and windows of one block of texts."""

    def __init__(self, buf, offsets, window: int):
        self.words = Words(buf, offsets, SPACE_WORDS)
        self.phrase, _ = self.words.ngrams(SEED)
        _, self.ok = self.words.ngrams(window)
        self.min = sliding_min(self.phrase, window - SEED + 1) if len(self.ok) else self.phrase[:0]
        self.doc = self.words.doc[:len(self.ok)]

    def seeds(self, span: int) -> np.ndarray:
        """The hash at each place that is the minimum of some window."""
        if not self.ok.any():
            return self.phrase[:0]
        m = np.where(self.ok, self.min, np.uint64(0))
        pad = np.zeros(span - 1, dtype=np.uint64)
        most = ~sliding_min(~np.concatenate([pad, m, pad]), span)     # the largest minimum over the windows that hold the place
        return self.phrase[(most == self.phrase) & (most > 0)]


def _scan(docs: DataFrame, schema: str, rows, window: int, *shared) -> DataFrame:
    """Map blocks of whole texts; ``rows(windows, ids, keys, *shared)`` gives the output columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column("text"))
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            for i, j in blocks(np.diff(off), BLOCK):
                w = _Windows(buf[off[i]:off[j]], off[i:j + 1] - off[i], window)
                out = rows(w, ids[i:j], keys[i:j], *(x.value for x in shared))
                if out is not None:
                    yield out

    return docs.mapInArrow(run, schema)


def _count_rows(hashes: np.ndarray):
    h, n = np.unique(hashes, return_counts=True)
    return pa.RecordBatch.from_arrays([signed(h), pa.array(np.minimum(n, FREQUENT))], names=["h", "n"])


def _segments(w: _Windows, window: int, seeds, frequent, twice):
    """Windows that may be repeated, as runs with one seed in one text: (first window, last window, seed) of each."""
    ok = w.ok & _bit(w.min, seeds)
    hot = np.flatnonzero(ok & _bit(w.min, frequent))
    seed = w.min
    alone = np.zeros(len(ok), dtype=bool)
    if len(hot):
        h = w.words.phrase_hash(hot, hot + window)
        ok[hot] = _bit(h, twice)
        alone[hot] = True
        seed = seed.copy()
        seed[hot] = h
    at = np.flatnonzero(ok)
    if not len(at):
        return at, at, seed[:0]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) > 1) | (seed[at[1:]] != seed[at[:-1]]) | (w.doc[at[1:]] != w.doc[at[:-1]]) | alone[at[1:]]
    first = np.flatnonzero(new)
    a, b = at[first], at[np.append(first[1:], len(at)) - 1]
    return a, b, seed[a]


def _automaton(shard: pd.DataFrame, window: int) -> pd.DataFrame:
    """Confirm, compile and stream one shard of distinct segments.

    Columns seed, seg, text, n (places), doc and start (the first place); gives for each
    segment its located passages: lo (word), count (windows), doc and start of the first place.
    """
    import ahocorasick

    number: dict[str, int] = {}
    lines = [[number.setdefault(x, len(number)) for x in t.split(" ")] for t in shard["text"]]
    docs, starts, counts = shard["doc"].tolist(), shard["start"].tolist(), shard["n"].tolist()
    seen: dict[tuple, list] = {}
    for k, line in enumerate(lines):
        for i in range(len(line) - window + 1):
            place = (docs[k], starts[k] + i)
            x = seen.setdefault(tuple(line[i:i + window]), [place, 0])
            x[0] = min(x[0], place)
            x[1] += counts[k]
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for line in lines:
        run = None
        for i in range(len(line) - window + 2):
            x = seen[tuple(line[i:i + window])] if i <= len(line) - window else None
            here = x[0] if x and x[1] > 1 else None
            if run and here != (run[1][0], run[1][1] + i - run[0]):
                size = i - run[0] + window - 1
                machine.add_word(tuple(line[run[0]:run[0] + size]), (size, *run[1]))
                run = None
            if run is None and here is not None:
                run = (i, here)
    seen.clear()
    out = []
    if len(machine):
        machine.make_automaton()
        seeds, segs = shard["seed"].tolist(), shard["seg"].tolist()
        for k, line in enumerate(lines):
            found = {(end + 1 - size, size, doc, start) for end, (size, doc, start) in machine.iter(tuple(line))}
            out += [(seeds[k], segs[k], lo, size, doc, start) for lo, size, doc, start in found]
    return pd.DataFrame(out, columns=["seed", "seg", "lo", "size", "doc", "start"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """(id, key, spans): the word ranges [from, to) to remove, for each document that has any.

    ``key`` is xxhash64 of the text and tells rows with the same id apart.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    span = window - SEED + 1
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("id"),
                       F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))

    counted = (_scan(base, "h long, n long", lambda w, ids, keys: _count_rows(w.seeds(span)), window)
               .groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"))
    seeds, frequent = _bitmaps(counted, seeds="true", frequent=f"n >= {FREQUENT}")
    n_seeds = int(np.bitwise_count(seeds).sum())
    seeds, frequent = sc.broadcast(seeds), sc.broadcast(frequent)

    def hot_windows(w, ids, keys, seeds, frequent):
        hot = w.ok & _bit(w.min, frequent)
        return _count_rows(w.words.ngrams(window)[0][hot]) if hot.any() else None

    twice = sc.broadcast(_bitmaps(_scan(base, "h long, n long", hot_windows, window, seeds, frequent)
                                  .groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"), twice="true")[0])

    def places(with_text: bool):
        def rows(w, ids, keys, seeds, frequent, twice):
            a, b, seed = _segments(w, window, seeds, frequent, twice)
            if not len(a):
                return None
            d = w.doc[a]
            cols = [signed(seed), signed(w.words.phrase_hash(a, b + window)), pa.array(ids[d]), pa.array(a - w.words.first[d])]
            if with_text:
                line, s, e = spaced(w.words, SPACE_WORDS)
                return pa.RecordBatch.from_arrays([*cols, gather(line, s[a], e[b + window - 1])], names=["seed", "seg", "id", "at", "text"])
            return pa.RecordBatch.from_arrays([*cols, pa.array(keys[d])], names=["seed", "seg", "id", "at", "key"])
        return rows

    # (id, at) as one decimal: min() of it stays a hash aggregate with map-side combining
    distinct = (_scan(base, "seed long, seg long, id long, at long, text string", places(True), window, seeds, frequent, twice)
                .withColumn("place", F.expr("cast(id as decimal(20,0)) * 4294967296 + at"))
                .groupBy("seed", "seg", "text").agg(F.count("*").alias("n"), F.min("place").alias("place"))
                .select("seed", "seg", "text", "n",
                        F.expr("cast(floor(place / 4294967296) as long)").alias("doc"),
                        F.expr("cast(pmod(place, 4294967296) as long)").alias("start")))
    shards = max(8, -(-n_seeds // SHARD_SEEDS))
    located = (distinct.groupBy(F.pmod(F.xxhash64("seed"), F.lit(shards)).alias("shard"))
               .applyInPandas(lambda pdf: _automaton(pdf, window), "seed long, seg long, lo long, size long, doc long, start long"))
    occurrences = _scan(base, "seed long, seg long, id long, at long, key long", places(False), window, seeds, frequent, twice)
    return (occurrences.join(located, ["seed", "seg"])
            .where("not (doc = id and start = at + lo)")
            .groupBy("id", "key").agg(F.collect_list(F.expr("struct(at + lo as `from`, at + lo + size as `to`)")).alias("spans")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Each document with its repeated passages removed.

    Returns (id_col, n_words, n_removed, kept_text): the kept words joined by one space.
    """
    spans = repeated_spans(docs, id_col, text_col, window)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("id"),
                       F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"),
                       F.col(id_col).isNull().alias("no_id"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        z = ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([z.compress((t.as_py() or "").encode()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), batch.column("no_id"), packed], names=["id", "key", "no_id", "packed"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        z = ZstdDecompressor()
        for batch in batches:
            total, removed, kept = [], [], []
            for packed, spans in zip(batch.column("packed"), batch.column("spans").to_pylist()):
                words = z.decompress(packed.as_py()).split()
                total.append(len(words))
                if spans:
                    left = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(left, [x["from"] for x in spans], 1)
                    np.add.at(left, [x["to"] for x in spans], -1)
                    left = np.cumsum(left[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(left)]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("no_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=["id", "no_id", "n_words", "n_removed", "kept_text"])

    # whole texts cross the shuffle once, compressed
    packed = base.mapInArrow(pack, "id long, key long, no_id boolean, packed binary")
    return (packed.join(spans, ["id", "key"], "left").select("id", "no_id", "packed", "spans")
            .mapInArrow(keep, "id long, no_id boolean, n_words long, n_removed long, kept_text string")
            .select(F.expr("if(no_id, null, id)").alias(id_col), "n_words", "n_removed", "kept_text"))
