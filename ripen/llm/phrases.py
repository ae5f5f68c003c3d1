"""Phrase collocations by Toivonen's mining: propose from a sample, count exactly, expand until closed.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words
``[^\\x20\\x09]+``; a phrase is a run of 1 to ``longest`` words inside one piece.

1. *Proposals.*  A share of the documents (``SAMPLE_SHARE``, by the hash of their id) proposes the
   phrases found there ``SAMPLE_COUNT`` times, level by level.  The proposals, and all that is added
   later, are bitmaps of fixed size over 64-bit hashes, one a pass, the only thing that is broadcast.
2. *Full pass.*  All documents are scanned.  Proposed phrases are counted by their words.  The negative
   border is never enumerated: it is the phrases that occur, are not proposed, and whose two longest
   parts (all but the last word, all but the first) are; single words always belong to it.  Border
   phrases are counted by their hash, which can only count too much.
3. *Expansion.*  A border hash with ``least`` occurrences or more is a failure of the sample.  It joins the
   proposals, and one more full pass counts it by its words, together with the border that it opens; there
   new border phrases may open more border at once, so that a pass follows a chain of failures through
   all lengths.  That ends when no border phrase fails: one pass finds the rest, another counts it by its words.

A task adds up its own counts and deals them by hash to chunks, compressed, one row a chunk; a chunk adds up what all
tasks have for it.  The number of chunks follows the input's partitions and the words of the sample.

Every phrase with ``least`` occurrences is then counted by its words over all documents, whatever the
sample; the sample and false positives of the bitmap change only the work.

Scores: a phrase cut after its first k words scores ``2000000 * a / (l + r)``, rounded down (exact, decimals
of 38 digits); its lowest cut counts.  Phrases inside a longer one with 80 % of their count are dropped.

Nulls: a null text is empty; a null language is ``und``; a null id is one value for the sample.
Rows with equal ids or texts count one by one.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage
from .bitmap import added, chunks_for, collect_bitmaps, has
from .util import bounded_broadcast
from .words import Words, blocks, gather, mix, signed, spaced, text_buffer

LONGEST = 4
LEAST = 30
SAMPLE_SHARE = 4                # one document in so many
SAMPLE_COUNT = 4
BITS = 1 << 26                  # 8 MB a bitmap, one for each pass
SCALE = 2_000_000
INSIDE = 80                     # percent of a phrase's count that a longer one must have
BLOCK = 1 << 19                 # bytes of text at once
FLUSH = 1 << 19                 # phrases (and four times as many hashes) that a task holds before it deals them out
CHUNK_WORDS = 1 << 19           # running words for one chunk, the group in which counts are added up
HASH_BITS = 48                  # of a border phrase's hash, the lowest
_SALTS = 64

_LOW = np.uint64((1 << HASH_BITS) - 1)

#: bytes that end a piece, and the bytes of words
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


class _Phrases:
    """The phrases of a block of texts: for each length the hash at each word, and whether it lies in one piece."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, salts: np.ndarray, longest: int):
        self.words = w = Words(buf, offsets, _WORD, fold=True)
        piece = np.cumsum(_BREAK[buf], dtype=np.int64)[w.starts] + w.doc if len(w) else w.doc
        self.salts = salts.view(np.uint64)
        salt = self.salts[w.doc]
        self.hash, self.whole = [], []
        for k in range(1, longest + 1):
            h, _ = w.ngrams(k)
            self.hash.append(mix(h + salt[:len(h)]))
            self.whole.append(piece[k - 1:] == piece[:len(h)] if len(h) else np.empty(0, dtype=bool))

    def sides(self, chain: list[np.ndarray]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """For each pass and length (new border, newly proposed): where the phrases are that this pass counts by hash and by words."""
        out = []
        reached = [np.zeros(len(h), dtype=bool) for h in self.hash]     # candidates of earlier passes
        counted = [np.zeros(len(h), dtype=bool) for h in self.hash]
        for n, known in enumerate(chain):
            parts, now = None, []
            for k, (h, whole) in enumerate(zip(self.hash, self.whole)):
                may = whole & parts[:len(h)] & parts[1:len(h) + 1] if parts is not None else whole
                proposed = np.zeros(len(h), dtype=bool)
                at = np.flatnonzero(may)
                proposed[at] = has(known, h[at])
                new = may & ~reached[k]
                now.append((new & ~proposed, proposed & ~counted[k]))
                parts = proposed | new if n else proposed
                reached[k], counted[k] = reached[k] | may, counted[k] | proposed
            out.append(now)
        return out


class _Counts:
    """Counts of a task: phrases by language and words, border phrases by hash; dealt out by hash when there are many."""

    def __init__(self, chunks: int):
        self.shift = np.uint64(HASH_BITS - min((chunks - 1).bit_length(), HASH_BITS - 1))
        self.tables: list[pa.Table] = []
        self.hashes: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = self.entries = 0

    def add(self, exact: pa.Table, border: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(exact):
            self.tables.append(_summed(exact))
            self.rows += len(self.tables[-1])
        if len(border):
            self.hashes.append(np.unique(border & _LOW, return_counts=True))
            self.entries += len(self.hashes[-1][0])
        if self.rows > FLUSH or self.entries > 4 * FLUSH:
            yield from self.deal()

    def _cuts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks of sorted hashes and where they begin (one entry more)."""
        chunk = (h >> self.shift).astype(np.int64)
        at = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
        return chunk[at], np.append(at, len(h))

    def deal(self) -> Iterator[pa.RecordBatch]:
        """(chunk, data): what the task has for a chunk, compressed."""
        from zstandard import ZstdCompressor

        z, chunks, data = ZstdCompressor(level=1), [], []
        if self.tables:
            t = _summed(pa.concat_tables(self.tables))
            h = t["h"].to_numpy().view(np.uint64) & _LOW
            order = np.argsort(h)
            t, h = t.take(pa.array(order)), h[order]
            n = t["n"].to_numpy()
            texts = [text_buffer(t[c]) for c in ("lang", "phrase")]
            found, at = self._cuts(h)
            for k, i, j in zip(found.tolist(), at[:-1].tolist(), at[1:].tolist()):
                parts = [np.array([j - i, 0], dtype=np.int64).tobytes(), n[i:j].tobytes()]
                for buf, off in texts:
                    parts += [np.diff(off[i:j + 1]).astype(np.int32).tobytes(), buf[off[i]:off[j]].tobytes()]
                chunks.append(k)
                data.append(z.compress(b"".join(parts)))
        if self.hashes:
            h, n = added(*(np.concatenate(x) for x in zip(*self.hashes)))
            found, at = self._cuts(h)
            for k, i, j in zip(found.tolist(), at[:-1].tolist(), at[1:].tolist()):
                gaps = np.diff(h[i:j], prepend=np.uint64(0))
                chunks.append(k)
                data.append(z.compress(b"".join([np.array([0, j - i], dtype=np.int64).tobytes(), gaps.tobytes(), n[i:j].astype(np.int32).tobytes()])))
        for k in range(0, len(data), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(chunks[k:k + 1000], pa.int64()), pa.array(data[k:k + 1000], pa.binary())], names=["chunk", "data"])
        self.tables, self.hashes, self.rows, self.entries = [], [], 0, 0


def _summed(table: pa.Table) -> pa.Table:
    found = table.group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum"), ("h", "min")])
    return found.select(["lang", "phrase", "n_sum", "h_min"]).rename_columns(["lang", "phrase", "n", "h"])


def _chunk(blobs: list[bytes], least: int) -> pa.Table:
    """(lang, phrase, h, n) of a chunk: phrases and, without words, border hashes with ``least`` occurrences or more in all tasks."""
    from zstandard import ZstdDecompressor

    z, exact, hashes = ZstdDecompressor(), [], []
    for blob in blobs:
        raw = z.decompress(blob)
        rows, entries = np.frombuffer(raw, dtype=np.int64, count=2).tolist()
        at = 16
        if entries:
            h = np.cumsum(np.frombuffer(raw, dtype=np.uint64, count=entries, offset=at))
            hashes.append((h, np.frombuffer(raw, dtype=np.int32, count=entries, offset=at + 8 * entries).astype(np.int64)))
            continue
        cols = {"n": pa.array(np.frombuffer(raw, dtype=np.int64, count=rows, offset=at))}
        at += 8 * rows
        for c in ("lang", "phrase"):
            off = np.concatenate([[0], np.cumsum(np.frombuffer(raw, dtype=np.int32, count=rows, offset=at), dtype=np.int64)])
            at += 4 * rows
            text = pa.LargeStringArray.from_buffers(rows, pa.py_buffer(off), pa.py_buffer(raw[at:at + int(off[-1])]))
            cols[c] = text.cast(pa.string())
            at += int(off[-1])
        exact.append(pa.table(cols | {"h": pa.nulls(rows, pa.int64())}))
    out = []
    if exact:
        t = _summed(pa.concat_tables(exact))
        out.append(t.filter(pc.or_(pc.greater_equal(t["n"], least), pc.equal(t["phrase"], ""))))
    if hashes:
        h, n = added(*(np.concatenate(x) for x in zip(*hashes)))
        out.append(pa.table({"h": signed(h[n >= least]), "n": pa.array(n[n >= least])}))
    cols = [pa.chunked_array([x for t in out for x in (t[f.name].chunks if f.name in t.column_names else [pa.nulls(len(t), f.type)])], f.type) for f in _SCHEMA]
    return pa.table(cols, schema=_SCHEMA)


_SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("h", pa.int64()), ("n", pa.int64())])


def _prepared(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("salt"), F.col(text_col).alias("text"))


def _scan(base: DataFrame, longest: int, rows, chunks: int, least: int) -> DataFrame:
    """(lang, phrase, h, n) of what occurs ``least`` times or more in whole texts; ``rows(phrases, langs)`` gives a block's table of phrases
    to count by words and the hashes of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(chunks)
        for batch in batches:
            buf, off = text_buffer(batch.column("text"))
            salts, langs = batch.column("salt").to_numpy(zero_copy_only=False), batch.column("lang").cast(pa.string())
            for i, j in blocks(np.diff(off), BLOCK):
                found = _Phrases(buf[off[i]:off[j]], off[i:j + 1] - off[i], salts[i:j], longest)
                yield from counts.add(*rows(found, langs.slice(i, j - i)))
        yield from counts.deal()

    return (base.mapInArrow(run, "chunk long, data binary").groupBy("chunk")
            .applyInArrow(lambda t: _chunk(t["data"].to_pylist(), least), "lang string, phrase string, h long, n long"))


def _propose(base: DataFrame, longest: int, count: int, bits: int, chunks: int) -> tuple[np.ndarray, int]:
    """The bitmap of all phrases of the sample with ``count`` occurrences there, level by level, and the words of the sample by the counts of
    its frequent ones."""
    sc = base.sparkSession.sparkContext
    known, words = np.zeros(bits // 64, dtype=np.uint64), 0
    none = pa.table({"lang": [], "phrase": [], "n": [], "h": []})
    for k in range(1, longest + 1):
        shared = sc.broadcast(known)

        def level(found: _Phrases, langs: pa.Array, k=k, shared=shared):
            border, proposed = found.sides([shared.value])[0][k - 1]
            return none, found.hash[k - 1][border | proposed]

        more, total = collect_bitmaps(_scan(base, k, level, chunks, count), bits, total="n", proposed="true")
        known, words = known | more, max(words, total)
    return known, words


def _pass(base: DataFrame, chain: list, longest: int, chunks: int, least: int) -> DataFrame:
    """One full pass, the last of the chain of broadcast bitmaps: exact counts of phrases proposed now and not counted before,
    hashed counts of the border that is new, and in the first pass each language's number of words under the empty phrase."""
    def rows(found: _Phrases, langs: pa.Array):
        w = found.words
        first, size, hashes, border = [], [], [], []
        for k, (new, proposed) in enumerate(found.sides([x.value for x in chain])[-1]):
            at = np.flatnonzero(proposed)
            first.append(at)
            hashes.append(found.hash[k][at])
            size.append(np.full(len(at), k))
            border.append(found.hash[k][new])
        at, more = np.concatenate(first), np.concatenate(size)
        text = pa.array([], pa.string())
        if len(at):
            line, s, e = spaced(w, _WORD)
            text = gather(line, s[at], e[at + more])
        exact = pa.table({"lang": langs.take(pa.array(w.doc[at])), "phrase": text, "n": pa.array(np.ones(len(at), dtype=np.int64)),
                          "h": signed(np.concatenate(hashes))})
        if len(chain) == 1 and len(w):
            n = np.diff(w.first)
            exact = pa.concat_tables([exact, pa.table({"lang": langs, "phrase": pa.array([""] * len(n), pa.string()), "n": pa.array(n, pa.int64()),
                                                       "h": signed(found.salts)})])
        return exact, np.concatenate(border)

    return _scan(base, longest, rows, chunks, least)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of all phrases with ``least`` occurrences or more, (lang, n) with all words of each language)."""
    sc = docs.sparkSession.sparkContext
    sampled = docs.where(F.pmod(F.xxhash64(id_col), F.lit(SAMPLE_SHARE)) == 0)
    few = chunks_for(docs, bits)
    known, words = _propose(_prepared(sampled, text_col, lang_col), longest, SAMPLE_COUNT, bits, few)
    chunks = max(few, words * SAMPLE_SHARE // CHUNK_WORDS)
    base = _prepared(docs, text_col, lang_col)
    passes, chain = [], []
    while not chain or failed.any():
        known = known | failed if chain else known
        chain.append(sc.broadcast(known))
        counted = cut_lineage(_pass(base, list(chain), longest, chunks, least))
        passes.append(counted.where("phrase is not null").select("lang", "phrase", F.col("n").alias("f")))
        failed = collect_bitmaps(counted.where("phrase is null"), bits, failed="true")[0]
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    return every.where("phrase <> ''"), passes[0].where("phrase = '' and f > 0").select("lang", F.col("f").alias("n"))


def collocations(frequent: DataFrame, totals: DataFrame, top: int = 2000, inside: int = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, words, cut) of the first ``top`` phrases of each language."""
    rows = frequent.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("ws")).withColumn("words", F.size("ws"))
    phrases = rows.where("words > 1")
    cuts = phrases.select("lang", "phrase", "a", "ws", "words", F.explode(F.expr("sequence(1, words - 1)")).alias("cut")).select(
        "lang", "phrase", "a", "words", "cut", F.expr("array_join(slice(ws, 1, cut), ' ')").alias("left"),
        F.expr("array_join(slice(ws, cut + 1, words), ' ')").alias("right"))
    of = {x: frequent.select("lang", F.col("phrase").alias(x), F.col("f").alias(x[0])) for x in ("left", "right")}
    score = f"cast(a as decimal(20,0)) * {SCALE} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    scored = (cuts.join(of["left"], ["lang", "left"]).join(of["right"], ["lang", "right"])
              .groupBy("lang", "phrase", "a", "words").agg(F.min(F.struct(F.expr(score).alias("score"), "cut", "l", "r")).alias("x"))
              .select("lang", "phrase", "a", "words", "x.*"))
    # every shorter phrase inside a longer one, with the largest count of those: one row a phrase after map-side combining
    spans = "flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), i -> array_join(slice(ws, i, k), ' '))))"
    around = (phrases.where("words > 2").select("lang", F.col("a").alias("longer"), F.explode(F.expr(f"array_distinct({spans})")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = scored.join(around, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {inside} * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within fixed slices of a language, so that the last window sees _SALTS * top rows at most
    sliced = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(sliced)).where(f"rank <= {top}").drop("rank")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(f"rank <= {top}")
    return (best.join(bounded_broadcast(totals), "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "words", "cut"))
