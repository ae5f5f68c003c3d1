"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are ``window`` consecutive words (a shorter item is one
window).  A window is the set of its ``SHINGLE``-word shingles with their
places; a document contains it exactly when all of them occur there in a row.
For containment 1 the necessary prefix of a set, ordered by rarity, is its
rarest shingle, so:

1. count the benchmark's shingles over all documents (one narrow pass);
2. order each window's shingles by rarity and keep the rarest; windows whose
   rarest shingle never occurs cannot match and are dropped;
3. a second pass emits the places of those prefix shingles only, with the
   words around them;
4. join places and windows on the prefix shingle, apply the length bound (the
   document has enough words) and the positional bounds (enough words before
   and after the shingle), and verify the words themselves;
5. union the verified word ranges per document.

What goes to the tasks is the hashes of the benchmark's shingles, at most
``MAX_KEYS`` (32 MB) at a time; a larger benchmark is worked off in blocks of
that size, each over all documents.

Nulls: a null text has no words (n_words 0, no hits); a null item id reads
"null".  Rows with equal ids are judged one by one; a repeated item row counts
once.  With an empty benchmark
nothing is hit; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .words import ALNUM_WORDS, Words, blocks, signed, text_buffer

SHINGLE = 3
BLOCK = 1 << 21
MAX_KEYS = 4_000_000


def _word_blocks(batch: pa.RecordBatch):
    buf, off = text_buffer(batch.column("text"))
    for i, j in blocks(np.diff(off), BLOCK):
        yield i, j, Words(buf[off[i]:off[j]], off[i:j + 1] - off[i], ALNUM_WORDS, fold=True)


def _strings(w: Words, a: int, b: int) -> list[str]:
    return [w.buf[s:e].tobytes().decode() for s, e in zip(w.starts[a:b], w.ends[a:b])]


def _member(h: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(h), dtype=bool)
    at = np.searchsorted(keys, h)
    return keys[np.minimum(at, len(keys) - 1)] == h


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, win, size, q, words, shingles): every window of every item."""
    schema = "item string, win int, size int, q int, words array<string>, shingles array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("item").to_pylist(), []
            for i, j, w in _word_blocks(batch):
                grams: dict[int, np.ndarray] = {}
                for k in range(i, j):
                    a, b = (int(x) for x in w.first[k - i:k - i + 2])
                    size = min(window, b - a)
                    q = min(SHINGLE, size)
                    if size and q not in grams:
                        grams[q] = w.ngrams(q)[0].view(np.int64)
                    for n, s in enumerate(range(a, b - size + 1) if size else ()):
                        rows.append((ids[k], n, size, q, _strings(w, s, s + size), grams[q][s:s + size - q + 1].tolist()))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

    names = ["item", "win", "size", "q", "words", "shingles"]
    arrow = pa.schema([("item", pa.string()), ("win", pa.int32()), ("size", pa.int32()), ("q", pa.int32()),
                       ("words", pa.list_(pa.string())), ("shingles", pa.list_(pa.int64()))])
    return (items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).alias("text"))
            .mapInArrow(run, schema))


def _keys(rows: DataFrame, n_blocks: int, block: int) -> dict[int, np.ndarray]:
    """Distinct (q, h) of one block as a sorted array for each q."""
    t = rows.where(F.pmod("h", F.lit(n_blocks)) == block).select("q", "h").distinct().toArrow()
    q, h = t["q"].to_numpy(), t["h"].to_numpy().view(np.uint64)
    return {int(k): np.sort(h[q == k]) for k in np.unique(q)}


def _corpus_counts(docs: DataFrame, keys) -> DataFrame:
    """(q, h, n): how often each benchmark shingle occurs in the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, w in _word_blocks(batch):
                for q, known in keys.value.items():
                    h, ok = w.ngrams(q)
                    h, n = np.unique(h[ok & _member(h, known)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), q, dtype=np.int32)), signed(h), pa.array(n)], names=["q", "h", "n"])

    return docs.mapInArrow(run, "q int, h long, n long").groupBy("q", "h").agg(F.sum("n").alias("n"))


_CAND = pa.struct([("q", pa.int32()), ("h", pa.int64()), ("at", pa.int32()), ("from", pa.int32()), ("words", pa.list_(pa.string()))])


def _places(docs: DataFrame, keys, window: int) -> DataFrame:
    """Each document with its word count and the places of prefix shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], [[] for _ in range(batch.num_rows)]
            for i, j, w in _word_blocks(batch):
                counts.append(np.diff(w.first))
                for q, known in keys.value.items():
                    h, ok = w.ngrams(q)
                    for at in np.flatnonzero(ok & _member(h, known)).tolist():
                        d = int(w.doc[at])
                        a, b = max(int(w.first[d]), at - window + q), min(int(w.first[d + 1]), at + window)
                        start = int(w.first[d])
                        found[i + d].append((q, int(h[at].view(np.int64)), at - start, a - start, _strings(w, a, b)))
            cand = pa.array([[dict(zip(("q", "h", "at", "from", "words"), x)) for x in f] for f in found], pa.list_(_CAND))
            n = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), pa.array(n.astype(np.int64)), cand], names=["rid", "id", "n_words", "cand"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"rid long, id {id_type}, n_words long, cand array<struct<q:int,h:long,at:int,`from`:int,words:array<string>>>")


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = 13) -> DataFrame:
    """One row per document: (id_col, n_words, n_hit, items, spans).

    ``items``: sorted ids (as strings) of items with an occurring window;
    ``spans``: the word ranges [lo, hi) of the occurrences, sorted.
    """
    sc = docs.sparkSession.sparkContext
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # a repeated item row, or texts of one item that share a window at one place, give one window
    windows = (item_windows(items, item_col, item_text_col, window).withColumn("wid", F.struct("item", "win", F.xxhash64("words").alias("x")))
               .dropDuplicates(["wid"]))
    shingles = windows.select("wid", "q", F.posexplode("shingles").alias("off", "h"))
    n_keys = shingles.select("q", "h").distinct().count()
    n_blocks = max(1, -(-n_keys // MAX_KEYS))
    if n_blocks > 1:                # a row's number must be the same in all scans
        base = cut_lineage(base)

    counts = None
    for k in range(n_blocks):
        part = _corpus_counts(base.select("text"), sc.broadcast(_keys(shingles, n_blocks, k)))
        counts = part if counts is None else counts.unionByName(part)
    # a benchmark-sized table, read twice below: cut here so that the documents are counted once
    prefix = cut_lineage(shingles.join(counts, ["q", "h"])
                         .groupBy("wid", "q").agg(F.min(F.struct("n", "h", "off")).alias("r"), F.count("*").alias("occurring"))
                         .join(windows.select("wid", "item", "size", "words"), "wid")
                         .where(F.col("occurring") == F.col("size") - F.col("q") + 1)       # every shingle of the set occurs somewhere
                         .select("item", "size", "words", "q", F.col("r.h").alias("h"), F.col("r.off").alias("off")))

    out = None
    for k in range(n_blocks):
        places = _places(base, sc.broadcast(_keys(prefix, n_blocks, k)), window)
        out = places if out is None else out.unionByName(places)
    # rows without a place get a key of their own, so that no null key gathers them in one task
    cand = (out.select("rid", "id", "n_words", F.explode_outer("cand").alias("c"))
            .select("rid", "id", "n_words", F.coalesce("c.q", F.lit(0)).alias("q"), F.coalesce("c.h", "rid").alias("h"),
                    F.col("c.at").alias("at"), F.col("c.from").alias("from"), F.col("c.words").alias("around")))
    p = prefix.withColumnsRenamed({"q": "pq", "h": "ph"})
    verified = ((cand["q"] == p["pq"]) & (cand["h"] == p["ph"])
                & (cand["n_words"] >= p["size"])                                            # length bound
                & (cand["at"] - p["off"] >= 0) & (cand["at"] - p["off"] + p["size"] <= cand["n_words"])     # positional bounds
                & (F.slice(cand["around"], F.greatest(cand["at"] - p["off"] - cand["from"], F.lit(0)) + 1, p["size"]) == p["words"]))
    lo = F.col("at") - F.col("off")
    hits = (cand.join(p, verified, "left")
            .groupBy("rid", "id").agg(F.max("n_words").alias("n_words"),
                                      F.collect_set("item").alias("items"),
                                      F.collect_set(F.when(F.col("item").isNotNull(), F.struct(lo.alias("lo"), (lo + F.col("size")).alias("hi")))).alias("spans")))
    union = ("aggregate(spans, named_struct('n', 0L, 'end', 0), (acc, s) -> named_struct('n', "
             "acc.n + greatest(0, s.hi - greatest(acc.end, s.lo)), 'end', greatest(acc.end, s.hi)), acc -> acc.n)")
    return (hits.withColumns({"items": F.array_sort("items"), "spans": F.array_sort("spans")})
            .select(F.col("id").alias(id_col), "n_words", F.expr(union).alias("n_hit"), "items", "spans"))


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit", share: int = 20):
    """At least one word in ``share`` lies in a benchmark window."""
    return (F.col(n_hit) > 0) & (F.lit(share) * F.col(n_hit) >= F.col(n_words))
