"""Bitmaps of fixed size over 64-bit hashes, built by a grouping and broadcast as pre-filters.

A bitmap can only let too much through; callers confirm what passes.  Hashes to
be counted cross the shuffle sorted and compressed, one row for each chunk of the
hash space that a task has something for (``HashCounts``); a chunk adds up the
tasks' counts and gives its part of the filter (``counted_filter``): a hash sets and
asks for ``PROBES`` bits of one word, so that a filter with few bits a hash lets little through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

HASH_BITS = 40                  # the highest bits of a hash are counted
PROBES = 3                      # bits of a word that a counted hash sets
FLUSH = 1 << 21                 # hashes that a task holds before it deals them out


def collect_bitmaps(rows: DataFrame, bits: int, total: str = "0L", **which: str) -> list:
    """Bitmaps of ``bits`` bits (a power of two, 64 or more) of the column ``h``, one for each condition, and the sum of ``total``.

    At most bits / 64 rows of one long and a word for each condition reach the driver, however many
    rows there are: 50 MB for two bitmaps of 2**27 bits.
    """
    bit = "shiftleft(1L, cast(h & 63L as int))"
    words = (rows.groupBy(F.expr(f"shiftright(h & {bits - 1}L, 6)").alias("word"))
             .agg(*(F.expr(f"bit_or(if({cond}, {bit}, 0L))").alias(name) for name, cond in which.items()),
                  F.expr(f"sum({total})").alias("_total")).toArrow())
    out: list = []
    for name in which:
        bitmap = np.zeros(bits // 64, dtype=np.uint64)
        bitmap[words["word"].to_numpy()] = words[name].to_numpy().view(np.uint64)
        out.append(bitmap)
    return [*out, int(words["_total"].to_numpy().sum())]


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _word_bits(top: np.ndarray) -> np.ndarray:
    """The bits of its word that a hash sets, by its highest HASH_BITS bits."""
    z = (top + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z ^= z >> np.uint64(32)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    out = np.uint64(1) << (z >> np.uint64(58))
    for k in range(1, PROBES):
        out |= np.uint64(1) << ((z >> np.uint64(58 - 6 * k)) & np.uint64(63))
    return out


def has_high(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter over the highest bits of the hashes lets them through."""
    at = hashes >> np.uint64(64 - (64 * len(words)).bit_length() + 1)
    bits = _word_bits(hashes >> np.uint64(64 - HASH_BITS))
    return words[(at >> np.uint64(6)).astype(np.int64)] & bits == bits


def among(often: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the highest bits of the hashes are among a few, sorted."""
    if not len(often):
        return np.zeros(len(hashes), dtype=bool)
    top = hashes >> np.uint64(64 - HASH_BITS)
    return often[np.minimum(np.searchsorted(often, top), len(often) - 1)] == top


def filter_bits(hashes: int, chunks: int, most: int) -> int:
    """Bits of a filter for so many places of hashes, half of which may be different: 8 bits a hash, ``most`` at most."""
    return max(64 * chunks, min(most, 1 << max(22, (4 * hashes).bit_length())))


def chunks_for(df: DataFrame, bits: int) -> int:
    """Chunks of the hash space: a power of two that grows with the input's partitions, at most one for each word of a bitmap."""
    return min(1 << (4 * df.rdd.getNumPartitions()).bit_length(), bits // 64)


def added(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and the sums of their counts."""
    order = np.argsort(h)
    h, n = h[order], n[order]
    at = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, dtype=np.int64)
    return h[at], np.add.reduceat(n, at) if len(h) else n


class HashCounts:
    """Counts of a task's hashes, dealt out as rows (chunk, data)."""

    def __init__(self, chunks: int, most: int):
        self.shift, self.most = np.uint64(HASH_BITS - chunks.bit_length() + 1), most
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(hashes):
            self.held.append(np.unique(hashes >> np.uint64(64 - HASH_BITS), return_counts=True))
            self.size += len(self.held[-1][0])
            if self.size > FLUSH:
                yield from self.deal()

    def deal(self) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        if not self.held:
            return
        h, n = added(*(np.concatenate(x) for x in zip(*self.held)))
        self.held, self.size = [], 0
        n = np.minimum(n, self.most).astype(np.int32)
        chunk = (h >> self.shift).astype(np.int64)
        at = np.append(np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])), len(h))
        gaps = np.diff(h, prepend=np.uint64(0))
        gaps[at[:-1]] = h[at[:-1]]
        z, data = ZstdCompressor(level=1), []
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            planes = gaps[i:j].view(np.uint8).reshape(-1, 8)[:, :HASH_BITS // 8].T.tobytes()     # byte by byte: the high ones are mostly 0
            data.append(z.compress(planes + n[i:j].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(chunk[at[:-1]]), pa.array(data, pa.binary())], names=["chunk", "data"])


def _counts(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    from zstandard import ZstdDecompressor

    z, held, width = ZstdDecompressor(), [], HASH_BITS // 8
    for blob in blobs:
        raw = z.decompress(blob)
        size = len(raw) // (width + 4)
        gaps = np.zeros((size, 8), dtype=np.uint8)
        gaps[:, :width] = np.frombuffer(raw, dtype=np.uint8, count=size * width).reshape(width, size).T
        held.append((np.cumsum(gaps.reshape(-1).view(np.uint64)), np.frombuffer(raw, dtype=np.int32, offset=size * width).astype(np.int64)))
    return added(*(np.concatenate(x) for x in zip(*held)))


def counted_filter(dealt: DataFrame, chunks: int, bits: int, least: int, often: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A filter of ``bits`` bits over the dealt hashes that were found ``least`` times, the highest bits of those found
    ``often`` (sorted), and how many places the hashes of the filter have.  bits / 8 bytes reach the driver, however many
    hashes there are, and 8 for one that was found often."""
    words = bits // 64 // chunks

    def part(table: pa.Table) -> pa.Table:
        from zstandard import ZstdCompressor

        h, n = _counts(table["data"].to_pylist())
        chunk = table["chunk"][0].as_py()
        on = h[n >= least]
        filled = np.zeros(words, dtype=np.uint64)
        np.bitwise_or.at(filled, ((on >> np.uint64(HASH_BITS - bits.bit_length() + 7)) - np.uint64(chunk * words)).astype(np.int64), _word_bits(on))
        return pa.table({"chunk": [chunk], "total": [int(n[n >= least].sum())], "words": [ZstdCompressor(level=1).compress(filled.tobytes()) if len(on) else b""],
                         "often": [h[n >= often].tobytes()]})

    from zstandard import ZstdDecompressor

    rows = dealt.groupBy("chunk").applyInArrow(part, "chunk long, total long, words binary, often binary").toArrow()
    z, out, found, total = ZstdDecompressor(), np.zeros(bits // 64, dtype=np.uint64), [np.empty(0, dtype=np.uint64)], 0
    for batch in rows.to_batches():
        for r in batch.to_pylist():
            if r["words"]:
                out[r["chunk"] * words:(r["chunk"] + 1) * words] = np.frombuffer(z.decompress(r["words"]), dtype=np.uint64)
            found.append(np.frombuffer(r["often"], dtype=np.uint64))
            total += r["total"]
    return out, np.sort(np.concatenate(found)), total
