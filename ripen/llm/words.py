"""Vectorised word splitting and n-gram hashing over Arrow text buffers.

A batch of texts is one UTF-8 byte buffer plus offsets.  Words are maximal
runs of "word bytes" inside one text; a 256-entry table says which bytes those
are, and a second table folds letter case.  Every byte of a multi-byte UTF-8
character is >= 0x80, so byte classes express the ASCII-only word patterns
exactly.

Hashes are polynomial over uint64 (wrapping) with a 64-bit finaliser.  They
route and pre-filter; operators confirm exact matches on the words themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
_BASE2 = 0xC2B2AE3D27D4EB4F
_pow: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    space = np.ones(256, dtype=bool)
    space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    alnum = np.zeros(256, dtype=bool)
    alnum[0x30:0x3A] = alnum[0x61:0x7B] = alnum[0x41:0x5B] = alnum[0x80:] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 32
    value = np.array([mix_int(i + 1) for i in range(256)], dtype=np.uint64)
    return space, alnum, lower, value


def mix_int(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element-wise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: word bytes of [^\x20\x09-\x0D]+ ; of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing ; A-Z folding
SPACE_WORDS, ALNUM_WORDS, LOWER, _VALUE = _tables()


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (cached, grown by doubling)."""
    have = _pow.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inv = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inv):
            a = np.full(size, b, dtype=np.uint64)
            a[0] = 1
            out.append(np.cumprod(a, dtype=np.uint64))
        have = _pow[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


class Words:
    """Words of a block of texts.

    ``starts``/``ends``: byte positions in ``buf`` (already case-folded if
    asked); ``first``: for each text the index of its first word, with one
    entry more; ``doc``: the text of each word; ``hash``: 64 bits per word.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, fold: bool = False):
        n = len(buf)
        self.buf = LOWER[buf] if fold else buf
        is_word = word_bytes[buf]
        edge = np.zeros(n + 1, dtype=bool)          # a text begins here
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = is_word[:-1]
        self.starts = np.flatnonzero(is_word & (~before | edge[:n]))
        after = np.empty(n, dtype=bool)
        if n:
            after[-1] = False
            after[:-1] = is_word[1:]
        self.ends = np.flatnonzero(is_word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._total = None
        up, down = _powers(_BASE, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_VALUE[self.buf] * up[:n], out=total[1:])
        self.hash = mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def __len__(self) -> int:
        return len(self.starts)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the n words from i on, whether they lie in one text) for each i <= words - n."""
        m = len(self) - n + 1
        if m <= 0:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=bool)
        at = np.arange(m)
        return self.phrase_hash(at, at + n), self.doc[n - 1:] == self.doc[:m]

    def phrase_hash(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words first..end-1."""
        up, down = _powers(_BASE2, len(self) + 1)
        if self._total is None:
            self._total = np.zeros(len(self) + 1, dtype=np.uint64)
            np.cumsum(self.hash * up[:len(self)], out=self._total[1:])
        return mix((self._total[end] - self._total[first]) * down[first])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for each full window."""
    step, out = 1, x
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, dtype=np.uint8)
    return buf, off - off[0]


def blocks(lengths: np.ndarray, most: int):
    """Consecutive (first, last) row ranges of about ``most`` bytes each; a longer text stands alone."""
    i, n = 0, len(lengths)
    total = np.concatenate([[0], np.cumsum(lengths)])
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = j


def gather(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges of ``buf`` as a string array (ranges may overlap)."""
    size = ends - starts
    off = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=off[1:])
    at = np.repeat(starts - off[:-1], size) + np.arange(off[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(off), pa.py_buffer(buf[at])).cast(pa.string())


def spaced(w: Words, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between neighbours: (bytes, starts, ends)."""
    is_word = word_bytes[w.buf]
    keep = is_word.copy()
    keep[1:] |= is_word[:-1]                       # the one separator after a word
    at = np.cumsum(keep) - 1
    line = np.where(is_word, w.buf, np.uint8(0x20))[keep]
    if not len(w):
        return line, w.starts, w.ends
    return line, at[w.starts], at[w.ends - 1] + 1


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
