"""Quality classifier by positive-unlabelled learning.

Trusted positives P and unlabelled web text U train a small network g by the
non-negative unbiased risk

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with the logistic loss; when the bracket is negative on a batch, the step goes up
its gradient instead, as in the method's published algorithm.  No negative
label is used.  The class prior pi is estimated on held-back samples by the best
bin: a first network tells P from U, and pi is the smallest ratio, over score
thresholds, of the shares of U and P above it, with confidence bounds.

Every whole text is turned into ``FEATURES`` numbers (byte classes, word and
phrase repetition) by vectorised code inside the tasks; the narrow feature table
is written once, and the score of a document follows from its features alone.
The fit sees at most ``SAMPLE`` rows of P and of U, the ones with the smallest
hashes of their ids, as feature rows: a documented bound, whatever the corpus.

Nulls: a null text counts as empty and gets a score; a null id is kept, is
never held out and never joins a label.  Rows with equal ids are scored one by one.
Without any positive there is nothing to learn from: every score is 0 and
predicted is null, no verdict.  Any positives are fitted, however few, and U may
consist of them alone.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .words import SPACE_WORDS, Words, blocks, text_buffer

SAMPLE = 20_000                 # rows of P, and of U, in the fit
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
BLOCK = 1 << 21
HIDDEN, STEPS, BATCH, RATE = 16, 800, 512, 0.01


def _classes() -> np.ndarray:
    """Byte classes: upper, lower, digit, space, line end, symbol, bar, mark, other punctuation, non-ASCII lead, continuation."""
    out = np.full(256, 8, dtype=np.int64)
    for k, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\x0b\x0c\r", b"\n",
                               b"#$%&*@^~_=+<>\\{}[]/", b"|", b"!?")):
        out[list(chars)] = k
    out[0x80:0xC0], out[0xC0:] = 10, 9
    return out


_CLASS, N_CLASS = _classes(), 11


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of distinct hashes and the count of its most frequent one."""
    if not len(hashes):
        return np.zeros(n), np.zeros(n)
    # text number and 44 bits of the hash in one key: a plain sort groups them
    key = np.sort(doc.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    runs, d = np.diff(np.append(new, len(key))), (key[new] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n)
    first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
    most[d[first]] = np.maximum.reduceat(runs, first)
    return np.bincount(d, minlength=n).astype(float), most


def features(w: Words, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    text = np.repeat(np.arange(n) * N_CLASS, np.diff(offsets))
    share = np.bincount(text + _CLASS[buf], minlength=n * N_CLASS).reshape(n, N_CLASS) / size[:, None]
    words = np.diff(w.first).astype(float)
    some = np.maximum(words, 1)
    length = (w.ends - w.starts).astype(float)
    mean = np.bincount(w.doc, length, minlength=n) / some
    spread = np.sqrt(np.maximum(np.bincount(w.doc, length ** 2, minlength=n) / some - mean ** 2, 0))
    short = np.bincount(w.doc, length <= 3, minlength=n) / some
    distinct, most = _distinct(w.doc, w.hash, n)
    same = np.zeros(n)
    if len(w) > 1:
        again = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
        same = np.bincount(w.doc[1:], again, minlength=n) / some
    cols = [np.log1p(words) / 10, mean / 10, spread / 10, short, distinct / some, most / some, same]
    for k in (2, 4, 8):
        h, ok = w.ngrams(k)
        d = w.doc[:len(ok)][ok]
        total = np.bincount(d, minlength=n)
        cols.append(np.where(total > 0, _distinct(d, h[ok], n)[0] / np.maximum(total, 1), 1.0))
    for table in (b".,;:!?", b"#$%&*@|<>!"):
        ends = np.isin(buf[w.ends - 1], np.frombuffer(table, dtype=np.uint8)) if len(w) else np.empty(0, dtype=bool)
        cols.append(np.bincount(w.doc, ends, minlength=n) / some)
    capital = (_CLASS[buf[w.starts]] == 0) if len(w) else np.empty(0, dtype=bool)
    cols.append(np.bincount(w.doc, capital, minlength=n) / some)
    return np.column_stack([share, *cols]).astype(np.float32)


FEATURES = N_CLASS + 13


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """(id, x), with ``keyed`` also key, the text's XXH64: an array of FEATURES floats per document."""
    kept = ["id", "key"] if keyed else ["id"]
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key")).select(*kept, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column("text"))
            out = [np.empty((0, FEATURES), dtype=np.float32)]
            for i, j in blocks(np.diff(off), BLOCK):
                b, o = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                out.append(features(Words(b, o, SPACE_WORDS), b, o))
            x = np.concatenate(out)
            at = pa.array(np.arange(0, x.size + 1, FEATURES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.ListArray.from_arrays(at, pa.array(x.reshape(-1)))], names=[*kept, "x"])

    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, {'key long, ' if keyed else ''}x array<float>")


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


class Net:
    """One hidden layer; plain numpy, fitted on the bounded sample."""

    def __init__(self, mean, scale, weights):
        self.mean, self.scale, self.weights = mean, scale, weights

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(p: np.ndarray, u: np.ndarray, gradient, steps: int = STEPS, seed: int = 7) -> Net:
    """Adam on batches; ``gradient(logits of P, logits of U)`` gives the risk's derivative for each logit."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([p, u])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    w = [rng.normal(0, 1 / math.sqrt(p.shape[1]), (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for t in range(1, steps + 1):
        a, b = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
        x = (np.concatenate([a, b]) - mean) / scale
        h = np.tanh(x @ w[0] + w[1])
        z = h @ w[2] + w[3][0]
        g = np.concatenate(gradient(z[:BATCH], z[BATCH:]))
        dh = g[:, None] * w[2] * (1 - h * h)
        grads = [x.T @ dh + 1e-4 * w[0], dh.sum(0), h.T @ g + 1e-4 * w[2], np.array([g.sum()])]
        for k in range(4):
            m[k] = 0.9 * m[k] + 0.1 * grads[k]
            v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
            w[k] = w[k] - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return Net(mean, scale, w)


def estimate_prior(p: np.ndarray, u: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives in U, by the best bin of a P-against-U score on held-back halves."""
    net = _fit(p[::2], u[::2], lambda zp, zu: (-_sigmoid(-zp) / BATCH, _sigmoid(zu) / BATCH), steps=STEPS // 3)
    sp, su = (np.sort(net.logit(x[1::2] if len(x) > 1 else x)) for x in (p, u))
    cuts = np.quantile(sp, np.linspace(0, 0.98, 200))
    above = lambda s: 1 - np.searchsorted(s, cuts) / len(s)
    bound = math.sqrt(math.log(4 / delta) / 2 / len(su)) + math.sqrt(math.log(4 / delta) / 2 / len(sp))
    best = np.argmin((above(su) + bound) / above(sp))
    return float(np.clip((above(su) / above(sp))[best], 0.01, 0.99))


def fit_pu(p: np.ndarray, u: np.ndarray) -> tuple[Net, float]:
    """The network of least non-negative unbiased risk, and the class prior."""
    prior = estimate_prior(p, u)

    def gradient(zp, zu):
        # logistic loss: l(+) = log(1 + e^-z), l(-) = log(1 + e^z)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up, uu = -prior * _sigmoid(zp) / BATCH, _sigmoid(zu) / BATCH             # derivative of the bracket
        if negative < 0:
            return -up, -uu
        return -prior * _sigmoid(-zp) / BATCH + up, uu

    return _fit(p, u, gradient), prior


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """(id_col, held_out, score, predicted) for every document, with ``keyed`` also key, the text's XXH64.

    labels: id_col and quality (1: trusted positive).  Labels of held-out ids are not read.
    """
    table = cut_lineage(feature_table(docs, id_col, text_col, keyed))
    kept = ["key"] if keyed else []
    good = (labels.where((F.col("quality") == 1) & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id")).distinct()
            .withColumn("good", F.lit(True)))
    marked = table.join(good, "id", "left")

    def sample(rows: DataFrame) -> np.ndarray:
        t = rows.select("x", F.xxhash64("id").alias("o"), "id").orderBy("o", "id").limit(SAMPLE).select("x").toArrow()
        x = t["x"].combine_chunks()
        return np.asarray(x.values if isinstance(x, pa.ListArray) else pa.concat_arrays([c.values for c in x.chunks]), dtype=np.float64).reshape(-1, FEATURES)

    p, u = sample(marked.where("good")), sample(marked.where("good is null"))
    if not len(p):
        return table.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), F.lit(0.0).alias("score"),
                            F.lit(None).cast("int").alias("predicted"), *kept)
    # U is web text as it comes: the documents without a label and, by their share, those with one
    n_good, n_rest = (table.join(good, "id", how).count() for how in ("left_semi", "left_anti"))
    rng = np.random.default_rng(11)
    take = min(len(p), int(round(len(u) * n_good / n_rest))) if n_rest else len(p)
    u = np.concatenate([u, p[rng.permutation(len(p))[:take]]])
    net, _ = fit_pu(p, u)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            x = np.asarray(x.flatten(), dtype=np.float64).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(batch.column(c) for c in kept), pa.array(_sigmoid(net.logit(x)))], names=["id", *kept, "score"])

    scored = table.mapInArrow(run, f"id {table.schema['id'].dataType.simpleString()}, {'key long, ' if keyed else ''}score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *kept)
