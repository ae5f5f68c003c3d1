"""SimHash near-duplicates through vantage-point trees in Hamming space.

Fingerprints: the majority bits of XXH64 (seed 42) over all 4-word shingles.
Equal fingerprints are collapsed first.  Pairs within ``DISTANCE`` = 4 bits differ
in at most 2 bits on one half of the fingerprint, so there is one tree for each half:

* *Partition.*  A tree has 4, 8 or 16 levels, more for more distinct fingerprints
  (``tree_levels``); at level i a fingerprint goes to the child that is its Hamming
  distance from the vantage point on the i-th part of the half.  A leaf is the
  vector of distances.
* *Triangle bounds.*  The parts are disjoint, so for x and y at most r bits
  apart on the half, the differences of their distances sum to r or less.  All
  other leaves are pruned.
* *Boundary overlap.*  A fingerprint therefore visits the leaves within r of its
  own (only later ones: each pair meets once).
* *Blocks.*  A leaf with more than ``LEAF_ROWS`` fingerprints or visitors, whatever
  their distribution, is cut into blocks of both: each block of its fingerprints
  meets each block of those who look for neighbours there, in a task of its own.
* *Local trees.*  In a task, full-distance vantage points prune by the same bounds,
  parts that are linked already are skipped, and what is left is compared exactly.

A task returns a spanning forest of the links it finds, never all pairs of a
group of copies; components are joined by distributed connected components.
Levels and blocks change the work, not the result.

Nulls: a null or empty text has fingerprint 0 and is linked like any other; a
null id is kept, and counts last for the smallest id of its component.  Rows with
equal ids are judged one by one, each by its own text.  Other columns are not read.  An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .components import connected_components
from .util import bounded_broadcast
from .words import SPACE_WORDS, Words, blocks, spaced, text_buffer

SHINGLE = 4
DISTANCE = 4
LEAF_ROWS = 1 << 16             # fingerprints, and visitors, that meet in one task
SEED = 42
BLOCK = 1 << 20
_CHUNK = 1 << 17                # shingles whose bits are summed at once
_MATRIX = 1 << 20               # comparisons made at once
_NONE = (1 << 63) - 1           # stands for a missing id: after all others


def _fingerprints(w: Words, n: int, shingle: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    line, s, e = spaced(w, SPACE_WORDS)
    line = line.tobytes()
    size = np.diff(w.first)
    first = np.arange(len(w))
    # a shingle starts at each word with enough words after it, and at the first word of a short text
    left = np.repeat(w.first[1:], size) - first
    short = np.repeat(size, size) < shingle
    at = np.flatnonzero((left >= shingle) | (short & (first == np.repeat(w.first[:-1], size))))
    last = np.minimum(at + shingle, at + left[at]) - 1
    h = np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(s[at].tolist(), e[last].tolist())), dtype=np.uint64, count=len(at))
    doc = w.doc[at]
    ones = np.zeros((n, 64), dtype=np.int64)
    for k in range(0, len(h), _CHUNK):
        bits = np.unpackbits(h[k:k + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        d = doc[k:k + _CHUNK]
        cut = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        ones[d[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    total = np.bincount(doc, minlength=n)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(id, fp), with ``keyed`` also key, the text's XXH64: the fingerprint and the key as signed longs."""
    kept = ["id", "key"] if keyed else ["id"]
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key")).select(*kept, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column("text"))
            out = [_fingerprints(Words(buf[off[i]:off[j]], off[i:j + 1] - off[i], SPACE_WORDS, fold=True), j - i, shingle)
                   for i, j in blocks(np.diff(off), BLOCK)]
            fp = np.concatenate(out) if out else np.empty(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(fp.view(np.int64))], names=[*kept, "fp"])

    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, {'key long, ' if keyed else ''}fp long")


class _Forest:
    """Components of nodes, and the links that joined them."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            high, low = np.maximum(x[apart], y[apart]), np.minimum(x[apart], y[apart])
            high, first = np.unique(high, return_index=True)     # each root hooks to one smaller root
            self.a.append(a[first])
            self.b.append(b[first])
            up = np.arange(len(self.label))
            up[high] = low[first]
            while not np.array_equal(over := up[up], up):
                up = over
            self.label = up[self.label]


def _connect(points: np.ndarray, queries: np.ndarray, nodes: _Forest, shift: int, distance: int) -> None:
    """Join all queries (node ``shift`` + index) and points (node index) within ``distance``, by a vantage-point tree over the points."""
    todo = [(np.arange(len(points)), np.arange(len(queries)))]
    while todo:
        p, q = todo.pop()
        if not len(p) or not len(q):
            continue
        own = nodes.label[p]
        if (own == own[0]).all():                   # links inside one component tell nothing new
            q = q[nodes.label[q + shift] != own[0]]
            if not len(q):
                continue
        split = None
        if len(p) > 256 and len(p) * len(q) > _MATRIX // 4:
            vantage = points[p[len(p) // 2]]
            dp, dq = (np.bitwise_count(x ^ vantage).astype(np.int64) for x in (points[p], queries[q]))
            radius = int(np.median(dp))
            inner = dp <= radius
            if 0 < inner.sum() < len(p):
                split = [(p[inner], q[dq <= radius + distance]), (p[~inner], q[dq > radius - distance])]
        if split:
            todo += split
            continue
        step = max(1, _MATRIX // 8 // len(p))
        part = q[:step]
        a, b = np.nonzero(np.bitwise_count(queries[part, None] ^ points[p][None, :]) <= distance)
        if len(a):
            nodes.join(part[a] + shift, p[b])
        if len(q) > step:
            todo.append((p, q[step:]))


def _leaf(fp: np.ndarray, low: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spanning links (ids, fingerprints of both ends) between a leaf's own fingerprints (home) and those that look for neighbours."""
    points, queries = fp[home], fp[~home]
    nodes = np.concatenate([points, queries])
    ids = np.concatenate([low[home], low[~home]])
    # one node for a fingerprint that is on both sides
    _, first, same = np.unique(nodes, return_index=True, return_inverse=True)
    forest = _Forest(len(nodes))
    forest.label = first[same]
    _connect(points, queries, forest, len(points), distance)
    a, b = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (forest.a, forest.b))
    return ids[a], nodes[a], ids[b], nodes[b]


def tree_levels(distinct: int) -> int:
    """Levels with which the fullest leaf of random fingerprints holds at most ``LEAF_ROWS`` (at most 16; blocks do the rest)."""
    for levels in (4, 8):
        width = 32 // levels
        if distinct * (comb(width, width // 2) / 2 ** width) ** levels <= LEAF_ROWS:
            return levels
    return 16


def _steps(levels: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of two leaves that sum to ``radius`` or less; of each and its opposite only one."""
    out = [()]
    for _ in range(levels):
        out = [(*x, d) for x in out for d in range(-radius, radius + 1) if sum(map(abs, x)) + abs(d) <= radius]
    return [x for x in out if x >= (0,) * levels]


def leaf_rows(distinct: DataFrame, distance: int = DISTANCE, levels: int = 4) -> DataFrame:
    """(leaf, fp, low, home): each fingerprint at home in its leaf, and as one that looks for neighbours in all leaves within its bounds.

    distinct: columns fp and low.
    """
    radius, width = distance // 2, 32 // levels
    vantage = distinct.orderBy(F.xxhash64("fp"), "fp").limit(1).first()
    vantage = vantage["fp"] if vantage else 0
    visits = F.array(*(F.array(*(F.lit(x).cast("tinyint") for x in d)) for d in _steps(levels, radius)))
    trees = []
    for half in (0, 1):
        rings = [F.bit_count(F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.lit(vantage)), half * 32 + i * width).bitwiseAND(F.lit((1 << width) - 1)))
                 for i in range(levels)]
        rows = distinct.select("fp", "low", *(c.alias(f"r{i}") for i, c in enumerate(rings)), F.explode(visits).alias("v"))
        at = [F.col(f"r{i}") + F.col("v")[i] for i in range(levels)]
        leaf, inside = F.lit(half).cast("long"), F.lit(True)
        for x in at:
            leaf = leaf * (width + 1) + x
            inside = inside & x.between(0, width)
        found = rows.where(inside).select(leaf.alias("leaf"), "fp", "low", (F.forall("v", lambda d: d == 0)).alias("own"))
        trees.append(found.select("leaf", "fp", "low", F.explode(F.when(F.col("own"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("home")))
    return trees[0].unionByName(trees[1])


def links(distinct: DataFrame, distance: int = DISTANCE, levels: int | None = None) -> DataFrame:
    """Edges that connect all distinct fingerprints within ``distance``.

    distinct: columns fp and low.  The ends a and b are (low, fp), so a component's smallest node
    has its smallest id and no step gathers a component.
    """
    rows = leaf_rows(distinct, distance, levels or tree_levels(distinct.count()))
    # leaves too large for one task: their blocks of both sides, every pair of which meets once
    big = (rows.groupBy("leaf").agg(F.count_if("home").alias("n"), F.count_if(~F.col("home")).alias("m"))
           .where(f"n > {LEAF_ROWS} or m > {LEAF_ROWS}")
           .select("leaf", F.ceil(F.col("n") / LEAF_ROWS).cast("int").alias("__n"), F.ceil(F.col("m") / LEAF_ROWS).cast("int").alias("__m")))
    salt = F.xxhash64("fp", F.lit(1))
    mine = F.when(F.col("home"), F.pmod(salt, F.coalesce("__n", F.lit(1)))).otherwise(F.pmod(salt, F.coalesce("__m", F.lit(1)))).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("home"), F.coalesce("__m", F.lit(1))).otherwise(F.coalesce("__n", F.lit(1))) - 1)
    blocks_ = (rows.join(bounded_broadcast(big), "leaf", "left")
               .select("leaf", "fp", "low", "home", mine.alias("mine"), F.explode(others).alias("other"))
               .select("leaf", "fp", "low", "home", F.when(F.col("home"), F.col("mine")).otherwise(F.col("other")).alias("i"),
                       F.when(F.col("home"), F.col("other")).otherwise(F.col("mine")).alias("j")))

    def search(table: pa.Table) -> pa.Table:
        fp = table["fp"].to_numpy().view(np.uint64)
        la, a, lb, b = _leaf(fp, table["low"].to_numpy(), table["home"].to_numpy(), distance)
        return pa.table({"la": la, "a": a.view(np.int64), "lb": lb, "b": b.view(np.int64)})

    found = blocks_.groupBy("leaf", "i", "j").applyInArrow(search, "la long, a long, lb long, b long")
    return found.select(*(F.struct(F.col(f"l{x}").alias("low"), F.col(x).alias("fp")).alias(x) for x in "ab"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, levels: int | None = None) -> DataFrame:
    """(id_col, fp, component_id): the fingerprint (signed long) and the smallest id reachable over links."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    smallest = fps.groupBy("fp").agg(F.coalesce(F.min(F.col("id").cast("long")), F.lit(_NONE)).alias("low"))
    parts = (connected_components(links(smallest, distance, levels))
             .select(F.col("node.fp").alias("fp"), F.col("component.low").alias("part")))
    of = (smallest.join(parts, "fp", "left").select("fp", F.coalesce("part", "low").alias("part")))
    return (fps.join(of, "fp")
            .select(F.col("id").alias(id_col), "fp", F.when(F.col("part") < _NONE, F.col("part")).alias("component_id")))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, levels: int | None = None) -> DataFrame:
    """(id_col, key): of each component the row with the smallest id (null last) and, among those, the smallest text hash."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle, keyed=True))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").cast("long").alias("low"), "key", "id")
    smallest = fps.groupBy("fp").agg(F.min(order).alias("first")).withColumn("low", F.coalesce("first.low", F.lit(_NONE)))
    parts = (connected_components(links(smallest.select("fp", "low"), distance, levels))
             .select(F.col("node.fp").alias("fp"), "component"))
    return (smallest.join(parts, "fp", "left").groupBy(F.coalesce("component", F.struct("low", "fp")).alias("component"))
            .agg(F.min("first").alias("first")).select(F.col("first.id").alias(id_col), F.col("first.key").alias("key")))
