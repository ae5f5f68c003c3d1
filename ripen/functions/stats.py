"""Aggregate building blocks shared by the profile, EDA and cleaning operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .types import q


def c(name: str) -> Column:
    return F.col(q(name))


FLAT = 1e-13     # a side whose standard deviation is at most this share of its mean is constant up to rounding


def safe_corr(a: Column, b: Column) -> Column:
    """Pairwise-complete Pearson r that is null (not an ANSI error, not NaN)
    when a side is constant; NaN reads as null."""
    a, b = (F.nanvl(x.cast("double"), F.lit(None).cast("double")) for x in (a, b))
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    flat = F.greatest(*(F.when(F.stddev_pop(x) <= F.lit(FLAT) * F.abs(F.avg(x)), 1).otherwise(0) for x in (a, b)))
    return F.when(flat == 0, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def pandas_skew(n: int | None, g1: float | None) -> float | None:
    """Spark's ``skewness`` is the population g1; pandas reports the
    bias-corrected G1.  Zero variance: pandas gives 0."""
    if n is None or n < 3:
        return None
    if g1 is None or (isinstance(g1, float) and math.isnan(g1)):
        return 0.0
    return g1 * math.sqrt(n * (n - 1)) / (n - 2)


def long_form(df: DataFrame, cols: list[str], keep=()) -> DataFrame:
    """(name, value) rows, every value as text; nulls kept (``unpivot``).
    ``keep`` columns ride along unchanged."""
    keep = list(keep)
    renamed = df.select(*[c(k) for k in keep],
                        *[c(x).cast("string").alias(f"v{i}") for i, x in enumerate(cols)])
    long = renamed.unpivot(keep, [f"v{i}" for i in range(len(cols))], "slot", "value")
    names = F.create_map(*[x for i, n in enumerate(cols) for x in (F.lit(f"v{i}"), F.lit(n))])
    return long.select(*[c(k) for k in keep], names[F.col("slot")].alias("name"), "value")


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(name, value, cnt) for every distinct value of every column.  A hot
    value (even a third of all rows) collapses in the map-side partial
    aggregate before the shuffle."""
    return long_form(df, cols).groupBy("name", "value").agg(F.count(F.lit(1)).alias("cnt"))


def top_k_values(counts: DataFrame, k: int, names: list[str] | None = None) -> DataFrame:
    """k most frequent non-null values per name (count desc, value asc).
    ``row_number <= k`` lets Catalyst add a partial WindowGroupLimit before
    the shuffle, so no task ever holds all values of a column."""
    from pyspark.sql import Window as W
    src = counts.filter(F.col("value").isNotNull())
    if names is not None:
        src = src.filter(F.col("name").isin(names))
    w = W.partitionBy("name").orderBy(F.col("cnt").desc(), F.col("value").asc())
    return src.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


_DEALS = ("Repartition", "Rebalance", "Sort", "Join", "Aggregate", "Window", "Deduplicate")
SPLIT_BYTES = 128 << 20       # of a task of a scan, at most (Spark's default)

_HEAVY = ("Aggregate", "Join", "Window", "Union", "Expand", "Generate", "Repartition", "Sort",
          "Deduplicate", "Sample", "Limit", "Tail", "MapPartitions", "FlatMapGroups", "Python")


def plan_nodes(df: DataFrame) -> list[str]:
    """Operator names of the optimized plan (names of operators, never of columns)."""
    out, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        out.append(node.nodeName())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores, if the files are so small that their scan may be a few tasks (a row group is not
    split) and nothing has dealt them yet.  Costly expressions over the rows come after it."""
    spark = df.sparkSession
    if any(name.startswith(_DEALS) for name in plan_nodes(df)):
        return df
    leaves, size = df._jdf.queryExecution().optimizedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        size += int(str(leaves.apply(i).stats().sizeInBytes()))
    cores = spark.sparkContext.defaultParallelism
    if size >= cores * SPLIT_BYTES:
        return df
    return df.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def checkpointed(df: DataFrame) -> bool:
    """The table itself is a reliable checkpoint, with nothing to work out."""
    return plan_nodes(df) == ["LogicalRDD"] and df._jdf.queryExecution().optimizedPlan().rdd().isCheckpointed()


def settled(df: DataFrame) -> DataFrame:
    """The table worked out once (a reliable checkpoint), unless it is one already: for many passes over costly expressions."""
    from ..session import cut_lineage
    return df if plan_nodes(df) == ["LogicalRDD"] else cut_lineage(spread(df))


class fit_view:
    """Context manager for the multi-pass fit of an operator.

    Fits scan their input several times (moments, quantile brackets,
    counts).  A bare parquet scan with projections and filters is cheap to
    re-read (column pruning), so it is used as is; anything heavier (a
    shuffle, a join, a union, a dedup) is narrowed to the needed columns and
    persisted (memory, spilling to disk) for the duration of the fit, then
    released.  Lost cached blocks are recomputed from lineage.
    """

    def __init__(self, df: DataFrame, cols=None):
        self.src = df if cols is None else df.select(*[c(x) if isinstance(x, str) else x for x in cols])
        self.cached = False

    def __enter__(self) -> DataFrame:
        from pyspark import StorageLevel
        try:
            level = self.src.storageLevel
            if level.useMemory or level.useDisk:
                return self.src          # the caller's cache: use it, never release it
        except Exception:  # noqa: BLE001
            pass
        if any(name.startswith(_HEAVY) or "Python" in name or "Limit" in name for name in plan_nodes(self.src)):
            self.src = spread(self.src).persist(StorageLevel.MEMORY_AND_DISK)
            self.cached = True
        return self.src

    def __exit__(self, *exc):
        if self.cached:
            self.src.unpersist()
        return False


CORR_PAIRS = 400   # more pairs than that come from block sums instead of one aggregate each


def fast_corr_row(df: DataFrame, pairs: list, extra=(), prefix: str = "r"):
    """Pairwise-complete correlations (and ``extra`` aggregates), null where a
    side has zero variance.  One pass; with many pairs two more passes, however
    many there are.  Returns one dict of all results."""
    few = len(pairs) <= CORR_PAIRS
    exprs = [*extra, *(safe_corr(c(a), c(b)).alias(f"{prefix}{k}") for k, (a, b) in enumerate(pairs if few else ()))]
    out = df.agg(*exprs).first().asDict() if exprs else {}
    if not few:
        found = gram_corr(df, list(dict.fromkeys(n for pair in pairs for n in pair)))
        out.update({f"{prefix}{k}": found[pair] if pair in found else found[pair[::-1]] for k, pair in enumerate(pairs)})
    return out


def gram_corr(df: DataFrame, cols: list[str]) -> dict:
    """{(a, b): r} for a before b in ``cols``: the means in one pass, then block sums of
    the centred values with null masks in one vectorised pass; a partition gives
    one row per pair, added up by a grouped sum."""
    import numpy as np
    import pyarrow as pa

    n = len(cols)
    row = df.agg(*[F.avg(c(x).cast("double")).alias(f"m{i}") for i, x in enumerate(cols)]).first()
    means = np.array([row[f"m{i}"] or 0.0 for i in range(n)])
    i, j = np.triu_indices(n, 1)

    def sums(batches):
        total = np.zeros((6, len(i)))
        for batch in batches:
            x = np.column_stack([col.to_numpy(zero_copy_only=False).astype(float) for col in batch.columns])
            there = (~np.isnan(x)).astype(float)
            x = np.where(there > 0, x - means, 0.0)
            both, left, squares, cross = there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x
            total += [both[i, j], left[i, j], left[j, i], squares[i, j], squares[j, i], cross[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(i), dtype=np.int32)), *map(pa.array, total)], names=["pair", *names])

    names = ["n", "x", "y", "xx", "yy", "xy"]
    found = (df.select(*[c(x).cast("double").alias(f"c{k}") for k, x in enumerate(cols)])
             .mapInArrow(sums, "pair int, " + ", ".join(f"{x} double" for x in names))
             .groupBy("pair").agg(*[F.sum(x).alias(x) for x in names]).collect())
    out: dict = {(cols[a], cols[b]): None for a, b in zip(i, j)}
    for r in found:
        a, b = int(i[r["pair"]]), int(j[r["pair"]])
        if r["n"]:
            vx, vy = r["xx"] - r["x"] ** 2 / r["n"], r["yy"] - r["y"] ** 2 / r["n"]
            if vx > r["n"] * (FLAT * means[a]) ** 2 and vy > r["n"] * (FLAT * means[b]) ** 2:
                out[(cols[a], cols[b])] = (r["xy"] - r["x"] * r["y"] / r["n"]) / math.sqrt(vx * vy)
    return out


def typed_value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(name, value, cnt) with ``value`` as text, but the grouping done on
    typed long forms (integers, fractions, other) so numbers are never
    formatted as text row by row; only the distinct values are."""
    from pyspark.sql import types as T
    types = {f.name: f.dataType for f in df.schema.fields}
    ints = [n for n in cols if isinstance(types[n], (T.IntegralType, T.BooleanType))]
    fracs = [n for n in cols if isinstance(types[n], (T.FractionalType,))]
    other = [n for n in cols if n not in ints and n not in fracs]
    parts = []
    for group, cast in ((ints, "bigint"), (fracs, "double"), (other, "string")):
        if not group:
            continue
        renamed = df.select(*[c(x).cast(cast).alias(f"v{i}") for i, x in enumerate(group)])
        long = renamed.unpivot([], [f"v{i}" for i in range(len(group))], "slot", "value")
        names = F.create_map(*[x for i, n in enumerate(group) for x in (F.lit(f"v{i}"), F.lit(n))])
        cnt = (long.groupBy(names[F.col("slot")].alias("name"), "value")
               .agg(F.count(F.lit(1)).alias("cnt")))
        parts.append(cnt.select("name", F.col("value").cast("string").alias("value"), "cnt"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
