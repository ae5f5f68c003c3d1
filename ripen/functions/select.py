"""Exactly the first k rows in md5 order, with ties resolved.

Rows are ordered by (md5 of "<key>:<salt>", key, md5 of the row's values).  The
k-th smallest 52-bit md5 prefix is found by distributed selection; rows below
it are in, rows above it are out, and only when rows share it (copies of one
key, or a collision) are those few ranked by the full order.  Rows that are
equal in every column are interchangeable: exactly as many of them are taken as
are needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .quantile import order_statistics
from .rand import hash52, key_md5
from .stats import c, fit_view

PICK = "__pick"


def mark_first(df: DataFrame, key: str, salt: str, groups: list[tuple[Column | None, int, int]]) -> tuple[DataFrame, Column]:
    """(df, condition): the condition holds for exactly k rows of each group.

    groups: (rows of the group or None for all, k, rows in the group).  Rows of
    no group are not picked.  With ties, df comes back with a helper column
    ``PICK``, so callers select the columns that they return.
    """
    group = F.lit(None).cast("int")
    for i, (cond, _, _) in enumerate(groups):
        group = F.when(F.lit(True) if cond is None else cond, F.lit(i)).otherwise(group)
    cut = [i for i, (_, k, n) in enumerate(groups) if 0 < k < n]
    h = hash52(c(key), salt).cast("double")
    threshold: dict[int, float] = {}
    ties: dict[int, int] = {}
    if cut:
        with fit_view(df, [group.alias("__g"), h.alias("__h")]) as fv:
            at = order_statistics(fv, [(F.col("__h"), F.col("__g") == i, groups[i][1] - 1, groups[i][2], i) for i in cut])
            threshold = dict(zip(cut, at))
            found = fv.agg(*[F.count_if((F.col("__g") == i) & (F.col("__h") <= threshold[i])).alias(f"u{i}") for i in cut]).first()
        ties = {i: found[f"u{i}"] - groups[i][1] for i in cut if found[f"u{i}"] > groups[i][1]}
    hit = F.lit(False)
    for i, (_, k, n) in enumerate(groups):
        if k > 0:
            hit = hit | ((group == i) if k >= n else (group == i) & (h <= threshold[i]))
    hit = F.coalesce(hit, F.lit(False))
    if not ties:
        return df, hit
    edge = F.lit(False)
    for i in ties:
        edge = edge | ((group == i) & (h == threshold[i]))
    edge = F.coalesce(edge, F.lit(False))
    values = F.md5(F.concat_ws("|", *[F.coalesce(c(n).cast("string"), F.lit("")) for n in df.columns]))
    last = W.partitionBy("__g").orderBy(key_md5(c(key), salt), c(key), values)
    spare = F.lit(0)
    for i, n in ties.items():
        spare = F.when(F.col("__g") == i, F.lit(n)).otherwise(spare)
    ranked = (df.filter(edge).withColumn("__g", group)
              .select("*", F.row_number().over(last).alias("__r"), F.count(F.lit(1)).over(W.partitionBy("__g")).alias("__n"))
              .withColumn(PICK, F.col("__r") <= F.col("__n") - spare).drop("__g", "__r", "__n"))
    return df.filter(~edge).withColumn(PICK, hit).unionByName(ranked), F.col(PICK)
