"""Running (prefix) aggregates per group without one task per group.

A window ``partitionBy(run).orderBy(step)`` sends a whole group to one task,
so one run holding a third of all rows would hold a third of the job.  Here:

1. range-partition by (group, order): a hot group is split across many
   balanced partitions; the result is checkpointed so partition ids stay
   fixed;
2. running values inside each (partition, group) slice -- bounded by the
   partition size;
3. per-(partition, group) totals (a small table: at most partitions x
   groups-spanning rows), prefix-summed over partitions per group and joined
   back as offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut_lineage


def running(df: DataFrame, group: list[str], order: list[str], sums: dict | None = None,
            row_number: str | None = "rn", parts: int | None = None) -> DataFrame:
    """Add inclusive running sums (``sums`` = {out_name: Column}) and a 1-based
    row number per group in ``order`` (which must be unique per group)."""
    spark = df.sparkSession
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums = dict(sums or {})
    vals = {f"__v{i}": e for i, e in enumerate(sums.values())}
    base = df.select("*", *[e.alias(n) for n, e in vals.items()])
    d = cut_lineage(base.repartitionByRange(parts, *group, *order)
                    .withColumn("__pid", F.spark_partition_id()))
    w = (W.partitionBy("__pid", *group).orderBy(*order)
         .rowsBetween(W.unboundedPreceding, W.currentRow))
    local = d.select("*", *[F.sum(n).over(w).alias(n + "_l") for n in vals],
                     F.count(F.lit(1)).over(w).alias("__rn_l"))
    tot = d.groupBy("__pid", *group).agg(*[F.sum(n).alias(n + "_t") for n in vals],
                                         F.count(F.lit(1)).alias("__rn_t"))
    wp = W.partitionBy(*group).orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)
    off = tot.select("__pid", *group,
                     *[F.coalesce(F.sum(n + "_t").over(wp), F.lit(0)).alias(n + "_o") for n in vals],
                     F.coalesce(F.sum("__rn_t").over(wp), F.lit(0)).alias("__rn_o"))
    j = local.join(off, on=["__pid", *group], how="inner")
    outs = [F.col(c) for c in df.columns]
    for (name, _), n in zip(sums.items(), vals):
        outs.append((F.col(n + "_l") + F.col(n + "_o")).alias(name))
    if row_number:
        outs.append((F.col("__rn_l") + F.col("__rn_o")).cast("bigint").alias(row_number))
    return j.select(*outs)
