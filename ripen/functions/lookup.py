"""Lookup joins with a checked broadcast, and exact dense codes at any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut_lineage

# a lookup side is broadcast only below this many bytes of keys and values (and they were counted)
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 48


def lookup_join(df: DataFrame, table: DataFrame, on: str, how: str = "left",
                max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a (value -> result) table; broadcast only when its counted bytes
    are bounded, else a shuffle join (AQE splits a skewed hot key)."""
    n = table.agg(F.sum(F.octet_length(F.col(on).cast("string")) + ROW_BYTES)).first()[0] or 0
    side = F.broadcast(table) if n <= max_bytes else table
    return df.join(side, on=on, how=how)


def dense_codes(values: DataFrame, col, code: str = "code") -> DataFrame:
    """(value, code) with code = 0-based rank of the value (or values of several
    columns) in ascending order, for any number of distinct values: range-partitioned
    sort, per-partition counts and offsets; no single task sees all values.  The sorted
    distinct set is checkpointed so partition ids stay fixed between the two uses, and
    the offsets (one small row a partition) are joined.  With more columns than ``col``,
    the values are taken as distinct already and the columns ride along."""
    spark = values.sparkSession
    cols = [col] if isinstance(col, str) else list(col)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = values.select(*cols).distinct() if values.columns == cols else values
    d = (d.repartitionByRange(parts, *cols).sortWithinPartitions(*cols)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__mid", F.monotonically_increasing_id()))
    d = cut_lineage(d)
    before = W.partitionBy(F.lit(0)).orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)       # one row a partition
    offsets = (d.groupBy("__pid").agg(F.count(F.lit(1)).alias("__k"), F.min("__mid").alias("__m0"))
               .select("__pid", (F.coalesce(F.sum("__k").over(before), F.lit(0)) - F.col("__m0")).alias("__off")))
    return (d.join(F.broadcast(offsets), "__pid")
            .select(*values.columns, (F.col("__mid") + F.col("__off")).cast("bigint").alias(code)))
