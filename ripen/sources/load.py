"""A1: table scan with the one missing-value rule (NaN is null)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Float NaN becomes null once, so every operator reasons about null only
    (NaN poisons avg/stddev/percentile and ``NaN > x`` is true in Spark)."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def load(spark: SparkSession, path: str, nan_to_null_: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return nan_to_null(df) if nan_to_null_ else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
