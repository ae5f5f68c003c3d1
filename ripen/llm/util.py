"""Small helpers of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def bounded_broadcast(small: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Broadcast ``small`` after counting that it has at most ``most`` rows; beyond that Spark joins by shuffle."""
    return F.broadcast(small) if small.limit(most + 1).count() <= most else small


def barrier(df: DataFrame, *names: str) -> DataFrame:
    """Compute these columns once per row: a generator between two projections keeps the optimizer from
    copying their expressions into every later use (and into lambda bodies)."""
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, F.inline(F.array(F.struct(*names))))
