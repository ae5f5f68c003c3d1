"""Repeated rows by fingerprint: only hashes are shuffled, and rows only where hashes repeat.

A row's fingerprint is two 64-bit hashes of all its columns.  One narrow shuffle
counts them.  Rows whose fingerprint occurs once are unlike all others and stay where they
are; the others are compared by their content, so a collision (a null beside a
value hashes like the value beside a null) changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .stats import c

BROADCAST_ROWS = 1 << 20          # fingerprints found twice that are broadcast (after counting them); beyond that both sides are shuffled
_KEYS = ["__h1", "__h2"]


def with_fingerprint(df: DataFrame) -> DataFrame:
    cols = [c(n) for n in df.columns]
    return df.withColumn("__h1", F.xxhash64(*cols)).withColumn("__h2", F.xxhash64(F.lit(1), *cols))


def split_repeated(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose fingerprint is their own, rows that share one), with the fingerprint columns."""
    rows = with_fingerprint(df)
    twice = cut_lineage(rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("__k")).where("__k > 1").select(*_KEYS))
    if twice.count() <= BROADCAST_ROWS:
        twice = F.broadcast(twice)
    return rows.join(twice, _KEYS, "left_anti"), rows.join(twice, _KEYS, "left_semi")
