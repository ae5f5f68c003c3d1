"""Connected components by alternating large-star and small-star steps.

Each step replaces a node's edges by edges to its smallest neighbour, so the
graph turns into stars in a logarithmic number of rounds.  Minima are hash
aggregates with map-side combining, the joins may be split by AQE at a hub, and
each round is cut by a reliable checkpoint.  Only two numbers a round (count and
checksum of the edges) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.  edges: columns a and b."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = cut_lineage(e)
    before = None
    while (now := _state(e)) != before:
        before = now
        if not now[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = cut_lineage(small.select("x.a", "x.b").where("a <> b").distinct())
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
