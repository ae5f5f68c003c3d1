"""Mix sources to target weights with hierarchical budgets.

The tree is root > domain > language > source.  A node's capacity is the sum
of its children's; a leaf's is its tokens times ``max_epochs``.  The root's
budget is dealt down: at each node the children share the node's budget by
weight, a child that cannot use its share is filled to its capacity, and what
it leaves goes to its siblings by weight (water-filling).  A node only gets
more than its share when its siblings are full, so a shortage is made up among
siblings before it reaches an ancestor.

A leaf then takes a token-prefix of its seeded epochs: whole epochs as often as
they fit, and of the next epoch the longest run of documents, in the order of
md5(id, seed, epoch), whose tokens fit in the rest.  The order is cut into 4096
buckets by the hash's first three digits: bucket totals find the bucket in
which the prefix ends, and only that bucket's rows are sorted, so a source with
a third of all rows never meets in one task.  DataFrame operations only.

Nulls: a null language or source is the leaf "unknown"; a null text has no
tokens and such rows come with any prefix that reaches their place (a leaf
without tokens is taken once).  A node with weight 0 gets nothing.  Rows with
equal ids are ordered by content.  Input columns named domain, n_tokens or copies are
replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .util import bounded_broadcast

TOKEN = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")


def tokens(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def share(nodes: DataFrame, parents: DataFrame | None, path: tuple[str, ...], budget: Column | None = None) -> DataFrame:
    """Water-filling: ``budget`` of each node from its parent's.

    nodes: path columns, ``weight`` and ``cap``; parents: path[:-1] and ``budget`` (None: the root).
    Children are filled in the order of cap / weight; child i is full if its cap is at most its weight
    times the level that the budget left by the fuller ones gives to the rest.
    """
    up = list(path[:-1])
    rows = nodes.join(parents.withColumnRenamed("budget", "given"), up) if parents is not None else nodes.withColumn("given", budget)
    key = [F.col(c) for c in up] or [F.lit(0)]
    order = Window.partitionBy(*key).orderBy(F.col("cap") / F.col("weight"), path[-1])
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    rows = (rows.withColumn("level", (F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
            .withColumn("full", F.col("cap") <= F.col("weight") * F.col("level")))
    # the level at the first child that is not full holds for it and all after it
    first = Window.partitionBy(*key).orderBy(F.col("cap") / F.col("weight"), path[-1]).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    line = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(first)
    return (rows.withColumn("line", line)
            .select(*path, F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("line"))).alias("budget")))


def leaf_budgets(leaves: DataFrame, total: Column, weights: dict[str, dict[str, float]], max_epochs: int) -> DataFrame:
    """(domain, lang, source, budget) from leaf token totals (columns LEVELS and ``tokens``)."""
    def weight(level: str) -> Column:
        known = weights.get(level, {})
        out = F.lit(float(known.get("*", 1.0)))
        for name, w in known.items():
            out = F.when(F.col(level) == name, F.lit(float(w))).otherwise(out)
        return out

    parents = None
    leaves = leaves.where(F.greatest(F.lit(0.0), F.least(*(weight(x) for x in LEVELS))) > 0)     # weight 0: none is taken
    for depth in range(1, len(LEVELS) + 1):
        path = LEVELS[:depth]
        nodes = (leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).cast("double").alias("cap"))
                 .withColumn("weight", weight(path[-1])))
        parents = share(nodes, parents, path, total)
    return parents


def order_key(id_col: Column, seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", id_col.cast("string"), F.lit(str(seed)), epoch.cast("string")))


def mix(docs: DataFrame, budget_share: float, weights: dict[str, dict[str, float]], domain: Column, seed: int = 1,
        max_epochs: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The chosen documents with ``domain``, ``n_tokens`` and ``copies`` (how often each is taken, at least 1).

    The budget is ``budget_share`` of the corpus' tokens.  ``weights``: for each of LEVELS the weights by
    name, "*" for all others (1 if missing).
    """
    named = {"__domain": F.coalesce(domain, F.lit("unknown")), "__lang": F.coalesce("lang", F.lit("unknown")),
             "__source": F.coalesce("source", F.lit("unknown"))}
    leaf = list(named)
    # ids, leaves and token counts without texts: written once, read by every step below
    slim = cut_lineage(docs.withColumns(named).select(*leaf, F.col(id_col).alias("id"), tokens(text_col).alias("t"), F.xxhash64(text_col).alias("tie")))
    sums = slim.groupBy(*leaf).agg(F.sum("t").alias("tokens"))
    all_tokens = sums.groupBy().agg(F.sum("tokens")).first()[0] or 0
    names = sums.withColumnsRenamed({f"__{x}": x for x in LEVELS})
    budgets = leaf_budgets(names, F.lit(float(all_tokens) * budget_share), weights, max_epochs)
    # whole epochs, and the tokens left for the next one
    plan = (names.join(budgets, list(LEVELS))
            .withColumn("budget", F.floor(F.col("budget") + F.lit(1e-6)).cast("long"))
            .withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).cast("int"))
            .withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
            .where((F.col("whole") > 0) | (F.col("rest") > 0) | (F.col("tokens") == 0))
            .select(*(F.col(x).alias(f"__{x}") for x in LEVELS), "whole", "rest", "tokens"))
    keyed = (slim.join(bounded_broadcast(plan), leaf).withColumn("key", order_key(F.col("id"), seed, F.col("whole")))
             .withColumn("bucket", F.substring("key", 1, 3)))
    run = Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)               # at most 4096 rows a leaf
    ends = (keyed.groupBy(*leaf, "rest", "bucket").agg(F.sum("t").alias("t"))
            .withColumn("before", F.coalesce(F.sum("t").over(run), F.lit(0)))
            .where("before + t > rest and before <= rest").groupBy(*leaf).agg(F.min(F.struct("bucket", "before")).alias("e")))
    # only in the bucket in which a leaf's prefix ends are rows ordered; its last row that fits is the leaf's cut
    inside = Window.partitionBy(*leaf).orderBy("key", "tie")          # equal rows are taken or left together
    last = (keyed.join(bounded_broadcast(ends), leaf).where("bucket = e.bucket")
            .withColumn("fits", F.col("e.before") + F.sum("t").over(inside) <= F.col("rest"))
            .groupBy(*leaf).agg(F.max(F.when(F.col("fits"), F.struct("key", "tie"))).alias("cut"), F.first("e.bucket").alias("bucket")))
    cuts = (plan.join(last, leaf, "left")
            .select(*leaf, F.col("whole").alias("__whole"),
                    F.when(F.col("bucket").isNotNull(), F.coalesce("cut", F.struct(F.col("bucket").alias("key"), F.lit(-(1 << 63)).alias("tie")))).alias("__cut"),
                    ((F.col("whole") < max_epochs) & ((F.col("rest") > 0) | (F.col("tokens") == 0))).alias("__more")))
    here = F.struct(order_key(F.col(id_col), seed, F.col("__whole")).alias("key"), F.xxhash64(text_col).alias("tie"))
    taken = F.col("__more") & (F.col("__cut").isNull() | (here <= F.col("__cut")))
    return (docs.withColumns(named).join(bounded_broadcast(cuts), leaf)
            .withColumn("__copies", F.col("__whole") + F.when(taken, 1).otherwise(0)).where("__copies > 0")
            .select(*(c for c in docs.columns if c not in ("domain", "n_tokens", "copies")),
                    F.col("__domain").alias("domain"), tokens(text_col).alias("n_tokens"), F.col("__copies").alias("copies")))
