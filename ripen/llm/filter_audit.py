"""Filter interaction audit: what every order of five filters removes, by higher-order SQL folds.

1. *Masks.*  Each text is judged once by all filters, whatever the order; its
   failures are one bit mask.  Copies (filter E) are judged against the
   smallest id of their text over the whole table.
2. *Cells.*  Documents are counted by (part, mask): at most 32 cells a part,
   with map-side combining, so no part and no copied text gathers in a task.
3. *Fold.*  Each cell folds over the broadcast array of orders: ``transform``
   over the 120 orders, ``aggregate`` along the five steps of one, carrying
   whether the cell is still alive.  That gives 600 structs weighted by the cell.
4. *Sums.*  The structs are summed element by element over a part's cells, and
   the Shapley total of a filter over the orders of its part.

Only narrow rows (id, digest, mask, part) are shuffled, never texts.

Nulls: a null text is empty; a null part counts as the empty string, together
with empty ones; a null id is neither smaller nor larger than another, so such
a row is never a copy, and has no label.  Rows with the smallest id of their
text all count as its first.  Several labels of an id: good (toxic) if one says
so.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .util import barrier

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50               # percent of the words
MAX_UPPER = 2                   # percent of the code points
SYMBOLS = "[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> Column:
    """Bit mask of the filters A to D that a text fails; a filter's bit is its place in ``FILTERS``."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    judged = F.transform(F.array(words), lambda w: F.when(F.size(w) < MIN_WORDS, 1).otherwise(0)
                         + F.when(100 * F.size(F.array_distinct(w)) < MIN_DISTINCT * F.size(w), 2).otherwise(0))
    upper = F.octet_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return (F.element_at(judged, 1) + F.when(100 * upper > MAX_UPPER * F.length(text).cast("long"), 4).otherwise(0)
            + F.when(text.rlike(SYMBOLS), 8).otherwise(0))


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic), one row per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    rows = barrier(docs.select(F.col(id_col).alias("id"), digest, F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                               text_failures(text).alias("mask")), "mask")
    first = (docs.select(F.col(id_col).alias("id"), digest).where("id is not null")
             .groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True)))
    marks = (labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
             .where("id is not null").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    copy = F.col("id").isNotNull() & F.col("first").isNull()        # the key (digest, id) is never hot, the digest may be
    return (rows.join(first, ["digest", "id"], "left").join(marks, "id", "left")
            .select("part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"),
                    F.coalesce("good", F.lit(False)).cast("long").alias("good"), F.coalesce("toxic", F.lit(False)).cast("long").alias("toxic")))


def interaction_audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, counts, shapley) of every order of ``filters``; masks: part, mask, good and toxic of each document."""
    k = len(filters)
    names = ["".join(p) for p in permutations(filters)]
    orders = "from_json('[" + ",".join("[" + ",".join(str(filters.index(x)) for x in name) + "]" for name in names) + "]', 'array<array<int>>')"
    cells = masks.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    step = {"kept": "if(a.alive and not {fails}, n, 0L)", "removed": "if(a.alive and {fails}, n, 0L)",
            "redundant": "if({fails} and not a.alive, n, 0L)", "unique_fails": "if(mask = shiftleft(1, f), n, 0L)",
            "good_lost": "if(a.alive and {fails}, good, 0L)", "toxic_lost": "if(a.alive and {fails}, toxic, 0L)"}
    fails = "(getbit(mask, f) = 1)"
    made = ", ".join(f"'{c}', {x.format(fails=fails)}" for c, x in step.items())
    none = f"cast(array() as array<struct<{', '.join(c + ': bigint' for c in COUNTS)}>>)"
    fold = (f"flatten(transform({orders}, o -> aggregate(o, named_struct('alive', true, 'steps', {none}), "
            f"(a, f) -> named_struct('alive', a.alive and not {fails}, 'steps', concat(a.steps, array(named_struct({made})))), a -> a.steps)))")
    sums = (cells.select("part", F.posexplode(F.expr(fold)).alias("at", "x"))
            .groupBy("part", "at").agg(*(F.sum(f"x.{c}").alias(c) for c in COUNTS)))
    name = F.get(F.lit(names), F.expr(f"at div {k}").cast("int"))
    rows = sums.select("part", name.alias("filter_order"), (F.col("at") % k + 1).alias("step"), *COUNTS)
    own = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))       # one row an order
    return rows.withColumn("shapley", F.sum("removed").over(own))
