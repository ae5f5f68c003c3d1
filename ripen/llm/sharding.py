"""Contiguous, byte-balanced shards from a global prefix sum.

Rows are put in one global order (id, then content) and cut where the running
byte size passes equal targets.  The prefix sum is built from range totals:
quantile bounds of the id deal the rows into ranges, the ranges' totals (one
row each) are summed into offsets, and only inside a range are rows sorted and
summed.  One shuffle of the rows, none of which depends on the number of
shards.  DataFrame operations only.

An id with more than ``RANGE_ROWS`` rows (the null id too) would fill a range
alone.  Such ids are counted first; each stands in its range as one row with its
totals, and its rows are placed by parts: equal rows are counted together, dealt
in the order of their content hash to parts of about ``RANGE_ROWS``, summed there
and multiplied again, in blocks of ``RANGE_ROWS`` copies.  So no task sorts or
sums more than a part, however many rows share an id or are equal.

A row's shard is ``floor((2 * start + size) * shards / (2 * total))``, the
target interval in which its middle byte lies, so shards are contiguous in the
order and their sizes differ by less than one row from the target.

Nulls: a null id sorts first; a null text has size 0 (plus the fixed bytes per
row) and the CRC of no bytes.  Equal ids are ordered by the hash of their content;
equal rows are interchangeable.  Text ids are dealt by their first bytes.  Input
columns named size, shard or slot are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from .util import barrier, bounded_broadcast

ROW_BYTES = 16
RANGE_ROWS = 50_000             # rows of one range of the prefix sum


def text_size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def text_crc(text: str) -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")))


def _position(df: DataFrame, id_col: str) -> Column:
    """The id as a number that never falls when the id grows."""
    if isinstance(df.schema[id_col].dataType, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(F.col(id_col).cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.col(id_col).cast("double")


def _running(frame: Window) -> list[Column]:
    """Bytes and rows before a row, in the frame's order."""
    upto = frame.rowsBetween(Window.unboundedPreceding, 0)
    return [(F.sum(x).over(upto) - F.col(x)).alias(to) for x, to in (("__bytes", "__before"), ("__rows", "__row"))]


def assign_shards(df: DataFrame, shards: int, size: Column, id_col: str = "doc_id", order: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``size``, ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``order``: columns that break ties between equal ids; they are compared by their hash.
    """
    kept = [c for c in df.columns if c not in ("size", "shard", "slot")]
    own = df.withColumn("__size", size.cast("long")).withColumn("__tie", F.xxhash64(*order) if order else F.lit(0).cast("long"))
    key = _position(df, id_col)
    count = own.select(F.count("*").alias("n"), F.percentile_approx(key, [i / 64 for i in range(65)], 10_000).alias("q")).first()
    if not count["n"]:
        return own.select(*kept, F.col("__size").alias("size"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    # 64 quantiles, each split evenly into ranges of about RANGE_ROWS rows; they balance the tasks and change no result
    per = max(1, -(-count["n"] // (64 * RANGE_ROWS)))
    marks = F.lit(sorted({float(x) for x in count["q"] or [0.0]}))
    at = F.array_size(F.filter(marks, lambda m: m <= key)) - 1
    low, high = F.get(marks, F.col("__at")), F.get(marks, F.col("__at") + 1)
    inner = F.least(F.lit(per - 1), F.floor((key - low) / (high - low) * per).cast("int"))
    rows = (barrier(own.withColumn("__at", F.coalesce(at, F.lit(-1))), "__at")
            .withColumn("__range", F.col("__at") * per + F.coalesce(inner, F.lit(0))).drop("__at"))
    rows = rows.select(*kept, "__tie", "__range", "__size", F.col("__size").alias("__bytes"), F.lit(1).cast("long").alias("__rows"))

    hot = (own.groupBy(F.col(id_col).alias("__id")).agg(F.count("*").alias("__n")).where(f"__n > {RANGE_ROWS}")
           .select("__id", F.ceil(F.col("__n") / RANGE_ROWS).cast("int").alias("__parts")))
    same = F.col(id_col).eqNullSafe(F.col("__id"))
    some_hot = bool(hot.limit(1).count())
    if some_hot:
        hot = bounded_broadcast(hot)
        many = rows.join(hot, same).drop("__id")
        place = F.least(F.col("__parts") - 1, F.floor((F.col("__tie").cast("double") / 2.0 ** 64 + 0.5) * F.col("__parts")).cast("int"))
        many = (many.groupBy(*kept, "__tie", "__range", "__size", "__parts").agg(F.sum("__bytes").alias("__bytes"), F.sum("__rows").alias("__rows"))
                .withColumn("__part", place))
        parts = many.groupBy(F.col(id_col).alias("__id"), "__range", "__part").agg(F.sum("__bytes").alias("__bytes"), F.sum("__rows").alias("__rows"))
        stands = (parts.groupBy(F.col("__id").alias(id_col), "__range").agg(F.sum("__bytes").alias("__bytes"), F.sum("__rows").alias("__rows"))
                  .withColumn("__stands", F.lit(True)))
        rows = rows.join(hot, same, "left_anti").withColumn("__stands", F.lit(False)).unionByName(stands, allowMissingColumns=True)

    totals = rows.groupBy("__range").agg(F.sum("__bytes").alias("bytes"), F.sum("__rows").alias("rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)     # one row a range
    offsets = totals.select("__range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__bytes0"),
                            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__row0"),
                            F.sum("bytes").over(Window.partitionBy(F.lit(0))).alias("__total"))
    inside = Window.partitionBy("__range").orderBy(F.col(id_col).asc_nulls_first(), "__tie")
    placed = (rows.join(bounded_broadcast(offsets), "__range").select("*", *_running(inside))
              .withColumn("__before", F.col("__before") + F.col("__bytes0")).withColumn("__row", F.col("__row") + F.col("__row0")))
    if some_hot:
        starts = placed.where("__stands").select(F.col(id_col).alias("__id"), F.col("__before").alias("__bytes0"), F.col("__row").alias("__row0"), "__total")
        of = F.col("__id").eqNullSafe(F.col("__own"))
        starts = (parts.select(F.col("__id").alias("__own"), "__part", "__bytes", "__rows")
                  .select("*", *_running(Window.partitionBy("__own").orderBy("__part"))).join(starts, of)               # one row a part
                  .select("__own", F.col("__part").alias("__its"), (F.col("__before") + F.col("__bytes0")).alias("__bytes0"),
                          (F.col("__row") + F.col("__row0")).alias("__row0"), "__total"))
        within = Window.partitionBy(id_col, "__part").orderBy("__tie", F.xxhash64(*kept))
        many = (many.join(bounded_broadcast(starts), F.col(id_col).eqNullSafe(F.col("__own")) & (F.col("__part") == F.col("__its")))
                .select("*", *_running(within)).withColumn("__before", F.col("__before") + F.col("__bytes0")).withColumn("__row", F.col("__row") + F.col("__row0")))
        # copies of equal rows again, a block at a time
        block = many.withColumn("__block", F.explode(F.expr(f"sequence(0L, (__rows - 1) div {RANGE_ROWS})")))
        block = block.repartition("__tie", "__block")
        copies = (block.withColumn("__k", F.explode(F.expr(f"sequence(__block * {RANGE_ROWS}, least(__rows, (__block + 1) * {RANGE_ROWS}) - 1)")))
                  .withColumn("__before", F.col("__before") + F.col("__k") * F.col("__size")).withColumn("__row", F.col("__row") + F.col("__k")))
        columns = [*kept, "__size", "__before", "__row", "__total"]
        placed = placed.where("not __stands").select(*columns).unionByName(copies.select(*columns))
    cut = F.expr(f"cast((2 * __before + __size) * {shards} div (2 * __total) as int)")
    placed = placed.withColumn("__shard", F.least(F.lit(shards - 1), cut))
    first = placed.groupBy("__shard").agg(F.min("__row").alias("__first"))                                  # one row a shard
    return (placed.join(F.broadcast(first), "__shard")
            .select(*kept, F.col("__size").alias("size"), F.col("__shard").alias("shard"), (F.col("__row") - F.col("__first")).alias("slot")))
