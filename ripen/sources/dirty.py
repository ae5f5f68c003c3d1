"""Dirty views over the driver's clean tables.

The given tables hold no nulls, duplicates or unit strings, so the defects
the operators exist for are injected by deterministic projections keyed by
the row key (see ``functions.rand``).  Each view exists twice: as a Spark
DataFrame and as DuckDB SQL for the oracle; both compute the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rand import u01
from ..functions.stats import spread
from .load import table

# Fixed values of the injected defects.
DUP_FRAC = 0.0035        # share of rows appended again as exact copies
MISSING_AMOUNT = 0.15
OUTLIER_AMOUNT = 0.015
MISSING_STATUS = 0.15
POSITIVE_RATE = 0.10
MISSING_TAX = 0.45


def orders_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(table(spark, sf_dir, "orders"))
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    y = F.when(u01(k, "y") < POSITIVE_RATE, F.lit(1)).otherwise(F.lit(0)).cast("int")
    base = o.select(
        k.alias("id"),
        F.when(u01(k, "tp") < MISSING_AMOUNT, F.lit(None).cast("double"))
         .when(u01(k, "out") < OUTLIER_AMOUNT, F.lit(-10.0) * price)
         .otherwise(price).alias("amount"),
        price.alias("total"),
        (F.lit(2.0) * price + u01(k, "co")).alias("total2"),
        F.when(u01(k, "st") < MISSING_STATUS, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.concat((k % 71 + 1).cast("string"), F.lit(" months")).alias("tenure"),
        F.concat(F.lit("City_"), (F.col("o_custkey") % 150).cast("string")).alias("city"),
        (F.lit(1.0) - F.lit(4.0) * F.log(F.lit(1.0) - u01(k, "sk"))).alias("los_days"),
        y.alias("y"),
        F.when(y == 1, F.lit("Charged-off")).otherwise(F.lit("Current")).alias("leak_label"),
        F.when(y == 1, F.lit(1) + F.floor(u01(k, "ld") * F.lit(29)))
         .otherwise(F.lit(0)).cast("bigint").alias("leak_days"),
    )
    return base.unionByName(base.filter(u01(F.col("id"), "dup") < DUP_FRAC))


def lineitem_key(prefix: str = "") -> list:
    return [F.col(prefix + c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]


def lineitem_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", *[c.cast("string") for c in lineitem_key()])
    tax = F.col("l_tax")
    return li.select(
        "l_quantity", "l_extendedprice", "l_discount",
        F.when(u01(key, "lt") < MISSING_TAX, F.lit(None).cast("double")).otherwise(tax).alias("l_tax"),
        (F.col("l_extendedprice") * (F.lit(1.0) + tax)).alias("gross"),
    )


def labeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents: both grow with sf, join on doc_id
    (documents side is larger; Spark picks the strategy from sizes)."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lab.join(doc, "doc_id", "inner")


# ---------------------------------------------------------------- DuckDB side

def sql_u(key_sql: str, salt: str) -> str:
    return (f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{salt}'), 1, 8))::BIGINT"
            f" / 4294967296.0)")


def sql_hash52(key_sql: str, salt: str) -> str:
    return f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{salt}'), 1, 13))::BIGINT)"


ORDERS_DIRTY_SQL = f"""
od_base AS (
  SELECT o_orderkey AS id,
    CASE WHEN {sql_u('o_orderkey', 'tp')} < {MISSING_AMOUNT} THEN NULL
         WHEN {sql_u('o_orderkey', 'out')} < {OUTLIER_AMOUNT} THEN -10.0 * o_totalprice
         ELSE o_totalprice END AS amount,
    o_totalprice AS total,
    2.0 * o_totalprice + {sql_u('o_orderkey', 'co')} AS total2,
    CASE WHEN {sql_u('o_orderkey', 'st')} < {MISSING_STATUS} THEN NULL ELSE o_orderstatus END AS status,
    o_orderpriority AS priority,
    CAST(o_orderkey % 71 + 1 AS VARCHAR) || ' months' AS tenure,
    'City_' || CAST(o_custkey % 150 AS VARCHAR) AS city,
    1.0 - 4.0 * ln(1.0 - {sql_u('o_orderkey', 'sk')}) AS los_days,
    CAST(CASE WHEN {sql_u('o_orderkey', 'y')} < {POSITIVE_RATE} THEN 1 ELSE 0 END AS INTEGER) AS y,
    CASE WHEN {sql_u('o_orderkey', 'y')} < {POSITIVE_RATE} THEN 'Charged-off' ELSE 'Current' END AS leak_label,
    CAST(CASE WHEN {sql_u('o_orderkey', 'y')} < {POSITIVE_RATE}
              THEN 1 + floor({sql_u('o_orderkey', 'ld')} * 29) ELSE 0 END AS BIGINT) AS leak_days
  FROM orders),
orders_dirty AS (
  SELECT * FROM od_base
  UNION ALL SELECT * FROM od_base WHERE {sql_u('id', 'dup')} < {DUP_FRAC})"""

_LKEY = ("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || "
         "CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)")

LINEITEM_DIRTY_SQL = f"""
lineitem_dirty AS (
  SELECT l_quantity, l_extendedprice, l_discount,
    CASE WHEN {sql_u(_LKEY, 'lt')} < {MISSING_TAX} THEN NULL ELSE l_tax END AS l_tax,
    l_extendedprice * (1.0 + l_tax) AS gross
  FROM lineitem)"""

LABELED_DOCUMENTS_SQL = """
labeled_documents AS (
  SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
