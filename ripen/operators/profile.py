"""C: per-column profile (flagship) and D1 dataset profile.

All numeric moments, null counts, text-shape counts and pairwise
correlations come from ONE aggregate pass; quartiles from the exact
selection in ``functions.quantile`` (three scans); fence outliers from one
more pass; distinct counts and top categories from the long-form value
counts.  The result has one row per column and is built on the driver from
these bounded aggregates (#columns rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.quantile import bracket_exprs, exact_quantiles
from ..functions.stats import (c, fast_corr_row, fit_view, pandas_skew, top_k_values,
                               typed_value_counts, value_counts)
from ..functions.types import (dtype_label, is_categorical, is_datetime, is_numeric,
                               is_stat_numeric)

PROFILE_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("inferred_dtype", T.StringType()),
    T.StructField("missing_count", T.LongType()),
    T.StructField("missing_pct", T.DoubleType()),
    T.StructField("unique_count", T.LongType()),
    T.StructField("is_leaky", T.BooleanType()),
    T.StructField("is_high_cardinality", T.BooleanType()),
    T.StructField("is_skewed", T.BooleanType()),
    T.StructField("has_outliers", T.BooleanType()),
    T.StructField("correlated_with", T.StringType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("skewness", T.DoubleType()),
    T.StructField("top_categories", T.ArrayType(T.StringType())),
])

# Fixed limits of the profile rules.
MIN_STATS_VALUES = 10      # mean/std/skew/outliers need more than this many values
SKEW_LIMIT = 1.0
OUTLIER_MIN = 5            # has_outliers: more than this many fence outliers
HIGH_CARDINALITY = 50
CORR_LIMIT = 0.85
TOP_CATEGORIES = 5
NUMERIC_TEXT = r"^\[?\d"   # text that starts like a number: "24 months", "[50-60)"
STRICT_SHARE = 0.7


def numeric_text_share_exprs(name: str):
    """(count non-null, count starting like a number) for a text column."""
    return (F.count(c(name)), F.count_if(c(name).rlike(NUMERIC_TEXT)))


def infer_dtype(dt, n_nonnull: int, n_numeric_text: int, mode: str = "strict") -> str:
    """B3.  ``strict``: a text column is numeric when >= 70 % of its values
    start like a number.  ``reference``: any text column with more than five
    values is numeric (the sample-size test of the original rule)."""
    if is_numeric(dt):
        return "numeric"
    if is_datetime(dt):
        return "datetime"
    if mode == "reference":
        return "numeric" if min(n_nonnull, 50) > 5 else "categorical"
    if n_nonnull > 0 and n_numeric_text >= STRICT_SHARE * n_nonnull:
        return "numeric"
    return "categorical"


def fence_bounds(q1: float, q3: float) -> tuple[float, float]:
    iqr = q3 - q1
    return q1 - 1.5 * iqr, q3 + 1.5 * iqr


def correlated_partners(corr: dict, cols: list[str], limit: float = CORR_LIMIT) -> dict:
    """For each column the highest-position partner with |r| > limit
    (the original's pair loop overwrites, so the last partner survives)."""
    best = {}
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                continue
            r = corr.get((a, b) if i < j else (b, a))
            if r is not None and abs(r) > limit:
                best[a] = b   # j ascends, so the highest-position partner stays
    return best


def column_profile(df: DataFrame, target: str | None = None, leaky_cols=None,
                   infer_mode: str = "strict", approx: bool = False,
                   corr_limit: float = CORR_LIMIT) -> DataFrame:
    with fit_view(df) as fv:
        rows, _info = profile_stats(fv, target, leaky_cols, infer_mode, approx, corr_limit)
        return fv.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def profile_stats(df, target, leaky_cols=None, infer_mode="strict", approx=False, corr_limit=CORR_LIMIT):
    """The profile rows plus what the passes found on the way, for callers
    that need more than the profile (issue detection, plans) without new
    scans: {"n_rows", "corr": {(a, b): r}}."""
    spark = df.sparkSession
    fields = [f for f in df.schema.fields if f.name != target]
    names = [f.name for f in fields]
    stat_cols = [f.name for f in fields if is_stat_numeric(f.dataType)]
    corr_cols = [f.name for f in fields if is_numeric(f.dataType)]   # bools included here
    text_cols = [f.name for f in fields if is_categorical(f.dataType)]
    leaky = set(leaky_cols or [])

    # pass 1: counts, moments, text shape, pairwise correlations
    exprs = [F.count(F.lit(1)).alias("__n")]
    for i, n in enumerate(names):
        exprs.append(F.count_if(c(n).isNull()).alias(f"miss{i}"))
    for i, n in enumerate(stat_cols):
        v = c(n).cast("double")
        exprs += [F.count(v).alias(f"cnt{i}"), F.avg(v).alias(f"avg{i}"),
                  F.stddev_samp(v).alias(f"std{i}"), F.skewness(v).alias(f"skw{i}"),
                  F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
    if not approx:
        exprs += bracket_exprs(stat_cols, [0.25, 0.75], prefix="qb")
    for i, n in enumerate(text_cols):
        a, b = numeric_text_share_exprs(n)
        exprs += [a.alias(f"tn{i}"), b.alias(f"tm{i}")]
    pairs = [(corr_cols[i], corr_cols[j]) for i in range(len(corr_cols))
             for j in range(i + 1, len(corr_cols))]
    agg = fast_corr_row(df, pairs, extra=exprs)
    n_rows = agg["__n"]

    # quartiles for columns with enough values: the first bracket came with pass 1
    quart_cols = [n for i, n in enumerate(stat_cols) if agg[f"cnt{i}"] > MIN_STATS_VALUES]
    quarts = {}
    if quart_cols:
        if approx:
            qv = exact_quantiles(df, quart_cols, [0.25, 0.75], approx=True)
        else:
            keep = [stat_cols.index(n) for n in quart_cols]
            pre = {}
            for j, i in enumerate(keep):
                pre[f"qbn{j}"] = agg[f"qbn{i}"]
                pre[f"qba{j}"] = agg[f"qba{i}"]
            qv = exact_quantiles(df, quart_cols, [0.25, 0.75], pre_row=pre)
        quarts = dict(zip(quart_cols, qv))
    # one pass: fence outliers for all those columns
    outl = {}
    if quarts:
        oexprs = []
        for i, n in enumerate(quart_cols):
            lo, hi = fence_bounds(*quarts[n])
            v = c(n).cast("double")
            oexprs.append(F.count_if((v < F.lit(lo)) | (v > F.lit(hi))).alias(f"o{i}"))
        orow = df.agg(*oexprs).first()
        outl = {n: orow[f"o{i}"] for i, n in enumerate(quart_cols)}

    # long-form value counts: distinct per column and top categories of text
    # columns in ONE query (both branches reuse the same counts exchange)
    uniq: dict = {}
    tops: dict = {}
    if approx:
        uniq = dict(df.agg(*[F.approx_count_distinct(c(n)).alias(n) for n in names]).first().asDict())
        if text_cols:
            counts = value_counts(df, text_cols)
            for r in top_k_values(counts, TOP_CATEGORIES, text_cols).collect():
                tops.setdefault(r["name"], []).append((r["rank"], r["value"]))
    else:
        counts = typed_value_counts(df, names)
        u = counts.groupBy("name").agg(F.count("value").alias("u")).select(
            "name", F.lit(None).cast("string").alias("value"), F.col("u").alias("k"), F.lit(0).alias("kind"))
        t = top_k_values(counts, TOP_CATEGORIES, text_cols).select(
            "name", "value", F.col("rank").cast("bigint").alias("k"), F.lit(1).alias("kind"))
        for r in u.unionByName(t).collect():
            if r["kind"] == 0:
                uniq[r["name"]] = r["k"]
            else:
                tops.setdefault(r["name"], []).append((r["k"], r["value"]))

    corr = {pair: agg[f"r{k}"] for k, pair in enumerate(pairs)}
    partners = correlated_partners(corr, corr_cols, corr_limit)
    rows = []
    stat_idx = {n: i for i, n in enumerate(stat_cols)}
    text_idx = {n: i for i, n in enumerate(text_cols)}
    for pos, f in enumerate(fields):
        n = f.name
        miss = agg[f"miss{names.index(n)}"]
        mean = std = skew = None
        is_skewed = has_out = False
        if n in stat_idx and agg[f"cnt{stat_idx[n]}"] > MIN_STATS_VALUES:
            i = stat_idx[n]
            cnt = agg[f"cnt{i}"]
            mean = round(float(agg[f"avg{i}"]), 3)
            std = round(float(agg[f"std{i}"]), 3)
            skew = round(float(pandas_skew(cnt, agg[f"skw{i}"])), 3)
            is_skewed = abs(skew) > SKEW_LIMIT
            has_out = outl.get(n, 0) > OUTLIER_MIN
        if n in text_idx:
            ti = text_idx[n]
            inferred = infer_dtype(f.dataType, agg[f"tn{ti}"], agg[f"tm{ti}"], infer_mode)
            top = [v for _, v in sorted(tops.get(n, []))]
        else:
            inferred = infer_dtype(f.dataType, 0, 0, infer_mode)
            top = None
        u = int(uniq.get(n, 0) or 0)
        rows.append((pos, n, dtype_label(f.dataType), inferred, int(miss),
                     round(miss / max(n_rows, 1), 3), u, n in leaky,
                     bool(u > HIGH_CARDINALITY and is_categorical(f.dataType)),
                     bool(is_skewed), bool(has_out), partners.get(n), mean, std, skew, top))
    info = {"n_rows": n_rows, "corr": corr}
    return rows, info


FIXED_WIDTH = {  # bytes per value of fixed-width types
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.BooleanType: 1, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.DateType: 4, T.DecimalType: 16,
}


def profile_dataset(df: DataFrame) -> DataFrame:
    """Rows, columns, estimated bytes, count of columns per type."""
    spark = df.sparkSession
    fields = df.schema.fields
    exprs = [F.count(F.lit(1)).alias("n")]
    var = [f.name for f in fields if type(f.dataType) not in FIXED_WIDTH]
    for i, n in enumerate(var):
        exprs.append(F.coalesce(F.sum(F.octet_length(c(n).cast("string"))), F.lit(0)).alias(f"b{i}"))
    row = df.agg(*exprs).first()
    n = row["n"]
    fixed = sum(FIXED_WIDTH[type(f.dataType)] for f in fields if type(f.dataType) in FIXED_WIDTH)
    est = n * fixed + sum(int(row[f"b{i}"]) for i in range(len(var)))
    kinds: dict = {}
    for f in fields:
        kinds[f.dataType.simpleString()] = kinds.get(f.dataType.simpleString(), 0) + 1
    dtype_counts = ",".join(f"{k}:{v}" for k, v in sorted(kinds.items()))
    schema = "n_rows bigint, n_cols bigint, est_bytes bigint, dtype_counts string"
    return spark.createDataFrame([(n, len(fields), est, dtype_counts)], schema)


def profile_json(profile: DataFrame) -> DataFrame:
    """The profile as one JSON array (columns in position order), for a
    prompt or an API; built by ``to_json`` over the bounded profile rows."""
    cols = [f.name for f in PROFILE_SCHEMA.fields]
    return profile.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*cols))),
                                 {"ignoreNullFields": "false"}).alias("profile_json"))
