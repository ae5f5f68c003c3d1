"""Read-only EDA reports, each a small DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.fingerprint import split_repeated
from ..functions.quantile import bracket_dict, bracket_exprs, exact_quantiles, locate
from ..functions.scan import Aggregate, run, unpivoted
from ..functions.stats import c, checkpointed, fast_corr_row, fit_view
from ..functions.types import is_categorical, is_numeric, is_stat_numeric
from .profile import (CORR_LIMIT, OUTLIER_MIN, fence_bounds, infer_dtype,
                      numeric_text_share_exprs)

MIN_OUTLIER_VALUES = 10   # detect_outliers skips columns with fewer values
LEAK_GAIN = 0.99
LEAK_BINS = 20            # quantile buckets for fractional features in the purity test
ID_LIKE_SHARE = 0.5
HLL_ERROR = 0.02
SURELY_ID_LIKE = 0.75     # of the rows, by estimate


def detect_dtypes(df: DataFrame, target: str | None = None, mode: str = "strict") -> DataFrame:
    """Text columns whose content is numeric."""
    spark = df.sparkSession
    cols = [f.name for f in df.schema.fields if f.name != target and is_categorical(f.dataType)]
    out = []
    if cols:
        exprs = []
        for i, n in enumerate(cols):
            a, b = numeric_text_share_exprs(n)
            exprs += [a.alias(f"a{i}"), b.alias(f"b{i}")]
        row = df.agg(*exprs).first()
        types = {f.name: f.dataType for f in df.schema.fields}
        out = [(n,) for i, n in enumerate(cols)
               if infer_dtype(types[n], row[f"a{i}"], row[f"b{i}"], mode) == "numeric"]
    return spark.createDataFrame(out, "name string")


def check_missing(df: DataFrame) -> DataFrame:
    """D3: columns (target included) with nulls: count and percent (1 decimal)."""
    names = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(c(n).isNull()).alias(f"m{i}") for i, n in enumerate(names)]).first()
    n = row["__n"]
    out = [(nm, int(row[f"m{i}"]), round(100.0 * row[f"m{i}"] / n, 1))
           for i, nm in enumerate(names) if row[f"m{i}"] > 0]
    return df.sparkSession.createDataFrame(out, "name string, missing_count bigint, missing_pct double")


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows per non-null class; ratio = max / max(min, 1), 1 decimal.
    The extremes come from one aggregate, so any number of classes is fine."""
    counts = (df.filter(c(target).isNotNull()).groupBy(c(target).alias("value"))
                .agg(F.count(F.lit(1)).alias("n")))
    ratio = imbalance_ratio(df, target)
    return counts.select("value", "n", F.round(F.lit(ratio), 1).alias("ratio"))


def imbalance_ratio(df: DataFrame, target: str) -> float:
    row = (df.filter(c(target).isNotNull()).groupBy(c(target)).count()
             .agg(F.max("count").alias("mx"), F.min("count").alias("mn")).first())
    if row["mx"] is None:
        return 0.0
    return row["mx"] / max(row["mn"], 1)


LEAK_SCHEMA = "name string, purity double, base_rate double, gain double, is_leaky boolean"


def detect_leakage(df: DataFrame, target: str, gain_limit: float = LEAK_GAIN,
                   known=None, bins: int = LEAK_BINS) -> DataFrame:
    """D5, measured: how well a single feature predicts the target.

    purity = sum over feature values of the majority-class count / rows;
    gain = (purity - base) / (1 - base), base = majority-class share.
    Text, boolean and integer features are taken by value, whatever their
    range.  Fractional features go into ``bins`` quantile buckets, and a value
    that several quantiles share is a bucket of its own, so neither ties nor
    outliers move a boundary.  Columns taken by value with more than half the
    rows distinct are id-like and skipped: at once if a HyperLogLog estimate says
    three quarters or more (over ten of its standard errors off), else by the exact
    count.  ``known`` adds names from an issue manifest (the original's list-driven mode).

    Cost: one pass for counts, estimates and quantile brackets, the quantile
    passes over the fractional columns, and one long-form aggregation for
    numbers and one for texts, which id-like columns never enter; hot values are
    combined map-side.  The report (one row per feature) is fitted here, inside the
    view's cache.  A checkpointed table can't change, so its gains are measured once and
    kept with it: a report and the removal after it share them.
    """
    held = df.__dict__.setdefault("_ripen_gains", {}) if checkpointed(df) else {}
    if (target, bins) not in held:
        with fit_view(df) as fv:
            held[target, bins] = _leakage_gains(fv, target, bins)
    rows = [(name, purity, base, gain, gain >= gain_limit or name in (known or [])) for name, purity, base, gain in held[target, bins]]
    return df.sparkSession.createDataFrame(rows, LEAK_SCHEMA)


def quantile_bucket(v, quantiles: list[float]):
    """Bucket of a value: odd at a value that several quantiles share, else twice
    the number of distinct quantiles below it; null stays null."""
    edges = sorted(set(quantiles))
    shared = [e for e in edges if quantiles.count(e) > 1]
    at = locate(v, edges)
    return F.when(at.isNull() | v.isin(shared), at).otherwise(at - at % 2) if shared else at - at % 2


def _leakage_gains(df, target, bins) -> list[tuple]:
    base_df = df.filter(c(target).isNotNull())
    fields = [f for f in df.schema.fields
              if f.name != target and (is_categorical(f.dataType) or is_numeric(f.dataType))]
    fractional = [f.name for f in fields if isinstance(f.dataType, (T.FractionalType,))]
    by_value = [f.name for f in fields if f.name not in fractional]
    values, probs = [c(n).cast("double") for n in fractional], [i / bins for i in range(bins + 1)]

    def first():
        return (yield [Aggregate({n: F.approx_count_distinct(c(n), HLL_ERROR) for n in by_value}), Aggregate(bracket_dict(values, probs))])

    distinct, brackets = run(base_df, first())
    r = base_df.groupBy(c(target)).count().agg(F.sum("count").alias("n"), F.max("count").alias("mx")).first()
    n_rows, majority = r["n"] or 0, r["mx"] or 0
    if not fields or n_rows == 0:
        return []
    base = majority / n_rows
    by_value = [n for n in by_value if distinct[n] < SURELY_ID_LIKE * n_rows]
    cuts = dict(zip(fractional, exact_quantiles(base_df, values, probs, pre_row=brackets))) if fractional else {}
    types = {f.name: f.dataType for f in fields}
    numbers = {n: c(n).cast("bigint") for n in by_value if not is_categorical(types[n])}
    numbers |= {n: quantile_bucket(c(n).cast("double"), [x for x in cuts[n] if x is not None]).cast("bigint") for n in cuts}
    texts = {n: c(n).cast("string") for n in by_value if n not in numbers}
    per_name = {}
    for group in (numbers, texts):
        if group:
            long = unpivoted(base_df, list(group.values()), [c(target).alias("__t")])
            per_value = (long.groupBy("__slot", "__v", "__t").agg(F.count(F.lit(1)).alias("k"))
                         .groupBy("__slot", "__v").agg(F.max("k").alias("mx")))
            for x in per_value.groupBy("__slot").agg(F.sum("mx").alias("mx"), F.count("__v").alias("n")).collect():
                per_name[list(group)[x["__slot"]]] = x
    out = []
    for name in (f.name for f in fields if f.name in per_name):
        x = per_name[name]
        if name not in cuts and x["n"] > ID_LIKE_SHARE * n_rows or x["n"] == 0:
            continue
        purity = x["mx"] / n_rows
        gain = (purity - base) / (1.0 - base) if base < 1.0 else 0.0
        out.append((name, purity, base, gain))
    return out


def leaky_columns(df: DataFrame, target: str, gain_limit: float = LEAK_GAIN, known=None) -> list[str]:
    return [r["name"] for r in detect_leakage(df, target, gain_limit, known)
            .filter("is_leaky").select("name").collect()]


def high_correlations(df: DataFrame, target: str | None = None,
                      limit: float = CORR_LIMIT, corr: dict | None = None) -> DataFrame:
    """Numeric (non-boolean) pairs i < j with |r| > limit; one pass, or
    none when ``corr`` ({(a, b): r}, e.g. from the profile) is given."""
    spark = df.sparkSession
    cols = [f.name for f in df.schema.fields if f.name != target and is_stat_numeric(f.dataType)]
    schema = "col1 string, col2 string, abs_corr double"
    if len(cols) < 2:
        return spark.createDataFrame([], schema)
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if corr is not None:
        row = {f"r{k}": corr.get(pair) for k, pair in enumerate(pairs)}
    else:
        row = fast_corr_row(df, pairs)
    out = [(a, b, abs(row[f"r{k}"])) for k, (a, b) in enumerate(pairs)
           if row[f"r{k}"] is not None and abs(row[f"r{k}"]) > limit]
    return spark.createDataFrame(out, schema)


def detect_outliers(df: DataFrame, target: str | None = None, approx: bool = False) -> DataFrame:
    """IQR-fence outliers per numeric column (>= 10 values, report > 5).
    Counts and quantile brackets share the first pass; 4 scans in total."""
    spark = df.sparkSession
    cols = [f.name for f in df.schema.fields if f.name != target and is_stat_numeric(f.dataType)]
    schema = "name string, q1 double, q3 double, lower double, upper double, n_outliers bigint"
    if not cols:
        return spark.createDataFrame([], schema)
    with fit_view(df, cols) as fv:
        if approx:
            qs_all = exact_quantiles(fv, cols, [0.25, 0.75], approx=True)
            cnt = fv.agg(*[F.count(c(n)).alias(f"qbn{i}") for i, n in enumerate(cols)]).first()
        else:
            cnt = fv.agg(*bracket_exprs(cols, [0.25, 0.75], prefix="qb")).first()
        keep = [i for i, n in enumerate(cols) if cnt[f"qbn{i}"] >= MIN_OUTLIER_VALUES]
        if not keep:
            return spark.createDataFrame([], schema)
        kc = [cols[i] for i in keep]
        if approx:
            qs = [qs_all[i] for i in keep]
        else:
            pre = {}
            for j, i in enumerate(keep):
                pre[f"qbn{j}"], pre[f"qba{j}"] = cnt[f"qbn{i}"], cnt[f"qba{i}"]
            qs = exact_quantiles(fv, kc, [0.25, 0.75], pre_row=pre)
        bounds = [fence_bounds(q1, q3) for q1, q3 in qs]
        row = fv.agg(*[F.count_if((c(n).cast("double") < F.lit(lo)) | (c(n).cast("double") > F.lit(hi)))
                       .alias(f"o{i}") for i, (n, (lo, hi)) in enumerate(zip(kc, bounds))]).first()
    out = [(n, q[0], q[1], b[0], b[1], int(row[f"o{i}"]))
           for i, (n, q, b) in enumerate(zip(kc, qs, bounds)) if row[f"o{i}"] > OUTLIER_MIN]
    return spark.createDataFrame(out, schema)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows repeating an earlier row (all columns, null equals null).  Fingerprints
    are shuffled, whole rows only where a fingerprint repeats; copies of a hot row merge map-side."""
    _, shared = split_repeated(df)
    g = shared.groupBy(*[c(n) for n in df.columns]).agg(F.count(F.lit(1)).alias("k"))
    return g.agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"))
