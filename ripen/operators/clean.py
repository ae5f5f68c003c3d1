"""Cleaning operators, each ``DataFrame -> DataFrame``.

Every operator fits a few literals with bounded aggregate jobs (medians,
modes, top values, null shares) and then applies a plain projection, so
Catalyst keeps column pruning and predicate pushdown through the result.
Failures raise ``ValueError`` under the original's "nothing to do" rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.fingerprint import split_repeated
from ..functions.quantile import bracket_dict, quantile_steps
from ..functions.rand import normal01
from ..functions.scan import Aggregate, Fit, Top, on_its_own
from ..functions.stats import c, long_form
from ..functions.types import check_column, is_categorical, is_numeric
from . import eda
from .fitted import Fitted, operator
from .profile import NUMERIC_TEXT, STRICT_SHARE, fence_bounds

NUMBER_IN_TEXT = r"(\d+\.?\d*)"
CONVERT_SHARE = 0.5      # fix_dtypes converts when extractions cover > half the rows
ID_LIKE_SHARE = 0.5
HIGH_MISSING = 0.40
KEEP_CATEGORIES = 10
OTHER = "Other"
JITTER = 0.1


def extract_number(col) -> F.Column:
    """'24 months' -> 24.0, '[50-60)' -> 50.0, no digits -> null (ANSI-safe)."""
    return F.nullif(F.regexp_extract(col, NUMBER_IN_TEXT, 1), F.lit("")).try_cast("double")


def distinct_counts(df: DataFrame, cols: list[str]) -> dict:
    """Exact distinct non-null values per column: one long-form shuffle of
    the distinct (column, value) pairs, copies combined map-side."""
    if not cols:
        return {}
    found = (long_form(df, cols).filter("value is not null").groupBy("name", "value").agg(F.count(F.lit(1)).alias("k"))
             .groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect())
    return dict.fromkeys(cols, 0) | {r["name"]: r["n"] for r in found}


def fix_dtypes(df: DataFrame, target: str | None = None) -> DataFrame:
    """Text columns that hold numbers with units become doubles.
    A column converts when >= 70 % of its values start like a number, more
    than half of all rows yield a number, and it is not id-like."""
    text = [f.name for f in df.schema.fields if f.name != target and is_categorical(f.dataType)]
    if not text:
        raise ValueError("no dtype issues found to fix")
    exprs = [F.count(F.lit(1)).alias("__n")]
    for i, n in enumerate(text):
        exprs += [F.count(c(n)).alias(f"a{i}"), F.count_if(c(n).rlike(NUMERIC_TEXT)).alias(f"b{i}"),
                  F.count(extract_number(c(n))).alias(f"x{i}")]
    row = df.agg(*exprs).first()
    n_rows = row["__n"]
    cand = [n for i, n in enumerate(text)
            if row[f"a{i}"] > 0 and row[f"b{i}"] >= STRICT_SHARE * row[f"a{i}"]
            and row[f"x{i}"] > CONVERT_SHARE * n_rows]
    uniq = distinct_counts(df, cand)
    fix = [n for n in cand if uniq[n] <= ID_LIKE_SHARE * n_rows]
    if not fix:
        raise ValueError("no dtype issues found to fix")
    return df.select(*[extract_number(c(n)).alias(n) if n in fix else c(n) for n in df.columns])


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row per distinct full row (copies are identical, so "keep
    first" is moot).  Rows whose fingerprint is their own stay where they are;
    only the others are shuffled, and hot rows merge map-side."""
    own, shared = split_repeated(df)
    return own.select(*[c(n) for n in df.columns]).unionByName(shared.select(*[c(n) for n in df.columns]).dropDuplicates())


def remove_leaky(df: DataFrame, target: str, col=None,
                 gain_limit: float = eda.LEAK_GAIN, known=None) -> DataFrame:
    """Drop columns the measured leakage test flags: the named one(s),
    each of which must be flagged, or all flagged ones (``col=None``).
    One leakage test serves any number of named columns."""
    cols = None if col is None else ([col] if isinstance(col, str) else list(col))
    for n in cols or []:
        check_column(df, n, target)
    leaky = eda.leaky_columns(df, target, gain_limit, known)
    if cols is not None:
        wrong = [n for n in cols if n not in leaky]
        if wrong:
            raise ValueError(f"{wrong} not flagged as leaky")
        return df.drop(*cols)
    if not leaky:
        raise ValueError("no leaky column found")
    return df.drop(*leaky)


def _null_counts(cols: list[str]) -> Aggregate:
    return Aggregate({n: F.count_if(c(n).isNull()) for n in cols})


def _need_nulls(counts: dict) -> None:
    empty = [n for n, k in counts.items() if k == 0]
    if empty:
        raise ValueError(f"{empty} have no missing values")


def _as_list(col) -> list[str]:
    return [col] if isinstance(col, str) else list(col)


def fill_median_steps(df: DataFrame, col, target: str | None = None, approx: bool = False) -> Fit:
    """Nulls <- exact median (linear interpolation), numeric only."""
    cols = _as_list(col)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for n in cols:
        check_column(df, n, target)
        if not is_numeric(types[n]):
            raise ValueError("fill_missing_median requires a numeric column")
    values = [c(n).cast("double") for n in cols]
    nulls, first = yield [_null_counts(cols), Aggregate({} if approx else bracket_dict(values, [0.5]))]
    _need_nulls(nulls)
    meds = yield from quantile_steps(values, [0.5], approx=approx, pre_row=first)
    fills = dict(zip(cols, [m[0] for m in meds]))
    return Fitted({n: F.coalesce(c(n).cast("double"), F.lit(v)) for n, v in fills.items()})


fit_fill_median = on_its_own(fill_median_steps)
fill_median = operator(fit_fill_median)


def fill_mode_steps(df: DataFrame, col: str, target: str | None = None) -> Fit:
    """E5: nulls <- mode (any type): the most frequent non-null value, ties -> smallest."""
    check_column(df, col, target)
    nulls, top = yield [_null_counts([col]), Top(c(col), 1)]
    _need_nulls(nulls)
    if not top:
        raise ValueError(f"cannot compute a mode for {col!r}")
    return Fitted({col: F.coalesce(c(col), F.lit(top[0]).cast(df.schema[col].dataType))})


fit_fill_mode = on_its_own(fill_mode_steps)
fill_mode = operator(fit_fill_mode)


def fill_jitter_steps(df: DataFrame, col: str, key: str, seed: int = 42, target: str | None = None) -> Fit:
    """Nulls <- median + 0.1 * std * N(0,1), the normal draw keyed by the
    row key (reproducible, partition-independent)."""
    check_column(df, col, target)
    if not is_numeric(df.schema[col].dataType):
        raise ValueError("fill_missing_knn requires a numeric column")
    v = c(col).cast("double")
    nulls, row, first = yield [_null_counts([col]), Aggregate({"std": F.stddev_samp(v)}), Aggregate(bracket_dict([v], [0.5]))]
    _need_nulls(nulls)
    med = (yield from quantile_steps([v], [0.5], pre_row=first))[0][0]
    noise = F.lit(med) + F.lit(JITTER * (row["std"] or 0.0)) * normal01(c(key), f"jitter{seed}")
    return Fitted({col: F.coalesce(v, noise)})


fit_fill_jitter = on_its_own(fill_jitter_steps)
fill_jitter = operator(fit_fill_jitter)


def fill_constant_steps(df: DataFrame, col, value=None, target: str | None = None) -> Fit:
    """Nulls <- 0 (numeric) or 'missing' (text), or a given value."""
    cols = _as_list(col)
    for n in cols:
        check_column(df, n, target)
    (nulls,) = yield [_null_counts(cols)]
    _need_nulls(nulls)
    types = dict((f.name, f.dataType) for f in df.schema.fields)

    def fill(n):
        v = value if value is not None else (0 if is_numeric(types[n]) else "missing")
        return F.coalesce(c(n), F.lit(v).cast(types[n]))
    return Fitted({n: fill(n) for n in cols})


fit_fill_constant = on_its_own(fill_constant_steps)
fill_constant = operator(fit_fill_constant)


def clip_outliers_steps(df: DataFrame, col, target: str | None = None, approx: bool = False) -> Fit:
    """Clip to the 1.5 IQR fences; nulls stay null (least/greatest skip
    nulls, hence the guard)."""
    cols = _as_list(col)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for n in cols:
        check_column(df, n, target)
        if not is_numeric(types[n]):
            raise ValueError("clip_outliers requires a numeric column")
    qs = yield from quantile_steps([c(n).cast("double") for n in cols], [0.25, 0.75], approx=approx)
    bounds = {n: fence_bounds(q1, q3) for n, (q1, q3) in zip(cols, qs) if q1 is not None}

    def clip(n):
        lo, hi = bounds[n]
        v = c(n).cast("double")
        return F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(hi)), F.lit(lo)))
    return Fitted({n: clip(n) for n in bounds})


fit_clip_outliers = on_its_own(clip_outliers_steps)
clip_outliers = operator(fit_clip_outliers)


def null_shares(df: DataFrame, cols: list[str]) -> dict:
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(c(n).isNull()).alias(f"m{i}") for i, n in enumerate(cols)]).first()
    n = max(row["__n"], 1)
    return {x: row[f"m{i}"] / n for i, x in enumerate(cols)}


def drop_high_missing(df: DataFrame, col: str | None = None, threshold: float = HIGH_MISSING,
                      target: str | None = None) -> DataFrame:
    """Drop a column whose null share >= threshold (or all such columns)."""
    if col is not None:
        check_column(df, col, target)
        share = null_shares(df, [col])[col]
        if share < threshold:
            raise ValueError(f"{col!r} has only {share:.0%} missing; threshold is {threshold:.0%}")
        return df.drop(col)
    cols = [n for n in df.columns if n != target]
    drop = [n for n, s in null_shares(df, cols).items() if s >= threshold]
    if not drop:
        raise ValueError("no column reaches the missing-value threshold")
    return df.drop(*drop)


def reduce_cardinality_steps(df: DataFrame, col: str, k: int = KEEP_CATEGORIES, other: str = OTHER, target: str | None = None) -> Fit:
    """Keep the k most frequent values, everything else (null too) ->
    'Other'.  At most k literals reach the plan (an ``isin``)."""
    check_column(df, col, target)
    if not is_categorical(df.schema[col].dataType):
        raise ValueError(f"{col!r} is not categorical")
    (keep,) = yield [Top(c(col), k)]
    return Fitted({col: F.when(c(col).isin(keep), c(col)).otherwise(F.lit(other))})


fit_reduce_cardinality = on_its_own(reduce_cardinality_steps)
reduce_cardinality = operator(fit_reduce_cardinality)


def drop_correlated(df: DataFrame, target: str | None = None, col: str | None = None,
                    limit: float = eda.CORR_LIMIT) -> DataFrame:
    """Drop the named column, or for each correlated pair (i < j) the
    later column unless one of the pair is already dropped."""
    if col is not None:
        check_column(df, col, target)
        return df.drop(col)
    dropped: list[str] = []
    for r in eda.high_correlations(df, target, limit).collect():
        if r["col1"] not in dropped and r["col2"] not in dropped:
            dropped.append(r["col2"])
    if not dropped:
        raise ValueError("no correlated column found")
    return df.drop(*dropped)
