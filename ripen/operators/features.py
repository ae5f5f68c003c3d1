"""Feature engineering.

Data-dependent schemas (one-hot columns, the kept top-k) are decided by one
bounded job first; everything else is a projection or a lookup join whose
broadcast side has a counted size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.lookup import lookup_join
from ..functions.quantile import bracket_dict, exact_quantiles, quantile_steps
from ..functions.rand import u01
from ..functions.scan import Aggregate, Fit, Levels, Top, on_its_own, run
from ..functions.stats import c, fit_view
from ..functions.types import check_column, is_categorical, is_numeric
from ..session import cut_lineage
from . import forest
from .fitted import Fitted, operator

MISSING = "missing"
MAX_ONEHOT = 20
TOP_K = 10
IMPORTANCE_K = 5
TARGET_FOLDS = 5
TARGET_PRIOR = 10.0
FOLD_SEED = 42


def _text(df: DataFrame, col: str, target: str | None) -> None:
    check_column(df, col, target)
    if not is_categorical(df.schema[col].dataType):
        raise ValueError(f"{col!r} is already numeric")


def _numeric(df: DataFrame, col: str, target: str | None) -> None:
    check_column(df, col, target)
    if not is_numeric(df.schema[col].dataType):
        raise ValueError(f"{col!r} is not numeric")


def encode_onehot_steps(df: DataFrame, col: str, max_levels: int = MAX_ONEHOT, target: str | None = None) -> Fit:
    """one boolean column ``<col>_<level>`` per level (null -> 'missing'),
    levels in code-point order, appended at the end; the source is dropped.
    Fitting asks for the max+1 most frequent levels."""
    _text(df, col, target)
    v = F.coalesce(c(col), F.lit(MISSING))
    (top,) = yield [Top(v, max_levels + 1)]
    levels = sorted(top)
    if len(levels) > max_levels:
        raise ValueError(f"{col!r} has more than {max_levels} levels; use encode_label")
    names = [f"{col}_{lv}" for lv in levels]
    lower = {n.lower() for n in df.columns if n != col}
    if len({n.lower() for n in names}) < len(names) or lower & {n.lower() for n in names}:
        raise ValueError(f"one-hot names of {col!r} collide (Spark resolves names case-insensitively)")
    return Fitted(expand={col: [(nm, v == F.lit(lv)) for lv, nm in zip(levels, names)]})


fit_encode_onehot = on_its_own(encode_onehot_steps)
encode_onehot = operator(fit_encode_onehot)


def label_codes(df: DataFrame, col: str, null_text: str = MISSING) -> tuple:
    """(value expr, code table with __v, __n and __code) of a text column: the
    levels are counted once and numbered by a distributed sort; the table is
    checkpointed, so counting, broadcasting or shuffling it never re-reads df."""
    v = F.coalesce(c(col), F.lit(null_text))

    def steps():
        return (yield [Levels(v)])[0]
    return v, run(df, steps())


def encode_label_steps(df: DataFrame, col: str, target: str | None = None) -> Fit:
    """codes 0..k-1 in code-point order (null -> 'missing')."""
    _text(df, col, target)
    v = F.coalesce(c(col), F.lit(MISSING))
    (table,) = yield [Levels(v)]
    return Fitted(lookup=(col, v, table, "__code"))


fit_encode_label = on_its_own(encode_label_steps)
encode_label = operator(fit_encode_label)


def fit_encode_target(df: DataFrame, col: str, target: str) -> Fitted:
    """level -> mean of the target in that level (no smoothing, like the
    original).  The means are aggregated once (checkpointed) and joined back;
    broadcast only when their counted size is bounded."""
    _text(df, col, target)
    v = F.coalesce(c(col), F.lit(MISSING))
    means = cut_lineage(df.groupBy(v.alias("__v")).agg(F.avg(c(target).cast("double")).alias("__mean")))
    return Fitted(lookup=(col, v, means, "__mean"))


encode_target = operator(fit_encode_target)


def encode_target_folds(df: DataFrame, col: str, target: str, key: str, folds: int = TARGET_FOLDS,
                        prior: float = TARGET_PRIOR, seed: int = FOLD_SEED) -> tuple[DataFrame, Fitted]:
    """F3 without the leak of a row's own target: out-of-fold means.

    A row's fold is keyed by md5 of ``key``.  Its level becomes the target's mean over the
    level's rows in all other folds, shrunk by ``prior`` rows of the overall mean of those
    folds; a level that no other fold has becomes that mean.  Rows without a target count
    nowhere and are encoded all the same.  Also gives the fit for other tables, from
    all folds (a level that is not there becomes null).  One grouping by level: sums per
    fold are columns, and a row picks those of its fold.
    """
    _text(df, col, target)
    check_column(df, key)
    v, y = F.coalesce(c(col), F.lit(MISSING)), c(target).cast("double")
    fold = F.floor(u01(c(key), f"fold{seed}") * F.lit(folds)).cast("int")
    mine = [F.when(fold == k, y) for k in range(folds)]
    table = cut_lineage(df.groupBy(v.alias("__v")).agg(F.array(*[F.count(x) for x in mine]).alias("__n"),
                                                       F.array(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in mine]).alias("__s")))
    row = table.agg(*[F.sum(F.col(x)[k]).alias(f"{x}{k}") for x in ("__n", "__s") for k in range(folds)]).first()
    n, s = ([row[f"{x}{k}"] or 0 for k in range(folds)] for x in ("__n", "__s"))
    if not sum(n):
        raise ValueError(f"no row has a value of {target!r}")
    others = [(sum(s) - s[k]) / (sum(n) - n[k]) if sum(n) > n[k] else sum(s) / sum(n) for k in range(folds)]

    def mean(skip: F.Column | None, base: F.Column) -> F.Column:
        total = {x: F.aggregate(F.col(x), F.lit(0.0), lambda a, b: a + b) for x in ("__n", "__s")}
        if skip is not None:
            total = {x: t - F.get(F.col(x), skip) for x, t in total.items()}
        return (total["__s"] + F.lit(prior) * base) / (total["__n"] + F.lit(prior))

    joined = lookup_join(df.withColumn("__v", v).withColumn("__f", fold), table, on="__v")
    out = joined.select(*[mean(F.col("__f"), F.get(F.lit(others), F.col("__f"))).alias(x) if x == col else c(x) for x in df.columns])
    every = table.select("__v", mean(None, F.lit(sum(s) / sum(n))).alias("__mean"))
    return out, Fitted(lookup=(col, v, every, "__mean"))


def normalize_standard_steps(df: DataFrame, col, target: str | None = None) -> Fit:
    """fill nulls with the median first, then (x - mean) / std (ddof 1)
    of the filled column.  Several columns share one quantile selection and
    one moments pass."""
    cols = [col] if isinstance(col, str) else list(col)
    for n in cols:
        _numeric(df, n, target)
    meds = [m[0] for m in (yield from quantile_steps([c(n).cast("double") for n in cols], [0.5]))]
    filled = {n: F.coalesce(c(n).cast("double"), F.lit(m)) for n, m in zip(cols, meds)}
    (r,) = yield [Aggregate({k: x for i, n in enumerate(cols) for k, x in ((f"m{i}", F.avg(filled[n])), (f"s{i}", F.stddev_samp(filled[n])))})]
    flat = [n for i, n in enumerate(cols) if not r[f"s{i}"]]
    if flat:
        raise ValueError(f"{flat} have zero variance")
    out = {n: (filled[n] - F.lit(r[f"m{i}"])) / F.lit(r[f"s{i}"]) for i, n in enumerate(cols)}
    return Fitted(out)


fit_normalize_standard = on_its_own(normalize_standard_steps)
normalize_standard = operator(fit_normalize_standard)


def normalize_robust_steps(df: DataFrame, col: str, target: str | None = None) -> Fit:
    """fill the median, then (x - median) / IQR of the filled column."""
    _numeric(df, col, target)
    med = (yield from quantile_steps([c(col).cast("double")], [0.5]))[0][0]
    filled = F.coalesce(c(col).cast("double"), F.lit(med))
    q1, m2, q3 = (yield from quantile_steps([filled], [0.25, 0.5, 0.75]))[0]
    if q3 - q1 == 0:
        raise ValueError(f"{col!r} has zero IQR")
    return Fitted({col: (filled - F.lit(m2)) / F.lit(q3 - q1)})


fit_normalize_robust = on_its_own(normalize_robust_steps)
normalize_robust = operator(fit_normalize_robust)


def log_transform_steps(df: DataFrame, col, target: str | None = None) -> Fit:
    """log1p of the median-filled column; refuses negative values.
    Several columns share one min pass and one quantile selection."""
    cols = [col] if isinstance(col, str) else list(col)
    for n in cols:
        _numeric(df, n, target)
    values = [c(n).cast("double") for n in cols]
    mins, first = yield [Aggregate({f"lo{i}": F.min(c(n)) for i, n in enumerate(cols)}), Aggregate(bracket_dict(values, [0.5]))]
    neg = [n for i, n in enumerate(cols) if mins[f"lo{i}"] is not None and mins[f"lo{i}"] < 0]
    if neg:
        raise ValueError(f"{neg} have negative values; log1p needs non-negative input")
    meds = dict(zip(cols, [m[0] for m in (yield from quantile_steps(values, [0.5], pre_row=first))]))
    return Fitted({n: F.log1p(F.coalesce(c(n).cast("double"), F.lit(m))) for n, m in meds.items()})


fit_log_transform = on_its_own(log_transform_steps)
log_transform = operator(fit_log_transform)


def _filled_numbers(df: DataFrame, nums: list[str]) -> dict:
    if not nums:
        return {}
    meds = exact_quantiles(df, [c(n).cast("double") for n in nums], [0.5])
    return {n: F.coalesce(c(n).cast("double"), F.lit(m[0])) for n, m in zip(nums, meds)}


def encoded_features(df: DataFrame, target: str | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every non-target column as a number: text -> label code of its text
    (null becomes the text 'nan', as the original's astype(str) did), numbers
    -> median-filled doubles.  Columns of ``keep`` stay as they are.  Used by F7."""
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [n for n in df.columns if n != target and n not in keep and is_categorical(types[n])]
    filled = _filled_numbers(df, [n for n in df.columns if n != target and n not in keep and n not in texts])
    enc = df.select(*[filled[n].alias(n) if n in filled else c(n) for n in df.columns])
    values = [F.coalesce(c(n), F.lit("nan")) for n in texts]

    def levels():
        return (yield [Levels(v) for v in values])
    for n, v, table in zip(texts, values, run(df, levels())):          # one count for all of them
        enc = Fitted(lookup=(n, v, table, "__code")).transform(enc)
    return enc


def feature_variances(df: DataFrame, target: str) -> list[tuple[str, float | None]]:
    """(feature, sample variance of its encoded values), largest first, ties in
    column order.  A text column's variance comes from its (code, count) table:
    no row is joined."""
    feats = [n for n in df.columns if n != target]
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [n for n in feats if is_categorical(types[n])]
    found: dict = {}
    with fit_view(df) as fv:
        filled = _filled_numbers(fv, [n for n in feats if n not in texts])
        if filled:
            row = fv.agg(*[F.var_samp(x).alias(f"v{i}") for i, x in enumerate(filled.values())]).first()
            found = {n: row[f"v{i}"] for i, n in enumerate(filled)}
        for n in texts:
            _, table = label_codes(fv, n, null_text="nan")
            code, k = F.col("__code").cast("decimal(38,0)"), F.col("__n").cast("decimal(38,0)")
            r = table.agg(F.sum(k).alias("n"), F.sum(k * code).alias("s"), F.sum((k * code).cast("decimal(38,0)") * F.col("__code")).alias("q")).first()
            found[n] = float((r["q"] - r["s"] * r["s"] / r["n"]) / (r["n"] - 1)) if r["n"] and r["n"] > 1 else None
    order = sorted(range(len(feats)), key=lambda i: (-(found[feats[i]] if found[feats[i]] is not None else float("-inf")), i))
    return [(feats[i], found[feats[i]]) for i in order]


def variance_ranking(df: DataFrame, target: str) -> DataFrame:
    """The order F8 keeps features in: (position, feature, variance)."""
    rows = [(i, n, v) for i, (n, v) in enumerate(feature_variances(df, target))]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, variance double")


def select_top_k(df: DataFrame, target: str, k: int = TOP_K) -> DataFrame:
    """F8: keep the k features with the largest sample variance of their
    encoded values, in variance-descending order, then the target; kept columns
    keep their raw values."""
    if len(df.columns) - 1 <= k:
        raise ValueError(f"k = {k} keeps all {len(df.columns) - 1} features")
    keep = [n for n, _ in feature_variances(df, target)[:k]]
    return df.select(*[c(n) for n in keep], c(target))


def forest_splits(df: DataFrame, target: str, key: str | None = None, **forest_args) -> list[tuple[int, int, int, int, float]]:
    """The splits of F7's forest: (tree, node, feature position, bin, gain).  Without a key
    column, a row is drawn by its values."""
    feats = [n for n in df.columns if n != target]
    row = c(key).cast("string") if key else F.concat_ws("|", *[F.coalesce(c(n).cast("string"), F.lit("")) for n in df.columns])
    keyed = df.where(c(target).isNotNull()).withColumn("__key", row)
    with fit_view(encoded_features(keyed, target, keep=("__key",))) as enc:
        return forest.grow(enc, feats, target, "__key", **forest_args)


def feature_importance(df: DataFrame, target: str, k: int = IMPORTANCE_K, key: str | None = None) -> DataFrame:
    """random-forest importances (30 trees, seed 42) over the encoded
    features; top k, rounded to 3.  See ``forest`` for how it is grown."""
    feats = [n for n in df.columns if n != target]
    imp = forest.importances(forest_splits(df, target, key), len(feats))
    top = sorted(range(len(feats)), key=lambda i: (-round(imp[i], 3), i))[:k]
    return df.sparkSession.createDataFrame([(feats[i], round(imp[i], 3)) for i in top], "feature string, importance double")


def create_interaction(df: DataFrame, a: str, b: str, target: str | None = None) -> DataFrame:
    """``<a>_x_<b>`` = a * b (nulls propagate)."""
    _numeric(df, a, target)
    _numeric(df, b, target)
    return df.withColumn(f"{a}_x_{b}", c(a) * c(b))
