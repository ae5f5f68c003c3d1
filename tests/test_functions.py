import numpy as np
from pyspark.sql import functions as F

from ripen.functions.quantile import exact_quantiles, order_statistics
from ripen.functions.running import running


def test_quantiles_match_numpy_on_ties_and_hot_values(spark):
    rng = np.random.default_rng(1)
    vals = list(rng.normal(size=30000)) + [0.5] * 15000 + [None] * 50   # a hot value: a third of rows
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in vals], "x double")
    got = exact_quantiles(df, ["x"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0])[0]
    arr = np.array([v for v in vals if v is not None])
    want = np.quantile(arr, [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0])
    assert list(got) == list(want)          # bit-equal to numpy (pandas)


def test_quantiles_large_region_refines(spark):
    df = spark.range(0, 60000).select((F.col("id") * 7 % 60000).cast("double").alias("x"))
    got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])[0]
    want = np.quantile(np.arange(60000, dtype=float), [0.25, 0.5, 0.75])
    assert np.allclose(got, want)


def test_order_statistics_per_group(spark):
    df = spark.range(0, 1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    vals = order_statistics(df, [(F.col("v"), F.col("g") == 0, 10, 500, 0), (F.col("v"), F.col("g") == 1, 0, 500, 1)])
    assert vals == [20.0, 1.0]


def test_running_matches_window(spark):
    from pyspark.sql import Window as W
    df = spark.range(0, 3000).select((F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 7)).alias("g"),
                                     F.col("id").alias("o"), (F.col("id") % 5).alias("v"))
    got = running(df, ["g"], ["o"], {"s": F.col("v")}, row_number="rn", parts=6)
    w = W.partitionBy("g").orderBy("o")
    want = df.select("g", "o", F.sum("v").over(w).alias("s"), F.row_number().over(w).alias("rn"))
    a = sorted(tuple(r) for r in got.select("g", "o", "s", "rn").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b


def test_corr_chunks_and_zero_variance_fallback(spark, monkeypatch):
    import ripen.functions.stats as S
    df = spark.range(0, 500).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2 + 1).cast("double").alias("b"),
                                    F.lit(3.0).alias("k"), ((F.col("id") * 7) % 13).cast("double").alias("c"))
    pairs = [("a", "b"), ("a", "k"), ("b", "c"), ("a", "c")]
    monkeypatch.setattr(S, "CORR_PAIRS", 2)
    got = S.fast_corr_row(df, pairs, extra=[F.count(F.lit(1)).alias("n")])
    assert got["n"] == 500
    assert abs(got["r0"] - 1.0) < 1e-12 and got["r1"] is None
    want = df.agg(F.corr("b", "c").alias("x"), F.corr("a", "c").alias("y")).first()
    assert abs(got["r2"] - want["x"]) < 1e-12 and abs(got["r3"] - want["y"]) < 1e-12


def test_approx_paths_are_close(spark):
    from ripen.operators.profile import column_profile
    from ripen.sources.dirty import orders_dirty
    from conftest import SF
    od = orders_dirty(spark, SF)
    a = {r["name"]: r for r in column_profile(od, "y", approx=True).collect()}
    e = {r["name"]: r for r in column_profile(od, "y").collect()}
    assert a["city"]["is_high_cardinality"] == e["city"]["is_high_cardinality"]
    assert abs(a["city"]["unique_count"] - e["city"]["unique_count"]) <= 0.05 * e["city"]["unique_count"]
    assert a["amount"]["has_outliers"] == e["amount"]["has_outliers"]


def test_fit_view_keeps_the_callers_cache(spark):
    from ripen.functions.stats import fit_view
    df = spark.range(0, 100).groupBy((F.col("id") % 3).alias("g")).count().cache()
    df.count()
    with fit_view(df) as fv:
        fv.count()
    assert df.storageLevel.useMemory
    df.unpersist()


def test_block_correlations_of_a_wide_table(spark):
    import numpy as np
    from ripen.functions.stats import fast_corr_row, safe_corr
    cols = [f"c{i}" for i in range(300)]
    df = spark.range(200).select(*[
        (F.lit(7.5) if i % 50 == 1 else F.when((F.col("id") % 11 != i % 11) | F.lit(i % 3 != 0), 1e6 + F.sin(F.col("id") * (i % 7 + 1)) * (i + 1))).alias(n)
        for i, n in enumerate(cols)])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    got = fast_corr_row(df, pairs)
    assert len(got) == len(pairs) == 44850
    few = [0, 1, 5, 299, 1000, 2500, 17000, 44849]
    want = df.agg(*[safe_corr(F.col(pairs[k][0]), F.col(pairs[k][1])).alias(f"r{k}") for k in few]).first()
    for k in few:
        a, b = got[f"r{k}"], want[f"r{k}"]
        assert (a is None) == (b is None) and (a is None or np.isclose(a, b, atol=1e-6)), (pairs[k], a, b)
