"""Shared scans, heavy hitters, fingerprints, interval quantiles, the forest and out-of-fold means."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ripen.functions import scan
from ripen.functions.fingerprint import split_repeated, with_fingerprint
from ripen.functions.quantile import exact_quantiles
from ripen.operators import clean, eda, features, forest
from ripen.plans.apply import apply_plan


def top(df, col, k):
    def steps():
        return (yield [scan.Top(F.col(col), k)])[0]
    return scan.run(df, steps())


def best(values, k):
    return [v for v, _ in sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:k]]


@pytest.mark.parametrize("name", ["skewed", "flat", "ids", "ties", "few", "nulls", "numbers"])
def test_most_frequent_values_are_exact(spark, name, monkeypatch):
    monkeypatch.setattr(scan, "TRACKED", 64)
    rng = np.random.default_rng(1)
    values = {"skewed": [f"v{int(x)}" for x in rng.zipf(1.3, 6000) % 3000], "flat": [f"v{i % 700}" for i in range(5600)], "ids": [f"id{i}" for i in range(3000)],
              "ties": ["a", "b", "c", "d"] * 50 + ["e"], "few": ["x", "y", None, "x"], "nulls": [None, None, "z"], "numbers": [int(x) for x in rng.zipf(1.5, 4000) % 500]}[name]
    df = spark.createDataFrame([(v,) for v in values], f"v {'long' if name == 'numbers' else 'string'}")
    for k in (1, 5, 21):
        assert top(df, "v", k) == best(values, k)


def test_sketch_settles_skewed_columns_and_passes_on_id_like_ones(spark, monkeypatch):
    monkeypatch.setattr(scan, "TRACKED", 64)
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("id"), F.col("id").cast("string"))).alias("skew"), F.col("id").alias("own"))
    found = scan._frequent(df, [scan.Top(F.col("skew"), 1), scan.Top(F.col("own"), 1)])
    assert found == [["hot"], None]


def test_fits_of_a_plan_share_their_scans(spark):
    rows = [(i, None if i % 7 == 0 else float(i % 50), None if i % 5 == 0 else float(i % 31), float(i % 90 + 1), "abc"[i % 3], i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, t string, y int")
    plan = [("fill_missing_median", "a"), ("fill_missing_median", "b"), ("clip_outliers", "a"), ("clip_outliers", "b"), ("log_transform", "c"),
            ("normalize_standard", "a"), ("normalize_standard", "b"), ("normalize_standard", "c"), ("encode_onehot", "t"), ("fill_missing_median", "nope")]
    before = sum(scan.scans.values())
    got, log = apply_plan(df, [{"type": t, "column": c} for t, c in plan], "y", "id")
    shared = sum(scan.scans.values()) - before
    one = df
    for t, c in plan[:-1]:
        one = {"fill_missing_median": clean.fill_median, "clip_outliers": clean.clip_outliers, "log_transform": features.log_transform,
               "normalize_standard": features.normalize_standard, "encode_onehot": features.encode_onehot}[t](one, c, target="y")
    alone = sum(scan.scans.values()) - before - shared
    assert got.columns == one.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, one.collect()))
    assert 2 * shared <= alone
    assert [x[3] for x in log] == [True] * 9 + [False] and "not found" in log[-1][4]


def test_fingerprints_that_collide_are_compared_by_content(spark):
    rows = [(1, None), (None, 1), (1, None), (2, 2), (None, None), (None, None), (3, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    prints = {tuple(r)[2:] for r in with_fingerprint(df).where("a = 1 or b = 1").collect()}
    assert len(prints) == 1                                        # a hash skips nulls
    own, shared = split_repeated(df)
    assert own.count() == 2 and shared.count() == 5
    assert eda.duplicate_count(df).first()[0] == 2
    assert Counter(map(tuple, clean.drop_duplicates(df).collect())) == Counter(set(rows))
    assert eda.duplicate_count(df.limit(0)).first()[0] == 0 and clean.drop_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["even", "hot", "one"])
def test_many_quantiles_from_counted_intervals(spark, kind):
    x = {"even": np.random.default_rng(2).normal(size=30_000), "hot": np.where(np.arange(30_000) % 3 == 0, 5.0, np.arange(30_000) % 7919 / 7.0), "one": np.full(30_000, 2.5)}[kind]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [i / 20 for i in range(21)]
    assert np.allclose(exact_quantiles(df, ["x"], probs)[0], np.quantile(x, probs), rtol=0, atol=0)


def test_forest_depends_on_data_and_seed_alone(spark):
    rows = [(i, i % 10 == 0, (i * 37) % 101, "xyz"[i % 3], float(i % 10 == 0) * 5 + i % 3 / 10) for i in range(400)]
    df = spark.createDataFrame([(i, int(y), a, t, leak) for i, y, a, t, leak in rows], "id long, y int, a int, t string, leak double")
    got = features.forest_splits(df, "y", "id", trees=6, depth=3)
    assert got == features.forest_splits(df.repartition(7, "a"), "y", "id", trees=6, depth=3)
    assert got and got != features.forest_splits(df, "y", "id", trees=6, depth=3, seed=1)
    assert features.feature_importance(df, "y", k=1, key="id").first()["feature"] == "leak"
    many = df.withColumn("y", F.col("id") % 37)                     # any number of classes
    assert features.forest_splits(many, "y", "id", trees=2, depth=2)
    assert features.feature_importance(df.withColumn("y", F.lit(1)), "y", key="id").agg(F.sum("importance")).first()[0] == 0


def test_forest_of_a_tiny_table_equals_an_exhaustive_search(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 3)), float(rng.integers(0, 6)), float(rng.integers(0, 9))) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y int, p double, q double")
    splits = {(t, n): (f, b, g) for t, n, f, b, g in forest.grow(df.withColumn("k", F.col("id").cast("string")), ["p", "q"], "y", "k", trees=4, depth=1)}
    weights = df.select("id", forest._weights(F.col("id").cast("string"), 4, forest.SEED).alias("w")).collect()
    w = {r["id"]: r["w"] for r in weights}
    for t in range(4):
        options = []
        for f in forest.candidates(t, 1, 2, forest.SEED):
            x = np.array([r[2 + f] for r in rows])
            edges = sorted(set(np.quantile(x, [i / forest.BINS for i in range(1, forest.BINS)])))
            for b, e in enumerate(edges):
                sides = [Counter(), Counter()]
                for r, v in zip(rows, x):
                    sides[int(v > e)][r[1]] += w[r[0]][t]
                n = [sum(s.values()) for s in sides]
                if all(n):
                    whole = sides[0] + sides[1]
                    gain = sum(sum(k * k for k in s.values()) / m for s, m in zip(sides, n)) - sum(k * k for k in whole.values()) / sum(n)
                    options.append((-gain, f, b))
        g, f, b = min(options)
        assert splits[t, 1][:2] == (f, b) and abs(splits[t, 1][2] + g) < 1e-9


def test_a_row_never_sees_its_own_target(spark):
    rows = [(i, "abcd"[i % 4] if i else "only", i % 3 % 2) for i in range(200)]
    make = lambda rows: spark.createDataFrame(rows, "id long, t string, y int")
    got = {r["id"]: r["t"] for r in features.encode_target_folds(make(rows), "t", "y", "id")[0].collect()}
    flipped = [(i, t, 1 - y if i == 17 else y) for i, t, y in rows]
    other = {r["id"]: r["t"] for r in features.encode_target_folds(make(flipped), "t", "y", "id")[0].collect()}
    assert got[17] == other[17] and got != other
    assert 0 < got[0] < 1                                           # a level of one row: the other folds' mean
    with pytest.raises(ValueError):
        features.encode_target_folds(make(rows).withColumn("y", F.lit(None).cast("int")), "t", "y", "id")
