"""Work that grows with the input alone: expressions evaluated once, tasks on all cores, plans of bounded size."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from ripen.functions import quantile, scan
from ripen.functions.quantile import exact_quantiles
from ripen.functions.stats import spread
from ripen.operators import balance, eda, forest
from ripen.plans.apply import apply_plan


def test_members_of_intervals_are_grouped_not_aggregated_one_by_one(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(30_000, 2)).round(3)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in values], "a double, b double").repartition(4)
    asked = []
    answer = scan._answer

    def watched(frame, requests):
        asked.extend(r for of in requests.values() for r in of)
        return answer(frame, requests)
    monkeypatch.setattr(scan, "_answer", watched)
    probs = [i / 20 for i in range(21)]
    got = exact_quantiles(df, ["a", "b"], probs, accuracy=200)
    for column, quantiles in zip(values.T, got):
        assert np.allclose(quantiles, np.quantile(column, probs), rtol=0, atol=1e-12)
    assert sum(isinstance(r, scan.Members) for r in asked) == 2
    # one aggregate for the brackets: counts and a sketch for each column
    assert [len(r.exprs) for r in asked if isinstance(r, scan.Aggregate)] == [4]


def test_a_plan_evaluates_the_expressions_of_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(i):
        seen.add(1)
        return None if i % 7 == 0 else float(i % 50)
    df = spark.range(0, 700, 1, 2).select("id", costly("id").alias("a"), (F.col("id") % 31 + 1).cast("double").alias("b"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    plan = [("profile_dataset", None), ("check_missing", None), ("fill_missing_median", "a"), ("normalize_standard", "a"), ("log_transform", "b"),
            ("train_test_split", None), ("validate_no_leakage", None)]
    out, log = apply_plan(df, [{"type": t, "column": c} for t, c in plan], "y", "id")
    assert all(x[3] for x in log) and out.where("a is null").count() == 0 and out.count() == 700
    assert seen.value == 700


def test_few_splits_are_dealt_over_all_cores_before_costly_expressions(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/one")
    table = spark.read.parquet(f"{tmp_path}/one")
    dealt = spread(table)
    assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > table.rdd.getNumPartitions()
    assert spread(dealt.withColumn("x", F.col("id") * 2)).rdd.getNumPartitions() == dealt.rdd.getNumPartitions()
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))


def test_tree_weights_compare_digits_without_a_conversion_for_each_limit(spark):
    for limit, x in zip(forest._reached(), forest.POISSON):
        assert int(limit, 16) / 2**32 >= x > (int(limit, 16) - 1) / 2**32
    w = forest._weights(F.col("id").cast("string"), 6, 7)
    rows = spark.range(500).select("id", w.alias("w"))
    assert "conv(" not in rows._jdf.queryExecution().analyzed().toString()
    for r in rows.collect():
        digits = "".join(hashlib.md5(f"{r.id}:forest7:{k}".encode()).hexdigest() for k in range(2))
        draws = [int(digits[8 * t:8 * t + 8], 16) / 2**32 for t in range(6)]
        assert list(r.w) == [sum(x <= d for x in forest.POISSON) for d in draws]


def test_intervals_that_are_too_full_to_collect_are_cut_again_for_all_ranks_together(spark, monkeypatch):
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(size=(40_000, 2)), 4)
    values[:9000, 1] = 0.25
    df = spark.createDataFrame([(float(a), float(b)) for a, b in values], "a double, b double").repartition(4)
    probs = [i / 20 for i in range(21)]
    asked = []
    answer = scan._answer

    def watched(frame, requests):
        asked.extend(r for of in requests.values() for r in of)
        return answer(frame, requests)
    monkeypatch.setattr(scan, "_answer", watched)
    for group, cuts in ((quantile.MAX_GROUP, 0), (20, 2)):
        # far more values in an interval than the driver would take
        monkeypatch.setattr(quantile, "MAX_GROUP", group)
        asked.clear()
        targets = [(F.col(n), None, int(p * 39_999), 40_000, j) for j, n in enumerate("ab") for p in probs]
        brackets = [tuple(np.quantile(values[:, j], [max(p - 0.01, 0), min(p + 0.01, 1)], method="nearest").tolist()) for j in range(2) for p in probs]
        got = quantile.order_statistics(df, targets, max_collect=20, brackets=brackets)
        want = [np.sort(values[:, j])[int(p * 39_999)] for j in range(2) for p in probs]
        assert got == want
        assert not any(isinstance(r, scan.Aggregate) for r in asked)          # no aggregate for each rank
        assert sum(isinstance(r, scan.Cuts) for r in asked) >= cuts


def test_the_value_at_a_rank_is_picked_where_the_values_are(spark):
    rng = np.random.default_rng(6)
    values = rng.normal(size=60_000)
    df = spark.createDataFrame([(float(a),) for a in values], "a double").repartition(4)
    rows = []
    steps = quantile.order_steps([(F.col("a"), None, r, 60_000, 0) for r in (0, 29_999, 30_000, 59_999)], accuracy=100, max_collect=50)
    asked = next(steps)
    try:
        while True:
            rows.append([df.agg(*[e.alias(n) for n, e in r.exprs.items()]).first().asDict() for r in asked])
            asked = steps.send(rows[-1])
    except StopIteration as done:
        assert done.value == [np.sort(values)[r] for r in (0, 29_999, 30_000, 59_999)]
    # a sketch and a pass that verifies it: none to collect, and no list of values reaches the driver
    assert len(rows) == 2
    assert not any(isinstance(x, list) for n, x in rows[1][0].items())


def test_gains_of_a_checkpointed_table_are_measured_once(spark):
    df = spark.range(0, 4000, 1, 4).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 * 3.5).alias("leak"),
                                           (F.col("id") * 7919 % 1000 / 10).alias("x"), (F.col("id") % 9).cast("string").alias("s"))
    fixed = df.checkpoint()
    first = eda.detect_leakage(fixed, "y").collect()
    before = dict(scan.scans)
    assert eda.leaky_columns(fixed, "y") == ["leak"] and eda.detect_leakage(fixed, "y").collect() == first
    assert eda.leaky_columns(fixed, "y", known=["s"]) == ["leak", "s"]
    assert scan.scans == before
    # another target or another table has gains of its own; a table that may change is measured each time
    assert eda.leaky_columns(fixed.drop("leak"), "y") == []
    assert scan.scans != before
    before = dict(scan.scans)
    assert eda.detect_leakage(df, "y").collect() == eda.detect_leakage(df, "y").collect() == first
    assert scan.scans["aggregate"] >= before["aggregate"] + 2


def test_draws_of_synthetic_rows_are_worked_out_once_for_all_features(spark):
    df = spark.range(0, 300, 1, 3).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"),
                                          *[(F.col("id") * p % 101).cast("double").alias(f"f{p}") for p in (7, 13, 29, 31)])
    out = balance.smote(df, "y", ["f7", "f13", "f29", "f31"], "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(":lambda42") == 1 and plan.count(":nn42") == 1
    assert out.count() == 270 + 270
