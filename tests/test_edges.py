"""Edge cases: all-null and constant columns, empty input, tiny classes."""

from pyspark.sql import functions as F

from ripen.functions.quantile import exact_quantiles
from ripen.operators import balance, clean, eda
from ripen.operators.profile import column_profile


def _frame(spark):
    rows = [(i, None, 5.0, float(i % 4), "a" if i % 3 else None, i % 2) for i in range(40)]
    return spark.createDataFrame(rows, "id bigint, empty double, const double, x double, s string, t int")


def test_profile_with_null_and_constant_columns(spark):
    p = {r["name"]: r for r in column_profile(_frame(spark), "t").collect()}
    assert p["empty"]["missing_count"] == 40 and p["empty"]["mean"] is None
    assert p["const"]["skewness"] == 0.0 and p["const"]["std"] == 0.0
    assert p["const"]["correlated_with"] is None          # zero variance: no r, no error
    assert p["s"]["top_categories"] == ["a"]


def test_correlation_report_survives_zero_variance(spark):
    rows = eda.high_correlations(_frame(spark), "t").collect()
    assert all(r["col1"] != "const" and r["col2"] != "const" for r in rows)


def test_quantiles_of_empty_and_single(spark):
    df = _frame(spark)
    assert exact_quantiles(df, ["empty"], [0.5]) == [[None]]
    one = df.filter(F.col("id") == 3)
    assert exact_quantiles(one, ["x"], [0.25, 0.75]) == [[3.0, 3.0]]


def test_split_and_smote_with_tiny_classes(spark):
    rows = [(i, 1 if i == 0 else 0, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "k bigint, t int, x double")
    split = {r["k"]: r["split"] for r in balance.train_test_split(df, "t", "k").collect()}
    assert split[0] == "train" and sum(v == "test" for v in split.values()) == 2
    out = balance.smote(df, "t", ["x"], "k")
    syn = out.filter(F.col("k").contains("#s")).collect()
    assert len(syn) == 10 and all(r["x"] == 0.0 for r in syn)   # no neighbour: copies of the one row


def test_fill_mode_refuses_without_nulls(spark):
    import pytest
    with pytest.raises(ValueError):
        clean.fill_mode(_frame(spark), "const")
