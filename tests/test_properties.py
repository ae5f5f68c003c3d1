"""Property tests: partition-count independence, idempotence, exactness."""

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ripen.functions.quantile import exact_quantiles
from ripen.operators import balance, clean
from ripen.sources import fixtures
from ripen.sources.dirty import labeled_documents, orders_dirty
from ripen.sources.load import table

from conftest import SF


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_split_does_not_depend_on_partitioning(spark):
    d = labeled_documents(spark, SF)
    a = balance.train_test_split(d.repartition(3), "toxic", "doc_id").select("doc_id", "split")
    b = balance.train_test_split(d.repartition(7, "lang"), "toxic", "doc_id").select("doc_id", "split")
    assert _rows(a) == _rows(b)


def test_fixture_does_not_depend_on_partitioning(spark):
    keys = table(spark, SF, "customer").select(F.col("c_custkey").alias("k"))
    a = fixtures.gen_churn(keys.repartition(2), "k")
    b = fixtures.gen_churn(keys.repartition(5), "k")
    assert _rows(a) == _rows(b)


def test_drop_duplicates_is_idempotent(spark):
    od = orders_dirty(spark, SF)
    once = clean.drop_duplicates(od)
    assert once.count() == clean.drop_duplicates(once).count() == od.distinct().count()


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=400),
       st.lists(st.floats(min_value=0, max_value=1), min_size=1, max_size=4))
def test_exact_quantiles_property(spark, values, probs):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], probs)[0]
    want = np.quantile(np.array(values, dtype=float), probs)
    assert np.allclose(got, want, rtol=0, atol=1e-9)
