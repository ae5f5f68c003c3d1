import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "top_categories" in df.columns


def test_every_query_has_a_callable_and_oracles_are_registered():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
