import math

import pytest
from pyspark.sql import functions as F

from ripen.operators import balance, clean, eda, features, issues
from ripen.operators.profile import column_profile
from ripen.plans import actions
from ripen.sources.dirty import labeled_documents, orders_dirty
from ripen.sources.load import table

from conftest import SF


@pytest.fixture(scope="module")
def od(spark):
    return orders_dirty(spark, SF).cache()


def test_profile_flags(od):
    p = {r["name"]: r for r in column_profile(od, "y").collect()}
    assert "y" not in p
    assert p["city"]["is_high_cardinality"] and p["tenure"]["inferred_dtype"] == "numeric"
    assert p["city"]["inferred_dtype"] == "categorical"
    assert p["total"]["correlated_with"] == "total2"
    assert p["amount"]["missing_count"] > 0 and p["los_days"]["is_skewed"]


def test_leakage_found(od):
    assert set(eda.leaky_columns(od, "y")) == {"leak_label", "leak_days"}


def test_guards(spark, od):
    with pytest.raises(ValueError):
        clean.fill_median(od, "total", "y")          # no nulls
    with pytest.raises(ValueError):
        clean.fill_median(od, "status", "y")         # not numeric
    with pytest.raises(ValueError):
        clean.fill_median(od, "y", "y")              # target
    cust = table(spark, SF, "customer")
    with pytest.raises(ValueError):
        features.log_transform(cust, "c_acctbal")    # negatives
    with pytest.raises(ValueError):
        features.encode_onehot(od, "city", target="y")  # > 20 levels


def test_clip_is_idempotent(od):
    once = clean.clip_outliers(od, "amount", "y")
    twice = clean.clip_outliers(once, "amount", "y")
    a = sorted(r[0] for r in once.select("amount").collect() if r[0] is not None)
    b = sorted(r[0] for r in twice.select("amount").collect() if r[0] is not None)
    assert a == b


def test_fix_dtypes_then_nothing_to_do(od):
    fixed = clean.fix_dtypes(od, "y")
    assert dict(fixed.dtypes)["tenure"] == "double" and dict(fixed.dtypes)["city"] == "string"
    with pytest.raises(ValueError):
        clean.fix_dtypes(fixed, "y")


def test_reduce_cardinality_keeps_ten(od):
    out = clean.reduce_cardinality(od, "city", target="y")
    assert out.select("city").distinct().count() == 11


def test_split_counts_are_exact(spark):
    d = labeled_documents(spark, SF)
    out = balance.train_test_split(d, "toxic", "doc_id")
    got = {(r["toxic"], r["split"]): r["count"] for r in out.groupBy("toxic", "split").count().collect()}
    for cls, n in {r["toxic"]: r["count"] for r in d.groupBy("toxic").count().collect()}.items():
        assert got.get((cls, "test"), 0) == math.floor(0.2 * n)


def test_undersample_balances(spark):
    d = labeled_documents(spark, SF)
    out = balance.undersample(d, "toxic", "doc_id")
    counts = [r["count"] for r in out.groupBy("toxic").count().collect()]
    assert len(set(counts)) == 1


def test_smote_balances_and_interpolates(spark):
    d = labeled_documents(spark, SF)
    out = balance.smote(d, "toxic", ["n_chars"], "doc_id")
    counts = [r["count"] for r in out.groupBy("toxic").count().collect()]
    assert len(set(counts)) == 1
    mn = d.filter("toxic = 1").agg(F.min("n_chars"), F.max("n_chars")).first()
    syn = out.filter(F.col("doc_id").contains("#s"))
    r = syn.agg(F.min("n_chars"), F.max("n_chars")).first()
    assert r[0] >= mn[0] and r[1] <= mn[1]


def test_resolve_by_column_and_type(spark):
    iss = spark.createDataFrame([("d", "1", "missing", "Age ", "high", "", "", False),
                                 ("d", "2", "outlier", "x", "low", "", "", False),
                                 ("d", "3", "missing", "b", "low", "", "", False)], issues.ISSUE_SCHEMA)
    fixes = spark.createDataFrame([("missing", "age"), ("outlier", None)], "issue_type string, column string")
    got = {r["issue_id"]: r["resolved"] for r in issues.resolve_issues(iss, fixes).collect()}
    assert got == {"1": True, "2": True, "3": False}


def test_extract_action(spark):
    rows = [("```json\n{\"type\": \"fix_dtypes\"}\n```",), ("x {\"type\": \"select_top_k\"}",),
            ("no braces",), ("{\"type\": \"encode_label\", \"column\": \"c\"} tail",), ("{bad",)]
    df = spark.createDataFrame(rows, "t string").select(actions.extract_action(F.col("t")).alias("a"))
    got = [r["a"]["type"] if r["a"] else None for r in df.collect()]
    assert got == ["fix_dtypes", None, None, "encode_label", None]


def test_smote_against_brute_force_neighbours(spark):
    """Each synthetic value lies between its source and one of the source's
    k nearest minority neighbours (1-D: exact), found here by brute force."""
    rows = [(i, 1 if i % 7 == 0 else 0, float((i * 37) % 101)) for i in range(300)]
    df = spark.createDataFrame(rows, "k bigint, t int, x double")
    out = balance.smote(df, "t", ["x"], "k", k=3)
    minority = sorted(((r[0], r[2]) for r in rows if r[1] == 1), key=lambda p: (p[1], p[0]))
    xs = {str(k): x for k, x in minority}
    syn = [(r["k"], r["x"]) for r in out.filter(F.col("k").contains("#s")).collect()]
    assert len(syn) == sum(1 for r in rows if r[1] == 0) - len(minority)
    for key, v in syn:
        src = key.split("#s")[0]
        x = xs[src]
        others = sorted((abs(x2 - x), x2) for k2, x2 in minority if str(k2) != src)
        radius = others[2][0] if len(others) >= 3 else others[-1][0]
        near = [x2 for d, x2 in others if d <= radius]
        assert any(min(x, n) - 1e-9 <= v <= max(x, n) + 1e-9 for n in near), (key, v, x)


def test_profile_json_is_ordered(spark, od):
    import json
    from ripen.operators.profile import profile_json
    js = json.loads(profile_json(column_profile(od, "y")).first()[0])
    assert [d["position"] for d in js] == list(range(len(js)))


def test_leakage_skips_id_like_text_before_the_shuffle(spark):
    cust = table(spark, SF, "customer").select("c_name", "c_mktsegment", "c_acctbal",
                                                (F.col("c_custkey") % 2).alias("t"))
    names = {r["name"] for r in eda.detect_leakage(cust, "t").collect()}
    assert "c_name" not in names and {"c_mktsegment", "c_acctbal"} <= names


def test_label_codes_rank_the_levels(od):
    import ripen.operators.features as feat
    rows = od.select("id", "city").collect()
    levels = sorted({r["city"] if r["city"] is not None else "missing" for r in rows})
    want = sorted((r["id"], levels.index(r["city"] if r["city"] is not None else "missing")) for r in rows)
    got = sorted(tuple(r) for r in feat.encode_label(od, "city", target="y").select("id", "city").collect())
    assert got == want
    enc = feat.encoded_features(od.select("id", "city", "y").where("city is not null"), "y")
    assert enc.select("city").distinct().count() == len([x for x in levels if x != "missing"])


@pytest.mark.parametrize("high", [63, 64, 100, 5000])
def test_integer_leaks_of_any_range_are_found(spark, high):
    df = spark.range(20000).select((F.col("id") % 10 == 0).cast("int").alias("y"), F.col("id"),
                                   F.when(F.col("id") % 10 == 0, 1 + F.col("id") % high).otherwise(0).alias("leak"))
    assert eda.leaky_columns(df, "y") == ["leak"]


def test_fractional_leak_survives_an_outlier_and_noise_is_clean(spark):
    df = spark.range(5000).select((F.col("id") % 5 == 0).cast("int").alias("y"),
                                  F.when(F.col("id") == 1, 1e6).when(F.col("id") % 5 == 0, 5.0).otherwise(0.0).alias("leak"),
                                  (F.col("id") * 7919 % 4999 / 7.0).alias("noise"), F.lit(None).cast("double").alias("none"))
    got = {r["name"]: r for r in eda.detect_leakage(df, "y").collect()}
    assert got["leak"]["is_leaky"] and not got["noise"]["is_leaky"] and "none" not in got
    assert eda.leaky_columns(df, "y", known=["noise"]) == ["leak", "noise"]


def test_smote_never_fills_the_gap_between_clusters(spark):
    # two tight, far-apart minority clusters on an anti-diagonal: the sum of the features is the same
    rows = [(i, 0, float(i % 37), float(i % 41)) for i in range(400)]
    rows += [(1000 + i, 1, 0.0 + i % 6 * 0.01, 100.0 - i % 5 * 0.01) for i in range(20)]
    rows += [(2000 + i, 1, 100.0 - i % 6 * 0.01, 0.0 + i % 5 * 0.01) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    new = balance.smote(df, "y", ["a", "b"], "id").where("y = 1").collect()
    assert len(new) == 400
    assert all(abs(r["a"] - r["b"]) > 99 for r in new)


def test_smote_leaves_the_test_part_alone(spark):
    df = spark.range(600).select(F.col("id"), (F.col("id") % 8 == 0).cast("int").alias("y"), (F.col("id") * 31 % 97).cast("double").alias("a"),
                                 F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split"))
    out = balance.smote(df, "y", ["a"], "id", split_col="split")
    assert out.where("split = 'test'").count() == df.where("split = 'test'").count()
    n = {r["y"]: r["count"] for r in out.where("split = 'train'").groupBy("y").count().collect()}
    assert n[0] == n[1]


def test_exact_selection_on_a_repeated_key_and_equal_rows(spark):
    from ripen.sources import inject
    df = spark.range(300).select((F.col("id") % 4).alias("k"), (F.col("id") % 7).alias("v"))       # many equal rows
    for frac in (0.1, 0.33, 0.5):
        assert inject.inject_duplicates(df, "k", frac).count() == 300 + int(300 * frac)
        assert inject.inject_missing(df, "k", "v", frac).where("v is null").count() == int(300 * frac)


def test_action_text_must_be_one_strict_json_object(spark):
    from ripen.plans import actions
    texts = [('{"type": "finish"}', "finish"), ("{'type': 'finish'}", None), ('{"type":"finish"} and {x}', None), ('{"type":"finish"},{"type":"finish"}', None),
             ('x {"type":"finish"} y', "finish"), ('{"type":"nothing"}', None), ("", None), (None, None)]
    df = spark.createDataFrame(texts, "t string, want string").select("want", actions.extract_action(F.col("t"))["type"].alias("got"))
    assert df.where("not (want <=> got)").count() == 0


def test_recheck_marks_what_a_plan_mended(od):
    from ripen.operators import clean
    from ripen.plans.apply import recheck
    before = od.select("amount", "status", "city", "y")
    got = {r["issue_id"]: r["resolved"] for r in recheck(before, clean.drop_duplicates(clean.fill_mode(before, "status", "y")), "y").collect()}
    assert got["missing_status"] and not got["missing_amount"]


def test_shuffle_join_path_equals_broadcast_path(od, monkeypatch):
    import ripen.functions.lookup as lk
    import ripen.operators.features as feat
    import ripen.operators.fitted as fitted
    want = sorted(tuple(r) for r in feat.encode_target(od, "city", "y").select("id", "city").collect())
    orig = lk.lookup_join
    monkeypatch.setattr(fitted, "lookup_join", lambda df, t, on, how="left": orig(df, t, on, how, max_bytes=0))
    spark = od.sparkSession
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        out = feat.encode_target(od, "city", "y")
        rows = sorted(tuple(r) for r in out.select("id", "city").collect())
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert rows == want


def test_approx_plan_matches_exact_plan_here(spark, od):
    from ripen.plans import apply as P
    exact = [(r["action"], r["column"]) for r in P.recommended_plan(od, "y").orderBy("seq").collect()]
    approx = [(r["action"], r["column"]) for r in P.recommended_plan(od, "y", approx=True).orderBy("seq").collect()]
    assert approx == exact


def test_feature_importance_ranks_the_leaks_first(od):
    top = [r["feature"] for r in features.feature_importance(od, "y", k=5).collect()]
    assert set(top[:2]) == {"leak_label", "leak_days"}
