"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or views Spark derives from them) at ``sf_dir``.

Every callable is ``(spark, sf_dir) -> DataFrame``.  Float outputs are
rounded to 6 digits and arrays joined with '|' so that results compare
with the DuckDB oracle in ``oracle.py`` (same column names).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .operators import eda
from .operators.profile import column_profile, profile_dataset
from .sources.dirty import labeled_documents, lineitem_dirty, orders_dirty
from .sources.load import table as load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ROUND = 6


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def joined(col: str) -> F.Column:
    """Array -> 'a|b|c' text (null stays null)."""
    return F.when(F.col(col).isNotNull(), F.concat_ws("|", col))


def rounded(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every double column (sums depend on partitioning in the last bits)."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            out.append((F.round(col, digits) + F.lit(0.0)).alias(f.name))   # -0.0 -> 0.0
        else:
            out.append(col)
    return df.select(*out)


# --------------------------------------------------------------- A sources

@query("a01_load_orders_dirty")
def a01(spark, sf):
    return rounded(orders_dirty(spark, sf))


@query("a01_load_lineitem_dirty")
def a01b(spark, sf):
    return rounded(lineitem_dirty(spark, sf))


# --------------------------------------------------------------- B / C profile

@query("b03_infer_dtype")
def b03(spark, sf):
    p = column_profile(orders_dirty(spark, sf), "y")
    return p.select("name", "dtype", "inferred_dtype")


@query("c00_column_profile")
def c00(spark, sf):
    od = orders_dirty(spark, sf)
    leaky = eda.leaky_columns(od, "y")
    p = column_profile(od, "y", leaky_cols=leaky)
    return p.withColumn("top_categories", joined("top_categories"))


@query("c00_column_profile_lineitem")
def c00b(spark, sf):
    p = column_profile(lineitem_dirty(spark, sf))
    return p.withColumn("top_categories", joined("top_categories"))


# --------------------------------------------------------------- D reports

@query("d01_profile_dataset")
def d01(spark, sf):
    return profile_dataset(orders_dirty(spark, sf))


@query("d02_detect_dtypes")
def d02(spark, sf):
    return eda.detect_dtypes(orders_dirty(spark, sf), "y")


@query("d03_check_missing")
def d03(spark, sf):
    return eda.check_missing(orders_dirty(spark, sf))


@query("d03_check_missing_lineitem")
def d03b(spark, sf):
    return eda.check_missing(lineitem_dirty(spark, sf))


@query("d04_class_balance")
def d04(spark, sf):
    return eda.class_balance(labeled_documents(spark, sf), "toxic")


@query("d04_class_balance_orders")
def d04b(spark, sf):
    return eda.class_balance(orders_dirty(spark, sf), "y")


@query("d05_detect_leakage")
def d05(spark, sf):
    return rounded(eda.detect_leakage(orders_dirty(spark, sf), "y"))


def leaks(spark, sf):
    """orders with an integer leak of a wide range and a fractional one with one huge outlier."""
    y = F.col("o_orderkey") % 10 == 0
    return load_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), y.cast("int").alias("y"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"),
        F.when(y, 1 + F.col("o_custkey") % 100).otherwise(0).alias("wide"),
        F.when(F.col("o_orderkey") == 1, 1e6).when(y, 5.0).otherwise(0.0).alias("step"))


@query("d05_detect_leakage_wide")
def d05b(spark, sf):
    return rounded(eda.detect_leakage(leaks(spark, sf), "y"))


@query("d05_detect_leakage_known")
def d05c(spark, sf):
    return rounded(eda.detect_leakage(leaks(spark, sf), "y", known=["priority"]))


@query("d06_high_correlations")
def d06(spark, sf):
    return rounded(eda.high_correlations(lineitem_dirty(spark, sf)))


@query("d06_high_correlations_orders")
def d06b(spark, sf):
    return rounded(eda.high_correlations(orders_dirty(spark, sf), "y"))


@query("d07_detect_outliers")
def d07(spark, sf):
    return rounded(eda.detect_outliers(orders_dirty(spark, sf), "y"))


@query("d07_detect_outliers_lineitem")
def d07b(spark, sf):
    return rounded(eda.detect_outliers(lineitem_dirty(spark, sf)))


@query("d08_duplicate_count")
def d08(spark, sf):
    return eda.duplicate_count(orders_dirty(spark, sf))


@query("d08_duplicate_count_part")
def d08b(spark, sf):
    from .sources.load import table
    return eda.duplicate_count(table(spark, sf, "part").select("p_name", "p_brand", "p_type", "p_size"))


# --------------------------------------------------------------- E cleaning
from .operators import clean, features  # noqa: E402
from .sources.load import table  # noqa: E402


@query("e01_fix_dtypes")
def e01(spark, sf):
    return rounded(clean.fix_dtypes(orders_dirty(spark, sf), "y"))


@query("e02_drop_duplicates")
def e02(spark, sf):
    return rounded(clean.drop_duplicates(orders_dirty(spark, sf)))


@query("e03_remove_leaky")
def e03(spark, sf):
    return rounded(clean.remove_leaky(orders_dirty(spark, sf), "y"))


@query("e03_remove_leaky_named")
def e03b(spark, sf):
    return rounded(clean.remove_leaky(orders_dirty(spark, sf), "y", "leak_days"))


@query("e09_drop_high_missing_named")
def e09b(spark, sf):
    return rounded(clean.drop_high_missing(lineitem_dirty(spark, sf), "l_tax"))


@query("e11_drop_correlated_named")
def e11b(spark, sf):
    return rounded(clean.drop_correlated(lineitem_dirty(spark, sf), col="gross"))


@query("e04_fill_median")
def e04(spark, sf):
    return rounded(clean.fill_median(orders_dirty(spark, sf), "amount", "y"))


@query("e05_fill_mode")
def e05(spark, sf):
    return rounded(clean.fill_mode(orders_dirty(spark, sf), "status", "y"))


@query("e06_fill_jitter")
def e06(spark, sf):
    return rounded(clean.fill_jitter(orders_dirty(spark, sf), "amount", key="id", seed=42, target="y"))


@query("e07_fill_constant")
def e07(spark, sf):
    return rounded(clean.fill_constant(orders_dirty(spark, sf), ["status", "amount"], target="y"))


@query("e08_clip_outliers")
def e08(spark, sf):
    return rounded(clean.clip_outliers(orders_dirty(spark, sf), "amount", "y"))


@query("e09_drop_high_missing")
def e09(spark, sf):
    return rounded(clean.drop_high_missing(lineitem_dirty(spark, sf)))


@query("e10_reduce_cardinality")
def e10(spark, sf):
    return rounded(clean.reduce_cardinality(orders_dirty(spark, sf), "city", target="y"))


@query("e11_drop_correlated")
def e11(spark, sf):
    return rounded(clean.drop_correlated(lineitem_dirty(spark, sf)))


# --------------------------------------------------------------- F features

@query("f01_encode_onehot")
def f01(spark, sf):
    return rounded(features.encode_onehot(orders_dirty(spark, sf), "status", target="y"))


@query("f01_encode_onehot_events")
def f01b(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    return rounded(features.encode_onehot(ev, "event_type"))


@query("f02_encode_label")
def f02(spark, sf):
    return rounded(features.encode_label(orders_dirty(spark, sf), "city", target="y"))


@query("f02_encode_label_part")
def f02b(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return features.encode_label(p, "p_name")


@query("f03_encode_target")
def f03(spark, sf):
    return rounded(features.encode_target(orders_dirty(spark, sf), "city", "y"))


@query("f03_encode_target_folds")
def f03b(spark, sf):
    """Out-of-fold means of the given part, and the means of all its folds on the rest."""
    od = orders_dirty(spark, sf).select("id", "city", "status", "y")
    train, test = od.where("id % 5 <> 0"), od.where("id % 5 = 0")
    train, fitted = features.encode_target_folds(train, "city", "y", "id")
    return rounded(train.unionByName(fitted.transform(test)))


@query("f04_normalize_standard")
def f04(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return rounded(features.normalize_standard(d, "n_chars"))


@query("f05_normalize_robust")
def f05(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    return rounded(features.normalize_robust(ev, "value"))


@query("f06_log_transform")
def f06(spark, sf):
    return rounded(features.log_transform(orders_dirty(spark, sf), "los_days", "y"))


@query("f07_feature_importance")
def f07(spark, sf):
    return features.feature_importance(orders_dirty(spark, sf), "y", key="id")


@query("f07_forest_splits")
def f07c(spark, sf):
    """Every split of every tree."""
    rows = features.forest_splits(orders_dirty(spark, sf), "y", "id")
    return rounded(spark.createDataFrame(rows, "tree int, node int, feature int, bin int, gain double"))


@query("f07_importance_facts")
def f07b(spark, sf):
    """What holds for any sound forest: k rows, shares within [0, 1], the two leaks lead."""
    top = features.feature_importance(orders_dirty(spark, sf), "y", key="id")
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("i"), "feature")))
    lead = F.sort_array(F.transform(F.slice(ranked, 1, 2), lambda x: x["feature"]))
    return top.agg(F.count("*").alias("n"), F.bool_and(F.col("importance").between(0, 1)).alias("in_range"),
                   F.array_join(lead, ",").alias("leaders"))


@query("f08_variance_ranking")
def f08b(spark, sf):
    v = features.variance_ranking(orders_dirty(spark, sf), "y")
    return v.withColumn("variance", F.format_string("%.6e", "variance").cast("double"))


@query("f08_select_top_k")
def f08(spark, sf):
    return rounded(features.select_top_k(orders_dirty(spark, sf), "y", k=5))


@query("f10_fit_train_transform_test")
def f10(spark, sf):
    """Fits on one part of the rows (ids not divisible by 5), applied to the rest."""
    od = clean.drop_duplicates(orders_dirty(spark, sf)).select("id", "amount", "total", "los_days", "status", "city", "y")
    train, test = od.where("id % 5 <> 0"), od.where("id % 5 = 0")
    for fit in (lambda d: clean.fit_fill_median(d, "amount", "y"), lambda d: clean.fit_clip_outliers(d, "total", "y"),
                lambda d: clean.fit_reduce_cardinality(d, "city", target="y"), lambda d: features.fit_encode_label(d, "city", "y"),
                lambda d: features.fit_encode_target(d, "status", "y"), lambda d: features.fit_normalize_standard(d, ["los_days"], "y")):
        fitted = fit(train)
        train, test = fitted.transform(train), fitted.transform(test)
    return rounded(test)


@query("f09_create_interaction")
def f09(spark, sf):
    return rounded(features.create_interaction(lineitem_dirty(spark, sf), "l_quantity", "l_extendedprice"))


# --------------------------------------------------------------- G / H
from .operators import balance, issues as iss  # noqa: E402


def orders_unique(spark, sf):
    return clean.drop_duplicates(orders_dirty(spark, sf))


@query("g01_train_test_split")
def g01(spark, sf):
    return balance.train_test_split(labeled_documents(spark, sf), "toxic", key="doc_id", frac=0.2, seed=42)


@query("g01_train_test_split_orders")
def g01b(spark, sf):
    return rounded(balance.train_test_split(orders_unique(spark, sf), "y", key="id", frac=0.2, seed=42))


@query("g02_smote")
def g02(spark, sf):
    return balance.smote(labeled_documents(spark, sf), "toxic", ["n_chars"], key="doc_id", k=5, seed=42)


@query("g02_smote_two_features")
def g02b(spark, sf):
    two = labeled_documents(spark, sf).select(
        "doc_id", "toxic", "n_chars", (F.col("doc_id") * 7919 % 1000).cast("double").alias("spread"),
        F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train").alias("split"))
    return balance.smote(two, "toxic", ["n_chars", "spread"], key="doc_id", k=5, seed=42, split_col="split")


def ties(spark, sf):
    """orders with a repeated key and a nullable target."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 40).alias("key"),
        F.when(F.col("o_orderkey") % 7 != 0, F.when(F.col("o_orderkey") % 10 == 0, "A").otherwise("B")).alias("status"))


@query("g01_train_test_split_ties")
def g01c(spark, sf):
    return balance.train_test_split(ties(spark, sf), "status", "key")


@query("g03_undersample_ties")
def g03c(spark, sf):
    return balance.undersample(ties(spark, sf), "status", "key")


@query("g03_undersample")
def g03(spark, sf):
    return balance.undersample(labeled_documents(spark, sf), "toxic", key="doc_id", seed=42)


@query("g03_undersample_orders")
def g03b(spark, sf):
    return rounded(balance.undersample(orders_unique(spark, sf), "y", key="id", seed=42))


@query("g04_validate_no_leakage")
def g04(spark, sf):
    return rounded(iss.validate_no_leakage(orders_dirty(spark, sf), "y"))


@query("g05_data_report")
def g05(spark, sf):
    return iss.data_report(orders_dirty(spark, sf), "y")


@query("g05_data_report_issues")
def g05b(spark, sf):
    od = orders_dirty(spark, sf)
    found = iss.detect_issues(od, "y", dataset="orders")
    return iss.data_report(od, "y", iss.resolve_issues(found, _fixes(found)))


@query("h06_detect_issues")
def h06(spark, sf):
    return iss.detect_issues(orders_dirty(spark, sf), "y", dataset="orders")


def _fixes(issues):
    """Fixes derived from the measured issues: every critical/high issue by
    column, and the 'outlier' type as a whole (column-free wildcard)."""
    by_col = issues.filter(F.col("severity").isin("critical", "high") & F.col("column").isNotNull()) \
        .select("issue_type", F.upper(F.col("column")).alias("column"))
    wildcard = issues.filter(F.col("issue_type") == "outlier").select(
        "issue_type", F.lit(None).cast("string").alias("column")).distinct()
    return by_col.unionByName(wildcard)


@query("h01_resolve_issues")
def h01(spark, sf):
    i = iss.detect_issues(orders_dirty(spark, sf), "y", dataset="orders")
    return iss.resolve_issues(i, _fixes(i))


@query("h03_readiness_score")
def h03(spark, sf):
    od = orders_dirty(spark, sf)
    return iss.readiness_score(od, "y", iss.detect_issues(od, "y", dataset="orders"))


@query("h04_issue_coverage")
def h04(spark, sf):
    i = iss.detect_issues(orders_dirty(spark, sf), "y", dataset="orders")
    return iss.issue_coverage(iss.resolve_issues(i, _fixes(i)))


@query("h05_weighted_coverage")
def h05(spark, sf):
    i = iss.detect_issues(orders_dirty(spark, sf), "y", dataset="orders")
    return iss.issue_coverage(iss.resolve_issues(i, _fixes(i)), weighted=True)


# --------------------------------------------------------------- A fixtures
from .sources import fixtures  # noqa: E402


@query("a03_gen_churn")
def a03(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return rounded(fixtures.gen_churn(keys, "k"))


@query("a04_gen_loan")
def a04(spark, sf):
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return rounded(fixtures.gen_loan(keys, "k"))


@query("a05_gen_medical")
def a05(spark, sf):
    keys = table(spark, sf, "part").select(F.col("p_partkey").alias("k"))
    return rounded(fixtures.gen_medical(keys, "k"))


# --------------------------------------------------------------- I plans
from .plans import actions as acts, apply as plan_apply  # noqa: E402
from .functions.rand import u01  # noqa: E402


def agent_replies(spark, sf):
    """Action replies built from ``conversations``: an action named by a
    keyed draw over all 34 names (6 of them not valid in replies), the
    speaker role as its column, after the turn's text: plain, fenced, in
    prose, single-quoted, with trailing text, or cut off, by a second draw."""
    cv = table(spark, sf, "conversations")
    key = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    names = F.array(*[F.lit(a) for a in acts.ALL_ACTIONS])
    a = F.element_at(names, (F.floor(u01(key, "act") * len(acts.ALL_ACTIONS)) + 1).cast("int"))
    js = F.concat(F.lit('{"type": "'), a, F.lit('", "column": "'), F.col("role"), F.lit('"}'))
    mode = F.floor(u01(key, "wrap") * 6)
    reply = F.concat(F.col("text"),
                     F.when(mode == 0, F.concat(F.lit(" "), js))
                     .when(mode == 1, F.concat(F.lit("\n```json\n"), js, F.lit("\n```")))
                     .when(mode == 2, F.concat(F.lit(" Next: "), js, F.lit(" Done.")))
                     .when(mode == 3, F.concat(F.lit(" "), F.replace(js, F.lit('"'), F.lit("'"))))
                     .when(mode == 4, F.concat(F.lit(" "), js, F.lit(" and {x}")))
                     .otherwise(F.concat(F.lit(' {"type": '), a)))
    return cv.select("conv_id", "turn", "role", reply.alias("reply"), a.alias("rule_type"))


@query("i02_extract_action")
def i02(spark, sf):
    r = agent_replies(spark, sf).withColumn("act", acts.extract_action(F.col("reply")))
    return r.select("conv_id", "turn", F.col("act.type").alias("action_type"),
                    F.col("act.column").alias("action_column"))


@query("i03_coalesce_action")
def i03(spark, sf):
    r = agent_replies(spark, sf)
    parsed = acts.extract_action(F.col("reply"))
    rule = F.struct(F.when(u01(F.col("conv_id"), "rule") < 0.5, F.col("rule_type"))
                    .otherwise(F.lit("profile_dataset")).alias("type"),
                    F.col("role").alias("column"), F.lit(None).cast("string").alias("column2"),
                    F.lit(None).cast("int").alias("top_k"))
    m = acts.coalesce_action(parsed, rule)
    return r.select("conv_id", "turn", m["type"].alias("action_type"), m["column"].alias("action_column"))


@query("i01_recommend")
def i01(spark, sf):
    return plan_apply.recommended_plan(orders_dirty(spark, sf), "y", "orders")


@query("i04_apply_plan_orders")
def i04(spark, sf):
    return rounded(plan_apply.run_recommended_plan(orders_dirty(spark, sf), "y", "id"))


@query("i04_apply_plan_churn")
def i04b(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    df = fixtures.gen_churn(keys, "k")
    out, _ = plan_apply.apply_plan(df, plan_apply.golden_plan("churn"), "churn", "customer_id")
    return rounded(out)


# --------------------------------------------------------------- J run log
from .plans import runlog  # noqa: E402


def events_log(spark, sf):
    return runlog.run_log(table(spark, sf, "events"))


@query("j01_action_phase")
def j01(spark, sf):
    return events_log(spark, sf).select("run_id", "step", "action_type", "phase")


@query("j02_eda_gate")
def j02(spark, sf):
    return runlog.eda_gate(events_log(spark, sf))


@query("j03_phase_progress")
def j03(spark, sf):
    return runlog.phase_progress(events_log(spark, sf))


@query("j04_rewards")
def j04(spark, sf):
    return runlog.rewards(events_log(spark, sf))


@query("j08_run_scores")
def j08(spark, sf):
    return runlog.run_scores(events_log(spark, sf))


@query("j09_task_summary")
def j09(spark, sf):
    return runlog.task_summary(runlog.run_scores(events_log(spark, sf)))


@query("a15_profile_json")
def a15(spark, sf):
    from .operators.profile import profile_json
    od = orders_dirty(spark, sf)
    return profile_json(column_profile(od, "y", leaky_cols=eda.leaky_columns(od, "y")))


# --------------------------------------------------------------- A7-A14 injection, H2, J5-J7
from .sources import inject  # noqa: E402

ACCT_EDGES = [-1000.0, 0.0, 2500.0, 5000.0, 7500.0, 10000.0]
ACCT_LABELS = ["[neg)", "[0-2500)", "[2500-5000)", "[5000-7500)", "[7500+)"]


def _orders_prices(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("a07_inject_missing")
def a07(spark, sf):
    return rounded(inject.inject_missing(_orders_prices(spark, sf), "o_orderkey", "o_totalprice", 0.15))


@query("a08_inject_duplicates")
def a08(spark, sf):
    return rounded(inject.inject_duplicates(_orders_prices(spark, sf), "o_orderkey", 0.01))


@query("a09_inject_unit")
def a09(spark, sf):
    return inject.inject_unit(_orders_prices(spark, sf), "o_totalprice", "months")


@query("a10_inject_outliers")
def a10(spark, sf):
    return rounded(inject.inject_outliers(_orders_prices(spark, sf), "o_orderkey", "o_totalprice", 0.015, -500, -10))


@query("a11_derive_map")
def a11(spark, sf):
    return inject.derive_map(table(spark, sf, "labels"), "toxic", "toxic_text", {0: "clean", 1: "toxic"})


@query("a12_derive_conditional")
def a12(spark, sf):
    return inject.derive_conditional(table(spark, sf, "labels"), "toxic", "days", "doc_id", 1, 30, "days")


@query("a13_bin_labels")
def a13(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rounded(inject.bin_labels(c, "c_acctbal", ACCT_EDGES, ACCT_LABELS, out="acct_band"))


@query("a14_shuffle_positions")
def a14b(spark, sf):
    return inject.shuffle_positions(_orders_prices(spark, sf), "o_orderkey").select("o_orderkey", "position")


@query("a14_shuffle")
def a14(spark, sf):
    return rounded(inject.shuffle(_orders_prices(spark, sf), "o_orderkey"))


@query("h02_resolve_by_type")
def h02(spark, sf):
    i = iss.detect_issues(orders_dirty(spark, sf), "y", dataset="orders")
    fixes = i.filter(F.col("severity") == "medium").select("issue_type", F.lit(None).cast("string").alias("column"))
    return iss.resolve_issues(i, fixes.distinct())


@query("j05_cumulative_reward")
def j05(spark, sf):
    return runlog.rewards(events_log(spark, sf)).select("run_id", "step", "cumulative_reward")


@query("j06_phase_order")
def j06(spark, sf):
    return runlog.run_scores(events_log(spark, sf)).select("run_id", "phase_order")


@query("j07_efficiency")
def j07(spark, sf):
    return runlog.run_scores(events_log(spark, sf)).select("run_id", "task_id", "steps", "efficiency")


def _golden(spark, sf, name, key_table, key_col):
    keys = table(spark, sf, key_table).select(F.col(key_col).alias("k"))
    gen = {"churn": fixtures.gen_churn, "loan": fixtures.gen_loan, "medical": fixtures.gen_medical}[name]
    out, _ = plan_apply.apply_plan(gen(keys, "k"), plan_apply.golden_plan(name), fixtures.TARGETS[name],
                                   fixtures.KEYS[name])
    return rounded(out)


@query("i04_apply_plan_loan")
def i04c(spark, sf):
    return _golden(spark, sf, "loan", "orders", "o_orderkey")


@query("i04_apply_plan_medical")
def i04d(spark, sf):
    return _golden(spark, sf, "medical", "part", "p_partkey")


@query("b03_infer_dtype_reference")
def b03r(spark, sf):
    """B3 in the original's mode: any text column with more than five values
    counts as numeric."""
    p = column_profile(orders_dirty(spark, sf), "y", infer_mode="reference", approx=True)
    return p.select("name", "dtype", "inferred_dtype")
