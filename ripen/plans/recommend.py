"""The rule policy as one ordered plan table.

The original asks its rules for one next action at a time.  Here every rule
is a filter + projection over the profile (one row per column) or the issue
table, the union is the whole plan, and ``seq`` orders it by phase, rule and
column position.  Both inputs are bounded by the column count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

# The report steps of a plan, in the original's order.
EDA_STEPS = ["profile_dataset", "detect_leakage", "check_missing", "detect_dtypes",
             "check_class_balance", "detect_outliers", "check_correlations", "detect_duplicates"]
ONEHOT_MAX = 15
ID_LIKE_SHARE = 0.5


def _steps(spark, phase_no: int, phase: str, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(phase_no, i, 0, phase, a, None, "fixed step") for i, a in enumerate(names)],
                                 "phase_no int, rule int, pos int, phase string, action string, "
                                 "column string, reason string")


def recommend(profile: DataFrame, issues: DataFrame, n_rows: int) -> DataFrame:
    spark = profile.sparkSession
    p = profile
    unresolved = issues.filter(~F.col("resolved"))

    def by_col(phase_no, phase, rule, cond, action, reason):
        return p.filter(cond).select(F.lit(phase_no).alias("phase_no"), F.lit(rule).alias("rule"),
                                     F.col("position").alias("pos"), F.lit(phase).alias("phase"),
                                     (action if not isinstance(action, str) else F.lit(action)).alias("action"),
                                     F.col("name").alias("column"), F.lit(reason).alias("reason"))

    def if_issue(phase_no, phase, rule, kind, action, reason):
        return (unresolved.filter(F.col("issue_type") == kind).limit(1)
                .select(F.lit(phase_no).alias("phase_no"), F.lit(rule).alias("rule"), F.lit(0).alias("pos"),
                        F.lit(phase).alias("phase"), F.lit(action).alias("action"),
                        F.lit(None).cast("string").alias("column"), F.lit(reason).alias("reason")))

    numeric = F.col("dtype") == "numeric"
    text = F.col("dtype") == "categorical"
    corr = (unresolved.filter((F.col("issue_type") == "correlation") & F.col("column").isNotNull())
            .join(F.broadcast(p.select(F.col("name").alias("column"), "position")), "column", "left")
            .select(F.lit(1).alias("phase_no"), F.lit(7).alias("rule"),
                    F.coalesce(F.col("position"), F.lit(0)).alias("pos"), F.lit("cleaning").alias("phase"),
                    F.lit("drop_correlated_col").alias("action"), "column",
                    F.lit("correlated with another column").alias("reason")))
    parts = [
        _steps(spark, 0, "eda", EDA_STEPS),
        by_col(1, "cleaning", 1, F.col("is_leaky"), "remove_leaky_col", "leaks the target"),
        if_issue(1, "cleaning", 2, "dtype", "fix_dtypes", "numbers stored as text"),
        if_issue(1, "cleaning", 3, "duplicate", "drop_duplicates", "duplicate rows"),
        by_col(1, "cleaning", 4, (F.col("missing_pct") > 0) & ~F.col("is_leaky"),
               F.when(numeric, F.lit("fill_missing_median")).otherwise(F.lit("fill_missing_mode")),
               "missing values"),
        by_col(1, "cleaning", 5, F.col("is_high_cardinality") & text, "reduce_cardinality", "high cardinality"),
        by_col(1, "cleaning", 6, F.col("has_outliers") & numeric, "clip_outliers", "fence outliers"),
        corr,
        by_col(2, "engineering", 1, F.col("is_skewed") & numeric, "log_transform", "skewed"),
        by_col(2, "engineering", 2, text & ~F.col("is_leaky") & (F.col("unique_count") < ID_LIKE_SHARE * n_rows),
               F.when(F.col("unique_count") <= ONEHOT_MAX, F.lit("encode_onehot")).otherwise(F.lit("encode_label")),
               "unencoded text"),
        by_col(2, "engineering", 3, numeric & ~F.col("is_leaky"), "normalize_standard", "scale"),
        _steps(spark, 3, "validation", ["train_test_split"]),
        if_issue(3, "validation", 1, "imbalance", "handle_imbalance_smote", "class imbalance"),
        spark.createDataFrame([(3, i + 2, 0, "validation", a, None, "fixed step") for i, a in
                               enumerate(["validate_no_leakage", "generate_data_report", "finish"])],
                              "phase_no int, rule int, pos int, phase string, action string, column string, "
                              "reason string"),
    ]
    plan = parts[0]
    for x in parts[1:]:
        plan = plan.unionByName(x)
    # the plan holds a few rows per column: an unpartitioned window is fine here
    w = W.orderBy("phase_no", "rule", "pos")
    return plan.select("phase", F.row_number().over(w).cast("bigint").alias("seq"), "action", "column", "reason")
