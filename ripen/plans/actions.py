"""Action names, phases (J1), and parsing actions out of free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# The action names of each phase, in the original's order.
PHASE_ACTIONS = {
    "eda": ["profile_dataset", "detect_dtypes", "check_missing", "check_class_balance",
            "detect_leakage", "check_correlations", "detect_outliers", "detect_duplicates"],
    "cleaning": ["fix_dtypes", "drop_duplicates", "remove_leaky_col", "fill_missing_median",
                 "fill_missing_mode", "fill_missing_knn", "fill_missing_constant", "clip_outliers",
                 "drop_high_missing_col", "reduce_cardinality", "drop_correlated_col"],
    "engineering": ["encode_onehot", "encode_label", "encode_target", "normalize_standard",
                    "normalize_robust", "log_transform", "feature_importance_rank", "select_top_k",
                    "create_interaction"],
    "validation": ["train_test_split", "handle_imbalance_smote", "handle_imbalance_undersample",
                   "validate_no_leakage", "generate_data_report", "finish"],
}
PHASE_ORDER = ["eda", "cleaning", "engineering", "validation"]
ALL_ACTIONS = [a for p in PHASE_ORDER for a in PHASE_ACTIONS[p]]

# The action names a text reply may carry (the original's
# parser accepts exactly these 28).
VALID_ACTIONS = [
    "profile_dataset", "detect_leakage", "check_missing", "detect_dtypes",
    "check_class_balance", "detect_outliers", "check_correlations", "detect_duplicates",
    "remove_leaky_col", "fill_missing_median", "fill_missing_mode", "fill_missing_knn",
    "fill_missing_constant", "fix_dtypes", "drop_duplicates", "clip_outliers",
    "reduce_cardinality", "drop_correlated_col", "encode_onehot", "encode_label",
    "normalize_standard", "normalize_robust", "log_transform", "train_test_split",
    "handle_imbalance_smote", "validate_no_leakage", "generate_data_report", "finish",
]

ACTION_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("column2", T.StringType()),
    T.StructField("top_k", T.IntegerType()),
])

FENCE_LINE = r"(?m)^[ \t]*```.*$"
BRACED = r"(?s)\{.*\}"


def phase_of(action: Column) -> Column:
    """Action -> phase; unknown -> 'done'.  A literal map (34 entries)."""
    m = F.create_map(*[x for p in PHASE_ORDER for a in PHASE_ACTIONS[p] for x in (F.lit(a), F.lit(p))])
    return F.coalesce(m[action], F.lit("done"))


def extract_action(text: Column) -> Column:
    """Drop code-fence lines, take the first '{' .. last '}', parse it as
    one strict JSON object (double quotes only, nothing after it), keep it only
    when its type is a valid action; else null.  Read as the only element of
    an array: text after the object then breaks the array's syntax."""
    body = F.regexp_extract(F.regexp_replace(text, FENCE_LINE, ""), BRACED, 0)
    items = F.from_json(F.concat(F.lit("["), F.nullif(body, F.lit("")), F.lit("]")), T.ArrayType(ACTION_SCHEMA),
                        {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    parsed = F.when(F.size(items) == 1, F.get(items, 0))
    return F.when(parsed["type"].isin(VALID_ACTIONS), parsed)


def coalesce_action(parsed: Column, rule: Column) -> Column:
    """Use the parsed action only when it names the rule's type and column."""
    same = (parsed["type"] == rule["type"]) & parsed["column"].eqNullSafe(rule["column"])
    return F.when(parsed.isNotNull() & same, parsed).otherwise(rule)


def with_extracted(df: DataFrame, text_col: str, out: str = "action") -> DataFrame:
    return df.withColumn(out, extract_action(F.col(text_col)))
