"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code path: plain SQL over the driver's
tables (pre-registered as views) and the dirty views of ``sources.dirty``.
Generated from the known schemas of those views, so each query reads as the
textbook SQL of its rule.
"""

from __future__ import annotations

import math

from .sources.dirty import LABELED_DOCUMENTS_SQL, LINEITEM_DIRTY_SQL, ORDERS_DIRTY_SQL, sql_hash52, sql_u

ORACLE: dict[str, str] = {}

NUMERIC = {"bigint", "int", "double", "float", "smallint", "tinyint"}
OD_COLS = [("id", "bigint"), ("amount", "double"), ("total", "double"), ("total2", "double"),
           ("status", "string"), ("priority", "string"), ("tenure", "string"),
           ("city", "string"), ("los_days", "double"), ("y", "int"),
           ("leak_label", "string"), ("leak_days", "bigint")]
LD_COLS = [("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
           ("l_tax", "double"), ("gross", "double")]
WIDTH = {"bigint": 8, "int": 4, "double": 8, "float": 4, "boolean": 1}


def oracle(name: str, sql: str):
    ORACLE[name] = sql.strip()


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(x.strip() for x in ctes) + "\n"


OD = ORDERS_DIRTY_SQL
LD = LINEITEM_DIRTY_SQL
LDOC = LABELED_DOCUMENTS_SQL


def r6(x: str) -> str:
    return f"round({x}, 6)"


def num_text(n: str) -> str:
    return rf"regexp_matches({n}, '^\[?\d')"


def inferred_sql(n: str, t: str) -> str:
    if t in NUMERIC or t == "boolean":
        return "'numeric'"
    if t == "timestamp":
        return "'datetime'"
    return (f"CASE WHEN count({n}) > 0 AND count(*) FILTER (WHERE {num_text(n)}) >= 0.7 * count({n}) "
            f"THEN 'numeric' ELSE 'categorical' END")


# ----------------------------------------------------------------- D5 leakage

def leakage_ctes(view: str, cols, target: str, known=()) -> list[str]:
    """Purity by value, fractional columns by quantile buckets (a quantile found twice is a bucket of its own)."""
    feats = [(n, t) for n, t in cols if n != target]
    fractional = [n for n, t in feats if t in ("double", "float")]
    probs = ", ".join(str(i / 20) for i in range(21))
    cuts = ", ".join(f"quantile_cont({n}, [{probs}]) AS q_{n}" for n in fractional) or "1 AS one"
    parts = []
    for n, t in feats:
        value = f"CAST({n} AS VARCHAR)"
        if n in fractional:
            at = f"CAST(len(list_filter(list_distinct(q_{n}), lambda e: e < {n})) AS VARCHAR)"
            value = (f"CASE WHEN {n} IS NOT NULL THEN CASE WHEN len(list_filter(q_{n}, lambda e: e = {n})) > 1 "
                     f"THEN '=' ELSE '' END || {at} END")
        parts.append(f"SELECT '{n}' AS name, {value} AS value, {target} AS t FROM lk_base, lk_cuts")
    by_value = ", ".join(f"'{n}'" for n, _ in feats if n not in fractional) or "NULL"
    named = ", ".join(f"'{n}'" for n in known) or "''"
    return [
        f"lk_base AS (SELECT * FROM {view} WHERE {target} IS NOT NULL)",
        f"lk_cuts AS (SELECT {cuts} FROM lk_base)",
        "lk_long AS (" + " UNION ALL ".join(parts) + ")",
        "lk_pv AS (SELECT name, value, max(k) AS mx FROM "
        "(SELECT name, value, t, count(*) AS k FROM lk_long GROUP BY name, value, t) GROUP BY name, value)",
        "lk_n AS (SELECT m.n AS n, max(g.c) AS mx FROM "
        f"(SELECT {target}, count(*) AS c FROM lk_base GROUP BY {target}) g, "
        "(SELECT count(*) AS n FROM lk_base) m GROUP BY m.n)",
        "lk_pn AS (SELECT name, sum(mx)::DOUBLE / (SELECT n FROM lk_n) AS purity, count(value) AS n_distinct "
        "FROM lk_pv GROUP BY name)",
        "detect_leakage AS (SELECT name, purity, (mx::DOUBLE / n) AS base_rate, "
        "(purity - mx::DOUBLE / n) / (1.0 - mx::DOUBLE / n) AS gain, "
        f"((purity - mx::DOUBLE / n) / (1.0 - mx::DOUBLE / n) >= 0.99 OR name IN ({named})) AS is_leaky "
        f"FROM lk_pn, lk_n WHERE n_distinct > 0 AND NOT (name IN ({by_value}) AND n_distinct > 0.5 * n))",
    ]


# ----------------------------------------------------------------- C profile

def profile_ctes(view: str, cols, target: str | None, leak: bool) -> tuple[list[str], str]:
    feats = [(n, t) for n, t in cols if n != target]
    pos = {n: i for i, (n, _) in enumerate(feats)}
    stat = [n for n, t in feats if t in NUMERIC]
    corrc = [n for n, t in feats if t in NUMERIC or t == "boolean"]
    text = [n for n, t in feats if t == "string"]
    ctes = []
    if stat:
        ctes.append("pq AS (SELECT " + ", ".join(
            f"quantile_cont({n}, 0.25) AS q1_{n}, quantile_cont({n}, 0.75) AS q3_{n}" for n in stat)
            + f" FROM {view})")
    else:
        ctes.append("pq AS (SELECT 1 AS one)")
    if text:
        union = " UNION ALL ".join(f"SELECT '{n}' AS name, {n} AS value FROM {view}" for n in text)
        ctes.append(f"pc AS (SELECT name, value, count(*) AS cnt FROM ({union}) u GROUP BY name, value)")
        ctes.append("pt AS (SELECT name, string_agg(value, '|' ORDER BY cnt DESC, value) AS top FROM "
                    "(SELECT name, value, cnt, row_number() OVER (PARTITION BY name ORDER BY cnt DESC, value) AS rk "
                    "FROM pc WHERE value IS NOT NULL) r WHERE rk <= 5 GROUP BY name)")
    else:
        ctes.append("pt AS (SELECT NULL::VARCHAR AS name, NULL::VARCHAR AS top)")
    pairs = [(a, b) for i, a in enumerate(corrc) for b in corrc[i + 1:]]
    if pairs:
        ctes.append("pr AS (" + " UNION ALL ".join(
            f"SELECT '{a}' AS c1, '{b}' AS c2, {pos[a]} AS p1, {pos[b]} AS p2, corr({a}, {b}) AS r FROM {view}"
            for a, b in pairs) + ")")
        ctes.append("pp AS (SELECT c, arg_max(partner, ppos) AS partner FROM ("
                    "SELECT c1 AS c, c2 AS partner, p2 AS ppos FROM pr WHERE NOT isnan(r) AND abs(r) > 0.85 "
                    "UNION ALL SELECT c2, c1, p1 FROM pr WHERE NOT isnan(r) AND abs(r) > 0.85) x GROUP BY c)")
    else:
        ctes.append("pp AS (SELECT NULL::VARCHAR AS c, NULL::VARCHAR AS partner)")
    rows = []
    for n, t in feats:
        dtype = "'numeric'" if (t in NUMERIC or t == "boolean") else "'categorical'"
        leaky = (f"'{n}' IN (SELECT name FROM detect_leakage WHERE is_leaky)" if leak else "false")
        if n in stat:
            enough = f"count({n}) > 10"
            skew = f"round(CASE WHEN isnan(skewness({n})) THEN 0 ELSE coalesce(skewness({n}), 0) END, 3)"
            fence = (f"count(*) FILTER (WHERE {n} < q1_{n} - 1.5 * (q3_{n} - q1_{n}) "
                     f"OR {n} > q3_{n} + 1.5 * (q3_{n} - q1_{n})) > 5")
            mean = f"CASE WHEN {enough} THEN round(avg({n}), 3) END"
            std = f"CASE WHEN {enough} THEN round(stddev_samp({n}), 3) END"
            skew_v = f"CASE WHEN {enough} THEN {skew} END"
            is_sk = f"coalesce({enough} AND abs({skew}) > 1.0, false)"
            has_o = f"coalesce({enough} AND {fence}, false)"
        else:
            mean = std = skew_v = "NULL::DOUBLE"
            is_sk = has_o = "false"
        hc = f"count(DISTINCT {n}) > 50" if t == "string" else "false"
        top = f"(SELECT top FROM pt WHERE pt.name = '{n}')" if t == "string" else "NULL::VARCHAR"
        rows.append(
            f"SELECT {pos[n]} AS position, '{n}' AS name, {dtype} AS dtype, {inferred_sql(n, t)} AS inferred_dtype, "
            f"count(*) FILTER (WHERE {n} IS NULL) AS missing_count, "
            f"round(count(*) FILTER (WHERE {n} IS NULL) / count(*), 3) AS missing_pct, "
            f"count(DISTINCT {n}) AS unique_count, {leaky} AS is_leaky, {hc} AS is_high_cardinality, "
            f"{is_sk} AS is_skewed, {has_o} AS has_outliers, "
            f"(SELECT partner FROM pp WHERE pp.c = '{n}') AS correlated_with, "
            f"{mean} AS mean, {std} AS std, {skew_v} AS skewness, {top} AS top_categories "
            f"FROM {view}, pq GROUP BY ALL")
    body = "\nUNION ALL ".join(rows)
    return ctes, body


def _profile(view_sql, view, cols, target, leak):
    ctes, body = profile_ctes(view, cols, target, leak)
    extra = leakage_ctes(view, cols, target) if leak else []
    return with_(*view_sql, *extra, *ctes) + body


oracle("a01_load_orders_dirty",
       with_(OD) + "SELECT id, " + ", ".join(
           (r6(n) + f" AS {n}") if t == "double" else n for n, t in OD_COLS[1:]) + " FROM orders_dirty")
oracle("a01_load_lineitem_dirty",
       with_(LD) + "SELECT " + ", ".join(r6(n) + f" AS {n}" for n, _ in LD_COLS) + " FROM lineitem_dirty")

oracle("c00_column_profile", _profile([OD], "orders_dirty", OD_COLS, "y", True))
oracle("c00_column_profile_lineitem", _profile([LD], "lineitem_dirty", LD_COLS, None, False))
oracle("b03_infer_dtype",
       with_(OD) + "\nUNION ALL ".join(
           f"SELECT '{n}' AS name, {'%s' % (chr(39) + ('numeric' if t in NUMERIC else 'categorical') + chr(39))} AS dtype, "
           f"{inferred_sql(n, t)} AS inferred_dtype" + (" FROM orders_dirty" if t == "string" else "")
           for n, t in OD_COLS if n != "y"))

# ----------------------------------------------------------------- D reports


def _d01(view_sql, view, cols):
    fixed = sum(WIDTH[t] for _, t in cols if t in WIDTH)
    var = [n for n, t in cols if t not in WIDTH]
    kinds: dict = {}
    for _, t in cols:
        kinds[t] = kinds.get(t, 0) + 1
    dc = ",".join(f"{k}:{v}" for k, v in sorted(kinds.items()))
    varsum = " + ".join(f"coalesce(sum(strlen({n})), 0)" for n in var) or "0"
    return (with_(*view_sql) + f"SELECT count(*) AS n_rows, CAST({len(cols)} AS BIGINT) AS n_cols, "
            f"CAST(count(*) * {fixed} + {varsum} AS BIGINT) AS est_bytes, '{dc}' AS dtype_counts FROM {view}")


oracle("d01_profile_dataset", _d01([OD], "orders_dirty", OD_COLS))
oracle("d02_detect_dtypes", with_(OD) + "\nUNION ALL ".join(
    f"SELECT '{n}' AS name FROM orders_dirty HAVING count({n}) > 0 AND "
    f"count(*) FILTER (WHERE {num_text(n)}) >= 0.7 * count({n})"
    for n, t in OD_COLS if t == "string" and n != "y"))


def _d03(view_sql, view, cols):
    return with_(*view_sql) + "\nUNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) FILTER (WHERE {n} IS NULL) AS missing_count, "
        f"round(100.0::DOUBLE * count(*) FILTER (WHERE {n} IS NULL) / count(*), 1) AS missing_pct "
        f"FROM {view} HAVING count(*) FILTER (WHERE {n} IS NULL) > 0" for n, _ in cols)


oracle("d03_check_missing", _d03([OD], "orders_dirty", OD_COLS))
oracle("d03_check_missing_lineitem", _d03([LD], "lineitem_dirty", LD_COLS))


def _d04(view_sql, view, target):
    return (with_(*view_sql) + f"SELECT {target} AS value, count(*) AS n, "
            f"round(max(count(*)) OVER () / greatest(min(count(*)) OVER (), 1), 1) AS ratio "
            f"FROM {view} WHERE {target} IS NOT NULL GROUP BY {target}")


oracle("d04_class_balance", _d04([LDOC], "labeled_documents", "toxic"))
oracle("d04_class_balance_orders", _d04([OD], "orders_dirty", "y"))
oracle("d05_detect_leakage", with_(OD, *leakage_ctes("orders_dirty", OD_COLS, "y")) +
       "SELECT name, round(purity, 6) AS purity, round(base_rate, 6) AS base_rate, "
       "round(gain, 6) AS gain, is_leaky FROM detect_leakage")


# an integer leak of a wide range, and a fractional one with one huge outlier
LEAKS_SQL = """leaks AS (SELECT o_orderkey AS id, CAST(o_orderkey % 10 = 0 AS INTEGER) AS y, o_totalprice AS price, o_orderpriority AS priority,
    CASE WHEN o_orderkey % 10 = 0 THEN 1 + o_custkey % 100 ELSE 0 END AS wide,
    CASE WHEN o_orderkey = 1 THEN 1e6 WHEN o_orderkey % 10 = 0 THEN 5.0 ELSE 0.0 END AS step FROM orders)"""
LEAKS_COLS = [("id", "bigint"), ("y", "int"), ("price", "double"), ("priority", "string"), ("wide", "bigint"), ("step", "double")]
for _name, _known in (("d05_detect_leakage_wide", ()), ("d05_detect_leakage_known", ("priority",))):
    oracle(_name, with_(LEAKS_SQL, *leakage_ctes("leaks", LEAKS_COLS, "y", _known)) +
           "SELECT name, round(purity, 6) AS purity, round(base_rate, 6) AS base_rate, round(gain, 6) AS gain, is_leaky FROM detect_leakage")


def _d06(view_sql, view, cols, target):
    nums = [n for n, t in cols if t in NUMERIC and n != target]
    pairs = [(a, b) for i, a in enumerate(nums) for b in nums[i + 1:]]
    union = " UNION ALL ".join(f"SELECT '{a}' AS col1, '{b}' AS col2, corr({a}, {b}) AS r FROM {view}"
                               for a, b in pairs)
    return (with_(*view_sql) + f"SELECT col1, col2, round(abs(r), 6) AS abs_corr FROM ({union}) x "
            "WHERE NOT isnan(r) AND abs(r) > 0.85")


oracle("d06_high_correlations", _d06([LD], "lineitem_dirty", LD_COLS, None))
oracle("d06_high_correlations_orders", _d06([OD], "orders_dirty", OD_COLS, "y"))


def _d07(view_sql, view, cols, target):
    nums = [n for n, t in cols if t in NUMERIC and n != target]
    parts = []
    for n in nums:
        parts.append(
            f"SELECT '{n}' AS name, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper, "
            f"(SELECT count(*) FROM {view} WHERE {n} < q1 - 1.5 * (q3 - q1) OR {n} > q3 + 1.5 * (q3 - q1)) AS n_outliers "
            f"FROM (SELECT quantile_cont({n}, 0.25) AS q1, quantile_cont({n}, 0.75) AS q3, count({n}) AS c FROM {view}) s "
            f"WHERE c >= 10")
    return (with_(*view_sql) + "SELECT name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower, "
            "round(upper, 6) AS upper, n_outliers FROM (" + " UNION ALL ".join(parts) + ") x WHERE n_outliers > 5")


oracle("d07_detect_outliers", _d07([OD], "orders_dirty", OD_COLS, "y"))
oracle("d07_detect_outliers_lineitem", _d07([LD], "lineitem_dirty", LD_COLS, None))
oracle("d08_duplicate_count",
       with_(OD) + "SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS n_duplicates FROM "
       "(SELECT count(*) AS k FROM orders_dirty GROUP BY " + ", ".join(n for n, _ in OD_COLS) + ") g")
oracle("d08_duplicate_count_part", "SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS n_duplicates FROM "
       "(SELECT count(*) AS k FROM part GROUP BY p_name, p_brand, p_type, p_size) g")


# ----------------------------------------------------------------- E cleaning

def sel(cols, repl: dict | None = None, drop=(), extra=()) -> str:
    """Projection of a view's columns: doubles rounded, some replaced."""
    repl = repl or {}
    out = []
    for n, t in cols:
        if n in drop:
            continue
        if n in repl:
            e, rt = repl[n]
            out.append(f"{r6(e) if rt == 'double' else e} AS {n}")
        else:
            out.append(f"{r6(n) if t == 'double' else n} AS {n}")
    out += list(extra)
    return ", ".join(out)


def num_extract(n: str) -> str:
    return rf"TRY_CAST(NULLIF(regexp_extract({n}, '(\d+\.?\d*)', 1), '') AS DOUBLE)"


MED_AMOUNT = "(SELECT quantile_cont(amount, 0.5) FROM orders_dirty)"

oracle("e01_fix_dtypes", with_(OD) + "SELECT " + sel(OD_COLS, {
    "priority": (num_extract("priority"), "double"), "tenure": (num_extract("tenure"), "double")})
    + " FROM orders_dirty")
oracle("e02_drop_duplicates", with_(OD) + "SELECT DISTINCT " + sel(OD_COLS) + " FROM orders_dirty")
oracle("e03_remove_leaky", with_(OD) + "SELECT " + sel(OD_COLS, drop=("leak_label", "leak_days"))
       + " FROM orders_dirty")
oracle("e03_remove_leaky_named", with_(OD) + "SELECT " + sel(OD_COLS, drop=("leak_days",)) + " FROM orders_dirty")
oracle("e09_drop_high_missing_named", with_(LD) + "SELECT " + sel(LD_COLS, drop=("l_tax",)) + " FROM lineitem_dirty")
oracle("e11_drop_correlated_named", with_(LD) + "SELECT " + sel(LD_COLS, drop=("gross",)) + " FROM lineitem_dirty")
oracle("e04_fill_median", with_(OD) + "SELECT " + sel(OD_COLS, {
    "amount": (f"coalesce(amount, {MED_AMOUNT})", "double")}) + " FROM orders_dirty")
oracle("e05_fill_mode", with_(OD) + "SELECT " + sel(OD_COLS, {
    "status": ("coalesce(status, (SELECT status FROM orders_dirty WHERE status IS NOT NULL "
               "GROUP BY status ORDER BY count(*) DESC, status LIMIT 1))", "string")}) + " FROM orders_dirty")
_Z = (f"sqrt(-2.0 * ln(1.0 - {sql_u('id', 'jitter42_a')})) * cos(2.0 * pi() * {sql_u('id', 'jitter42_b')})")
oracle("e06_fill_jitter", with_(OD) + "SELECT " + sel(OD_COLS, {
    "amount": (f"coalesce(amount, {MED_AMOUNT} + 0.1 * (SELECT stddev_samp(amount) FROM orders_dirty) * {_Z})",
               "double")}) + " FROM orders_dirty")
oracle("e07_fill_constant", with_(OD) + "SELECT " + sel(OD_COLS, {
    "status": ("coalesce(status, 'missing')", "string"),
    "amount": ("coalesce(amount, 0.0)", "double")}) + " FROM orders_dirty")
_Q = "(SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM orders_dirty)"
oracle("e08_clip_outliers", with_(OD, f"qa AS {_Q}") + "SELECT " + sel(OD_COLS, {
    "amount": ("CASE WHEN amount IS NULL THEN NULL ELSE greatest(least(amount, q3 + 1.5 * (q3 - q1)), "
               "q1 - 1.5 * (q3 - q1)) END", "double")}) + " FROM orders_dirty, qa")
oracle("e09_drop_high_missing", with_(LD) + "SELECT " + sel(LD_COLS, drop=("l_tax",)) + " FROM lineitem_dirty")
oracle("e10_reduce_cardinality", with_(OD, "top_city AS (SELECT city FROM orders_dirty WHERE city IS NOT NULL "
       "GROUP BY city ORDER BY count(*) DESC, city LIMIT 10)") + "SELECT " + sel(OD_COLS, {
           "city": ("CASE WHEN city IN (SELECT city FROM top_city) THEN city ELSE 'Other' END", "string")})
       + " FROM orders_dirty")
oracle("e11_drop_correlated", with_(LD) + "SELECT " + sel(LD_COLS, drop=("gross",)) + " FROM lineitem_dirty")

# ----------------------------------------------------------------- F features

oracle("f01_encode_onehot", with_(OD) + "SELECT " + sel(OD_COLS, drop=("status",), extra=[
    f"coalesce(status, 'missing') = '{v}' AS status_{v}" for v in ("F", "O", "P", "missing")])
    + " FROM orders_dirty")
oracle("f01_encode_onehot_events", "SELECT event_id, round(value, 6) AS value, " + ", ".join(
    f"event_type = '{v}' AS event_type_{v}" for v in ("click", "error", "purchase", "signup", "view"))
    + " FROM events")
oracle("f02_encode_label", with_(OD) + "SELECT " + sel(OD_COLS, {
    "city": ("CAST(dense_rank() OVER (ORDER BY coalesce(city, 'missing')) - 1 AS BIGINT)", "bigint")})
    + " FROM orders_dirty")
oracle("f02_encode_label_part", "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY coalesce(p_name, 'missing')) - 1 "
       "AS BIGINT) AS p_name FROM part")
oracle("f03_encode_target", with_(OD) + "SELECT " + sel(OD_COLS, {
    "city": ("avg(y) OVER (PARTITION BY coalesce(city, 'missing'))", "double")}) + " FROM orders_dirty")
oracle("f03_encode_target_folds", with_(
    OD, f"od AS (SELECT id, coalesce(city, 'missing') AS level, status, y, CAST(floor({sql_u('id', 'fold42')} * 5) AS INTEGER) AS f FROM orders_dirty)",
    "tr AS (SELECT * FROM od WHERE id % 5 <> 0)",
    "o AS (SELECT a.f, avg(b.y) AS m FROM (SELECT DISTINCT f FROM tr) a JOIN tr b ON a.f <> b.f GROUP BY a.f)",
    "k AS (SELECT a.level, a.f, count(b.y) AS n, coalesce(sum(b.y), 0) AS s FROM (SELECT DISTINCT level, f FROM tr) a "
    "LEFT JOIN tr b ON a.level = b.level AND a.f <> b.f GROUP BY ALL)",
    "w AS (SELECT level, (sum(y) + 10.0 * (SELECT avg(y) FROM tr)) / (count(y) + 10.0) AS mean FROM tr GROUP BY level)")
    + "SELECT id, round((s + 10.0 * m) / (n + 10.0), 6) AS city, status, y FROM tr JOIN k USING (level, f) JOIN o USING (f) "
    "UNION ALL SELECT id, round(mean, 6), status, y FROM od LEFT JOIN w USING (level) WHERE id % 5 = 0")
oracle("f04_normalize_standard",
       "WITH m AS (SELECT quantile_cont(n_chars, 0.5) AS med FROM documents), "
       "f AS (SELECT doc_id, coalesce(n_chars::DOUBLE, med) AS x FROM documents, m) "
       "SELECT doc_id, round((x - avg(x) OVER ()) / stddev_samp(x) OVER (), 6) AS n_chars FROM f")
oracle("f05_normalize_robust",
       "WITH m AS (SELECT quantile_cont(value, 0.5) AS med FROM events), "
       "f AS (SELECT event_id, coalesce(value, med) AS x FROM events, m), "
       "q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) AS q3 FROM f) "
       "SELECT event_id, round((x - q2) / (q3 - q1), 6) AS value FROM f, q")
oracle("f06_log_transform", with_(OD) + "SELECT " + sel(OD_COLS, {
    "los_days": ("ln(1 + coalesce(los_days, (SELECT quantile_cont(los_days, 0.5) FROM orders_dirty)))", "double")})
    + " FROM orders_dirty")
_F10 = with_(OD, "od AS (SELECT DISTINCT id, amount, total, los_days, status, city, y FROM orders_dirty)",
             "train AS (SELECT * FROM od WHERE id % 5 <> 0)",
             "cities AS (SELECT city FROM train WHERE city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 10)",
             "codes AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS code FROM (SELECT DISTINCT CASE WHEN city IN (SELECT city FROM cities) "
             "THEN city ELSE 'Other' END AS level FROM train))",
             "means AS (SELECT coalesce(status, 'missing') AS level, avg(y) AS mean FROM train GROUP BY 1)",
             "f AS (SELECT quantile_cont(amount, 0.5) AS med, quantile_cont(total, 0.25) AS q1, quantile_cont(total, 0.75) AS q3, "
             "quantile_cont(los_days, 0.5) AS lm FROM train)",
             "m AS (SELECT avg(coalesce(los_days, lm)) AS mu, stddev_samp(coalesce(los_days, lm)) AS sd FROM train, f)")
oracle("f10_fit_train_transform_test", _F10 +
       "SELECT id, round(coalesce(amount, med), 6) AS amount, round(greatest(least(total, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)), 6) AS total, "
       "round((coalesce(los_days, lm) - mu) / sd, 6) AS los_days, round(mean, 6) AS status, code AS city, y FROM od, f, m "
       "LEFT JOIN means ON means.level = coalesce(od.status, 'missing') "
       "LEFT JOIN codes ON codes.level = CASE WHEN od.city IN (SELECT city FROM cities) THEN od.city ELSE 'Other' END WHERE id % 5 = 0")
oracle("f09_create_interaction", with_(LD) + "SELECT " + sel(LD_COLS, extra=[
    "round(l_quantity * l_extendedprice, 6) AS l_quantity_x_l_extendedprice"]) + " FROM lineitem_dirty")
_CODED = ", ".join(f"dense_rank() OVER (ORDER BY coalesce({n}, 'nan')) - 1 AS {n}" if t == "string" else
                   f"coalesce({n}::DOUBLE, (SELECT quantile_cont({n}, 0.5) FROM orders_dirty)) AS {n}" for n, t in OD_COLS if n != "y")
oracle("f08_variance_ranking", with_(OD, f"coded AS (SELECT {_CODED} FROM orders_dirty)",
       "v AS (" + " UNION ALL ".join(f"SELECT {i} AS pos, '{n}' AS feature, var_samp({n}) AS variance FROM coded"
                                    for i, (n, _) in enumerate(x for x in OD_COLS if x[0] != "y")) + ")")
       + "SELECT CAST(row_number() OVER (ORDER BY variance DESC, pos) - 1 AS INTEGER) AS position, feature, "
       "CAST(printf('%.6e', variance) AS DOUBLE) AS variance FROM v")
_CODED_LIST = [
    f"dense_rank() OVER (ORDER BY coalesce({n}, 'nan')) - 1 AS {n}" if t == "string" else
    f"coalesce({n}::DOUBLE, (SELECT quantile_cont({n}, 0.5) FROM orders_dirty)) AS {n}" for n, t in OD_COLS if n != "y"]
def _forest_sql(trees: int = 30, depth: int = 4, bins: int = 16, seed: int = 42) -> list[str]:
    """Common table expressions that grow F7's forest on orders: splits(t, node, f, bin, gain)."""
    feats = [n for n, _ in OD_COLS if n != "y"]
    m = int(len(feats) ** 0.5)
    probs = ", ".join(repr(i / bins) for i in range(1, bins))
    edges = ", ".join(f"list_distinct(quantile_cont({n}::DOUBLE, [{probs}])) AS e{i}" for i, n in enumerate(feats))
    binned = ", ".join(f"len(list_filter(e{i}, lambda e: e < {n}::DOUBLE))" for i, n in enumerate(feats))
    cdf = [math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) for k in range(6)]
    weight = " + ".join(f"(u >= {x!r})::INT" for x in cdf)
    out = [f"coded AS (SELECT orders_dirty.id AS key, y, {', '.join(_CODED_LIST)} FROM orders_dirty WHERE y IS NOT NULL)",
           f"edges AS (SELECT {edges} FROM coded)",
           f"base AS MATERIALIZED (SELECT row_number() OVER () AS rid, key, CAST(y AS VARCHAR) AS y, [{binned}] AS b FROM coded, edges)",
           f"tree AS (SELECT unnest(range({trees})) AS t)",
           f"draw AS (SELECT rid, t, ('0x' || substr(md5(CAST(key AS VARCHAR) || ':forest{seed}:' || (t // 4)), CAST(1 + 8 * (t % 4) AS BIGINT), 8))::BIGINT / 4294967296.0 AS u FROM base, tree)",
           f"node0 AS MATERIALIZED (SELECT rid, t, w, 1 AS node FROM (SELECT rid, t, {weight} AS w FROM draw) WHERE w > 0)",
           f"picked AS MATERIALIZED (SELECT t, node, f FROM tree, (SELECT unnest(range({1 << depth})) AS node), (SELECT unnest(range({len(feats)})) AS f) "
           f"QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY md5(t || ':' || node || ':' || f || ':forest{seed}')) <= {m})"]
    for d in range(depth):
        out += [f"hist{d} AS MATERIALIZED (SELECT t, node, f, b[f + 1] AS bin, y, sum(w)::BIGINT AS n FROM node{d} JOIN base USING (rid) JOIN picked USING (t, node) GROUP BY ALL)",
                f"cell{d} AS (SELECT * FROM (SELECT DISTINCT t, node, f, bin FROM hist{d}) JOIN (SELECT DISTINCT t, node, f, y FROM hist{d}) USING (t, node, f))",
                f"side{d} AS (SELECT t, node, f, bin, sum(coalesce(n, 0)) OVER (PARTITION BY t, node, f, y ORDER BY bin)::BIGINT AS l, "
                f"sum(coalesce(n, 0)) OVER (PARTITION BY t, node, f, y)::BIGINT AS a FROM cell{d} LEFT JOIN hist{d} USING (t, node, f, bin, y))",
                f"sums{d} AS (SELECT t, node, f, bin, sum(l)::BIGINT AS nl, sum(l * l)::BIGINT AS sl, sum(a - l)::BIGINT AS nr, sum((a - l) * (a - l))::BIGINT AS sr, "
                f"sum(a)::BIGINT AS na, sum(a * a)::BIGINT AS sa FROM side{d} GROUP BY ALL)",
                f"best{d} AS MATERIALIZED (SELECT t, node, f, bin, gain FROM (SELECT *, sl::DOUBLE / nl + sr::DOUBLE / nr - sa::DOUBLE / na AS gain FROM sums{d} WHERE nl > 0 AND nr > 0) "
                f"WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY gain DESC, f, bin) = 1)",
                f"node{d + 1} AS MATERIALIZED (SELECT rid, t, w, 2 * node + (b[f + 1] > bin)::INT AS node FROM node{d} JOIN best{d} USING (t, node) JOIN base USING (rid))"]
    out.append("splits AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM best{d}" for d in range(depth)) + ")")
    names = ", ".join(f"'{n}'" for n in feats)
    out += ["share AS (SELECT t, f, sum(gain) / sum(sum(gain)) OVER (PARTITION BY t) AS x FROM splits GROUP BY t, f)",
            f"importance AS (SELECT f, [{names}][f + 1] AS feature, round(sum(x) / (SELECT count(DISTINCT t) FROM splits), 3) AS importance FROM share GROUP BY f)",
            f"every AS (SELECT f, [{names}][f + 1] AS feature, coalesce(importance, 0.0) AS importance FROM (SELECT unnest(range({len(feats)})) AS f) LEFT JOIN importance USING (f))",
            "top AS (SELECT feature, importance FROM every ORDER BY importance DESC, f LIMIT 5)"]
    return out


oracle("f07_forest_splits", with_(OD, *_forest_sql()) + "SELECT CAST(t AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(f AS INTEGER) AS feature, "
       "CAST(bin AS INTEGER) AS bin, round(gain, 6) AS gain FROM splits")
oracle("f07_feature_importance", with_(OD, *_forest_sql()) + "SELECT feature, importance FROM top")
oracle("f07_importance_facts", with_(OD, *_forest_sql()) + "SELECT count(*) AS n, bool_and(importance BETWEEN 0 AND 1) AS in_range, "
       "(SELECT string_agg(feature, ',' ORDER BY feature) FROM (SELECT feature FROM top ORDER BY importance DESC, feature LIMIT 2)) AS leaders FROM top")
oracle("f08_select_top_k", with_(OD) + "SELECT " + sel(
    [x for x in OD_COLS if x[0] in ("amount", "total2", "total", "id", "city", "y")]) + " FROM orders_dirty")


# ----------------------------------------------------------------- G balance

# a repeated key and a nullable target: ties are ordered by the row's values, rows without a target are in no class
TIES_SQL = """ties AS (SELECT o_orderkey AS id, o_custkey % 40 AS key,
    CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 10 = 0 THEN 'A' ELSE 'B' END END AS status FROM orders)"""
_TIE_ORDER = ("md5(CAST(key AS VARCHAR) || ':42'), key, md5(CAST(id AS VARCHAR) || '|' || CAST(key AS VARCHAR) || '|' || coalesce(status, ''))")
_TIES = with_(TIES_SQL, f"r AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY {_TIE_ORDER}) AS rn, "
              "count(*) OVER (PARTITION BY status) AS nc FROM ties)")
oracle("g01_train_test_split_ties", _TIES + "SELECT id, key, status, "
       "CASE WHEN status IS NOT NULL AND rn <= floor(0.2 * nc) THEN 'test' ELSE 'train' END AS split FROM r")
oracle("g03_undersample_ties", _TIES + "SELECT id, key, status FROM r WHERE status IS NULL OR rn <= "
       "(SELECT min(nc) FROM r WHERE status IS NOT NULL)")


def _split_sql(view_sql, view, cols, target, key, frac_sql, distinct=False, what="split"):
    src = f"(SELECT DISTINCT * FROM {view})" if distinct else view
    h = f"md5(CAST({key} AS VARCHAR) || ':42')"
    ranked = (f"ranked AS (SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY {h}) AS rn, "
              f"count(*) OVER (PARTITION BY {target}) AS nc FROM {src} s)")
    if what == "split":
        return (with_(*view_sql, ranked) + "SELECT " + sel(cols) +
                f", CASE WHEN rn <= floor({frac_sql} * nc) THEN 'test' ELSE 'train' END AS split FROM ranked")
    return (with_(*view_sql, ranked) + "SELECT " + sel(cols) +
            " FROM ranked WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM "
            f"{src} s2 WHERE {target} IS NOT NULL GROUP BY {target}) m)")


LDOC_COLS = [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int"), ("lang", "string"),
             ("source", "string"), ("n_chars", "bigint")]
oracle("g01_train_test_split", _split_sql([LDOC], "labeled_documents", LDOC_COLS, "toxic", "doc_id", "0.2"))
oracle("g01_train_test_split_orders", _split_sql([OD], "orders_dirty", OD_COLS, "y", "id", "0.2", distinct=True))
oracle("g03_undersample", _split_sql([LDOC], "labeled_documents", LDOC_COLS, "toxic", "doc_id", "0.2",
                                     what="under"))
oracle("g03_undersample_orders", _split_sql([OD], "orders_dirty", OD_COLS, "y", "id", "0.2", distinct=True,
                                            what="under"))
oracle("g04_validate_no_leakage", with_(OD, *leakage_ctes("orders_dirty", OD_COLS, "y")) +
       "SELECT name, round(purity, 6) AS purity, round(gain, 6) AS gain FROM detect_leakage WHERE is_leaky")
_FEATS = [n for n, _ in OD_COLS if n != "y"]
_NULLS_ALL = " + ".join(f"count(*) FILTER (WHERE {n} IS NULL)" for n, _ in OD_COLS)
_NULLS_FEAT = " + ".join(f"count(*) FILTER (WHERE {n} IS NULL)" for n in _FEATS)
_N_TEXT = sum(1 for n, t in OD_COLS if t == "string" and n != "y")


def _readiness_sql(crit: str, high: str) -> str:
    return (f"greatest(least(1.0 - 0.30 * ({_NULLS_FEAT}) / (count(*) * {len(_FEATS)}.0) "
            f"- 0.25 * least({_N_TEXT} / {len(_FEATS)}.0, 1.0) - 0.20 * ({crit}) - 0.08 * ({high}), 1.0), 0.0)")


oracle("g05_data_report", with_(OD) +
       f"SELECT count(*) AS n_rows, CAST({len(OD_COLS)} AS BIGINT) AS n_cols, CAST({_NULLS_ALL} AS BIGINT) AS nulls, "
       f"CAST({_N_TEXT} AS BIGINT) AS unencoded_text, CAST(0 AS BIGINT) AS issues_resolved, "
       f"CAST(0 AS BIGINT) AS issues_total, round({_readiness_sql('0', '0')}, 2) AS readiness FROM orders_dirty")

# ----------------------------------------------------------------- H issues


def issues_ctes() -> list[str]:
    """Measured issue table of orders_dirty (same rules as detect_issues)."""
    pctes, body = profile_ctes("orders_dirty", OD_COLS, "y", True)
    nums = [n for n, t in OD_COLS if t in NUMERIC and n != "y"]
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS col1, '{b}' AS col2, {i} AS i, {j} AS j, corr({a}, {b}) AS r FROM orders_dirty"
        for i, a in enumerate(nums) for j, b in enumerate(nums) if i < j)
    return [OD, *leakage_ctes("orders_dirty", OD_COLS, "y"), *pctes,
            f"prof AS ({body})",
            f"hc AS (SELECT * FROM ({pairs}) x WHERE NOT isnan(r) AND abs(r) > 0.85)",
            "hc_keep AS (SELECT * FROM hc WHERE col1 NOT IN (SELECT col2 FROM hc) "
            "AND col2 NOT IN (SELECT col2 FROM hc h2 WHERE h2.i < hc.i OR (h2.i = hc.i AND h2.j < hc.j)))",
            "dups AS (SELECT coalesce(sum(k - 1), 0) AS d FROM (SELECT count(*) AS k FROM orders_dirty GROUP BY "
            + ", ".join(n for n, _ in OD_COLS) + ") g)",
            "bal AS (SELECT max(c)::DOUBLE / greatest(min(c), 1) AS ratio FROM "
            "(SELECT count(*) AS c FROM orders_dirty WHERE y IS NOT NULL GROUP BY y) g)",
            "issues AS ("
            "SELECT 'orders' AS dataset, 'leakage_' || name AS issue_id, 'leakage' AS issue_type, name AS \"column\", "
            "'critical' AS severity, name || ' predicts y almost perfectly' AS description, "
            "'remove_leaky_col' AS recommended_action, false AS resolved FROM prof WHERE is_leaky "
            "UNION ALL SELECT 'orders', 'missing_' || name, 'missing', name, "
            "CASE WHEN missing_pct >= 0.4 THEN 'high' WHEN missing_pct >= 0.1 THEN 'medium' ELSE 'low' END, "
            "CAST(missing_count AS VARCHAR) || ' missing values in ' || name, "
            "CASE WHEN missing_pct >= 0.4 THEN 'drop_high_missing_col' WHEN dtype = 'numeric' "
            "THEN 'fill_missing_median' ELSE 'fill_missing_mode' END, false FROM prof WHERE missing_pct > 0 "
            "UNION ALL SELECT 'orders', 'dtype_' || name, 'dtype', name, 'medium', "
            "name || ' holds numbers stored as text', 'fix_dtypes', false FROM prof "
            "WHERE dtype = 'categorical' AND inferred_dtype = 'numeric' "
            "UNION ALL SELECT 'orders', 'outlier_' || name, 'outlier', name, 'medium', "
            "name || ' has values outside the 1.5 IQR fences', 'clip_outliers', false FROM prof WHERE has_outliers "
            "UNION ALL SELECT 'orders', 'outlier_' || name, 'outlier', name, 'low', name || ' is skewed', "
            "'log_transform', false FROM prof WHERE is_skewed AND NOT has_outliers "
            "UNION ALL SELECT 'orders', 'cardinality_' || name, 'cardinality', name, 'medium', "
            "name || ' has ' || CAST(unique_count AS VARCHAR) || ' distinct values', 'reduce_cardinality', false "
            "FROM prof WHERE is_high_cardinality "
            "UNION ALL SELECT 'orders', 'correlation_' || col2, 'correlation', col2, 'medium', "
            "col2 || ' duplicates ' || col1, 'drop_correlated_col', false FROM hc_keep "
            "UNION ALL SELECT 'orders', 'duplicate_table', 'duplicate', NULL, 'high', "
            "CAST(d AS VARCHAR) || ' duplicate rows', 'drop_duplicates', false FROM dups WHERE d > 0 "
            "UNION ALL SELECT 'orders', 'imbalance_y', 'imbalance', 'y', 'high', "
            "'class ratio of y is 1.5 or more', 'handle_imbalance_smote', false FROM bal WHERE ratio >= 1.5)",
            ]


ISSUE_COLS = 'dataset, issue_id, issue_type, "column", severity, description, recommended_action'
oracle("h06_detect_issues", with_(*issues_ctes()) + f"SELECT {ISSUE_COLS}, resolved FROM issues")
_RESOLVED = (
    "resolved_issues AS (SELECT " + ISSUE_COLS + ", resolved OR "
    "(\"column\" IS NOT NULL AND EXISTS (SELECT 1 FROM issues f WHERE f.severity IN ('critical', 'high') "
    "AND f.\"column\" IS NOT NULL AND f.issue_type = i.issue_type AND lower(trim(upper(f.\"column\"))) = lower(trim(i.\"column\")))) "
    "OR issue_type = 'outlier' AS resolved FROM issues i)")
oracle("h01_resolve_issues", with_(*issues_ctes(), _RESOLVED) + f"SELECT {ISSUE_COLS}, resolved FROM resolved_issues")
oracle("h03_readiness_score", with_(*issues_ctes()) + "SELECT round(" + _readiness_sql(
    "(SELECT count(*) FROM issues WHERE severity = 'critical')",
    "(SELECT count(*) FROM issues WHERE severity = 'high')") + ", 6) AS readiness FROM orders_dirty")
oracle("h04_issue_coverage", with_(*issues_ctes(), _RESOLVED) +
       "SELECT count(*) AS issues_total, CAST(count(*) FILTER (WHERE resolved) AS BIGINT) AS issues_resolved, "
       "CASE WHEN count(*) = 0 THEN 0.0 ELSE round(count(*) FILTER (WHERE resolved) / greatest(count(*), 1), 4) END "
       "AS coverage FROM resolved_issues")
oracle("h05_weighted_coverage", with_(*issues_ctes(), _RESOLVED) +
       "SELECT count(*) AS issues_total, "
       "CAST(coalesce(sum(CASE WHEN resolved THEN (CASE WHEN severity = 'critical' THEN 2 ELSE 1 END) ELSE 0 END), 0) "
       "AS BIGINT) AS issues_resolved, "
       "CASE WHEN count(*) = 0 THEN 1.0 ELSE round(sum(CASE WHEN resolved THEN (CASE WHEN severity = 'critical' "
       "THEN 2 ELSE 1 END) ELSE 0 END) / greatest(sum(CASE WHEN severity = 'critical' THEN 2 ELSE 1 END), 1), 4) END "
       "AS coverage FROM resolved_issues")


# ----------------------------------------------------------------- I actions
from .plans.actions import ALL_ACTIONS, PHASE_ACTIONS, VALID_ACTIONS  # noqa: E402

_NAMES = "[" + ", ".join(f"'{a}'" for a in ALL_ACTIONS) + "]"
_CKEY = "CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)"
_A = f"({_NAMES})[CAST(floor({sql_u(_CKEY, 'act')} * {len(ALL_ACTIONS)}) AS BIGINT) + 1]"
REPLIES = (
    "replies AS (SELECT conv_id, turn, role, a AS rule_type, "
    "text || CASE WHEN m = 0 THEN ' ' || js WHEN m = 1 THEN chr(10) || '```json' || chr(10) || js || chr(10) || '```' "
    "WHEN m = 2 THEN ' Next: ' || js || ' Done.' WHEN m = 3 THEN ' ' || replace(js, '\"', chr(39)) "
    "WHEN m = 4 THEN ' ' || js || ' and {x}' ELSE ' {\"type\": ' || a END AS reply FROM "
    f"(SELECT *, '{{\"type\": \"' || a || '\", \"column\": \"' || role || '\"}}' AS js FROM "
    f"(SELECT conv_id, turn, role, text, {_A} AS a, floor({sql_u(_CKEY, 'wrap')} * 6) AS m FROM conversations) x) y)")
_VALID = ", ".join(f"'{a}'" for a in VALID_ACTIONS)
PARSED = (
    "parsed AS (SELECT conv_id, turn, role, rule_type, j ->> 'type' AS ptype, j ->> 'column' AS pcol FROM "
    "(SELECT *, try_cast(nullif(regexp_extract(regexp_replace(reply, '(?m)^[ \\t]*```.*$', '', 'g'), "
    "'(?s)\\{.*\\}', 0), '') AS JSON) AS j FROM replies) z)")
oracle("i02_extract_action", with_(REPLIES, PARSED) +
       f"SELECT conv_id, turn, CASE WHEN ptype IN ({_VALID}) THEN ptype END AS action_type, "
       f"CASE WHEN ptype IN ({_VALID}) THEN pcol END AS action_column FROM parsed")
_RULE_T = f"CASE WHEN {sql_u('conv_id', 'rule')} < 0.5 THEN rule_type ELSE 'profile_dataset' END"
oracle("i03_coalesce_action", with_(REPLIES, PARSED) +
       f"SELECT conv_id, turn, CASE WHEN ptype IN ({_VALID}) AND ptype = {_RULE_T} AND pcol IS NOT DISTINCT FROM role "
       f"THEN ptype ELSE {_RULE_T} END AS action_type, "
       f"CASE WHEN ptype IN ({_VALID}) AND ptype = {_RULE_T} AND pcol IS NOT DISTINCT FROM role "
       f"THEN pcol ELSE role END AS action_column FROM parsed")

# ----------------------------------------------------------------- J run log


def _phase_case(col: str) -> str:
    parts = " ".join(f"WHEN {col} IN ({', '.join(repr(a) for a in acts)}) THEN '{p}'"
                     for p, acts in PHASE_ACTIONS.items())
    return f"CASE {parts} ELSE 'done' END"


_EA = f"({_NAMES})[CAST(event_id % {len(ALL_ACTIONS)} AS BIGINT) + 1]"
RUNLOG = (
    "rl0 AS (SELECT user_id AS run_id, CAST(user_id % 3 + 1 AS INTEGER) AS task_id, ts, event_id, "
    f"{_EA} AS action_type FROM events), "
    f"rl1 AS (SELECT *, {_phase_case('action_type')} AS phase FROM rl0), "
    f"rl2 AS (SELECT *, phase <> 'eda' AND {sql_u('event_id', 'blk')} < 0.1 AS blocked FROM rl1), "
    f"rl3 AS (SELECT *, NOT blocked AND {sql_u('event_id', 'ok')} < 0.85 AS success, "
    f"round({sql_u('event_id', 'rb')}, 4) AS readiness_before FROM rl2), "
    "rl AS (SELECT run_id, task_id, ts, event_id, action_type, phase, success, blocked, readiness_before, "
    f"round(readiness_before + CASE WHEN success THEN 0.02 * {sql_u('event_id', 'ra')} ELSE 0.0 END, 4) "
    "AS readiness_after, "
    f"CAST(success AND {sql_u('event_id', 'cf')} < 0.05 AS INTEGER) AS critical_fixed, "
    f"CAST(success AND {sql_u('event_id', 'of')} < 0.2 AS INTEGER) AS other_fixed, "
    "row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS step FROM rl3)")
oracle("j01_action_phase", "WITH " + RUNLOG + " SELECT run_id, step, action_type, phase FROM rl")
_EDA = ", ".join(repr(a) for a in PHASE_ACTIONS["eda"])
oracle("j02_eda_gate", "WITH " + RUNLOG + ", firsts AS (SELECT run_id, action_type, min(step) AS first FROM rl "
       f"WHERE success AND action_type IN ({_EDA}) GROUP BY run_id, action_type), "
       "g AS (SELECT r.run_id, r.step, r.action_type, r.phase, r.task_id, "
       "(SELECT count(*) FROM firsts f WHERE f.run_id = r.run_id AND f.first < r.step) AS eda_done FROM rl r) "
       "SELECT run_id, step, action_type, eda_done, phase IN ('cleaning', 'engineering') AND "
       "eda_done < CASE task_id WHEN 1 THEN 4 WHEN 2 THEN 5 ELSE 6 END AS violation FROM g")
oracle("j03_phase_progress", "WITH " + RUNLOG + " SELECT run_id, step, " + ", ".join(
    f"CAST(sum(CAST(success AND phase = '{p}' AS BIGINT)) OVER (PARTITION BY run_id ORDER BY step "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS progress_{p}"
    for p in ("eda", "cleaning", "engineering", "validation")) + " FROM rl")
_REWARD = ("CASE WHEN blocked THEN -0.05 ELSE round(round(readiness_after - readiness_before, 4) + "
           "0.15 * critical_fixed + 0.08 * other_fixed + CASE WHEN success THEN -0.005 ELSE -0.05 END, 4) END")
import re as _re  # noqa: E402


def _dbl(sql: str) -> str:
    """Decimal literals as DOUBLE (DuckDB keeps them DECIMAL otherwise)."""
    return _re.sub(r"(?<![\w.'])(\d+\.\d+)(?![\w.'])", r"\1::DOUBLE", sql)


_REWARD = _dbl(_REWARD)
oracle("j04_rewards", "WITH " + RUNLOG + f", rw AS (SELECT run_id, step, {_REWARD} AS reward FROM rl) "
       "SELECT run_id, step, round(reward, 4) + 0.0::DOUBLE AS reward, round(sum(reward) OVER (PARTITION BY run_id "
       "ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) + 0.0::DOUBLE AS cumulative_reward FROM rw")
SCORES = (
    "sc0 AS (SELECT run_id, task_id, count(*) AS steps, count(*) FILTER (WHERE blocked) AS n_blocked, "
    "sum(critical_fixed) AS cf, sum(other_fixed) AS of, arg_max(readiness_after, step) AS readiness "
    "FROM rl GROUP BY run_id, task_id), "
    "sc AS (SELECT run_id, task_id, steps, greatest(0.0, 1.0 - 0.05 * n_blocked) AS po, "
    "round(1.0 - steps / greatest(CASE task_id WHEN 1 THEN 18 WHEN 2 THEN 22 ELSE 28 END, 1), 4) AS eff, "
    "least(1.0, (cf + of) / CASE task_id WHEN 1 THEN 5 WHEN 2 THEN 7 ELSE 10 END) AS cov, readiness FROM sc0), "
    "scores AS (SELECT run_id, task_id, steps, round(po, 4) AS phase_order, eff AS efficiency, "
    "round(cov, 4) AS coverage, readiness, "
    "round(CAST(greatest(0.0, least(1.0, 0.35 * cov + 0.25 * readiness + 0.25 * po + 0.15 * eff)) "
    "AS DECIMAL(38, 10)), 4)::DOUBLE AS score FROM sc)")
SCORES = _dbl(SCORES)
oracle("j08_run_scores", "WITH " + RUNLOG + ", " + SCORES + " SELECT * FROM scores")
oracle("j09_task_summary", "WITH " + RUNLOG + ", " + SCORES +
       " SELECT task_id, count(*) AS runs, round(avg(score), 6) AS mean_score, "
       "round(max(score) - min(score), 6) AS spread, round(max(score) - min(score), 6) < 0.001 AS reproducible "
       "FROM scores GROUP BY task_id")


# ----------------------------------------------------------------- I1 plan

from .plans.recommend import EDA_STEPS as _EDA_STEPS  # noqa: E402


def _fixed(phase_no, phase, names, start=0):
    return " UNION ALL ".join(f"SELECT {phase_no}, {start + i}, 0, '{phase}', '{a}', NULL, 'fixed step'"
                              for i, a in enumerate(names))


def _if_issue(phase_no, rule, phase, kind, action, reason):
    return (f"SELECT {phase_no}, {rule}, 0, '{phase}', '{action}', NULL, '{reason}' FROM "
            f"(SELECT 1 FROM issues WHERE issue_type = '{kind}' AND NOT resolved LIMIT 1) x")


PLAN_ROWS = ("plan_rows AS (" + " UNION ALL ".join([
    _fixed(0, "eda", _EDA_STEPS),
    "SELECT 1, 1, position, 'cleaning', 'remove_leaky_col', name, 'leaks the target' FROM prof WHERE is_leaky",
    _if_issue(1, 2, "cleaning", "dtype", "fix_dtypes", "numbers stored as text"),
    _if_issue(1, 3, "cleaning", "duplicate", "drop_duplicates", "duplicate rows"),
    "SELECT 1, 4, position, 'cleaning', CASE WHEN dtype = 'numeric' THEN 'fill_missing_median' "
    "ELSE 'fill_missing_mode' END, name, 'missing values' FROM prof WHERE missing_pct > 0 AND NOT is_leaky",
    "SELECT 1, 5, position, 'cleaning', 'reduce_cardinality', name, 'high cardinality' FROM prof "
    "WHERE is_high_cardinality AND dtype = 'categorical'",
    "SELECT 1, 6, position, 'cleaning', 'clip_outliers', name, 'fence outliers' FROM prof "
    "WHERE has_outliers AND dtype = 'numeric'",
    "SELECT 1, 7, coalesce(p.position, 0), 'cleaning', 'drop_correlated_col', i.\"column\", "
    "'correlated with another column' FROM issues i LEFT JOIN prof p ON p.name = i.\"column\" "
    "WHERE i.issue_type = 'correlation' AND NOT i.resolved AND i.\"column\" IS NOT NULL",
    "SELECT 2, 1, position, 'engineering', 'log_transform', name, 'skewed' FROM prof "
    "WHERE is_skewed AND dtype = 'numeric'",
    "SELECT 2, 2, position, 'engineering', CASE WHEN unique_count <= 15 THEN 'encode_onehot' "
    "ELSE 'encode_label' END, name, 'unencoded text' FROM prof WHERE dtype = 'categorical' AND NOT is_leaky "
    "AND unique_count < 0.5 * (SELECT count(*) FROM orders_dirty)",
    "SELECT 2, 3, position, 'engineering', 'normalize_standard', name, 'scale' FROM prof "
    "WHERE dtype = 'numeric' AND NOT is_leaky",
    _fixed(3, "validation", ["train_test_split"]),
    _if_issue(3, 1, "validation", "imbalance", "handle_imbalance_smote", "class imbalance"),
    _fixed(3, "validation", ["validate_no_leakage", "generate_data_report", "finish"], start=2),
]) + ")")
oracle("i01_recommend", with_(*issues_ctes(), PLAN_ROWS.replace("plan_rows AS (", "plan_rows(phase_no, rule, pos, "
       "phase, action, col, reason) AS (", 1)) +
       "SELECT phase, row_number() OVER (ORDER BY phase_no, rule, pos) AS seq, action, col AS \"column\", reason "
       "FROM plan_rows")


# ----------------------------------------------------------------- A3-A5 fixtures
import math as _math  # noqa: E402

from .sources import fixtures as _fx  # noqa: E402


def _f(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def s_u(salt):
    return sql_u("k", salt)


def s_uint(salt, lo, hi):
    return f"CAST({lo} + floor({s_u(salt)} * {hi - lo}) AS BIGINT)"


def s_uniform(salt, lo, hi):
    return f"({_f(lo)} + {s_u(salt)} * {_f(hi - lo)})"


def s_normal(salt, mean, std):
    z = f"(sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {s_u(salt + '_a')})) * cos({_f(2 * _math.pi)} * {s_u(salt + '_b')}))"
    return f"({_f(mean)} + {_f(std)} * {z})"


def s_expo(salt, scale):
    return f"({_f(-scale)} * ln(1.0::DOUBLE - {s_u(salt)}))"


def s_choice(salt, values, probs):
    acc, parts = 0.0, []
    for v, p in zip(values[:-1], probs[:-1]):
        acc += p
        parts.append(f"WHEN {s_u(salt)} < {_f(acc)} THEN {v!r}")
    last = values[-1]
    return "CASE " + " ".join(parts) + f" ELSE {last!r} END"


def s_bern(salt, p_sql):
    return f"CAST(CASE WHEN {s_u(salt)} < ({p_sql}) THEN 1 ELSE 0 END AS INTEGER)"


def s_pick(salt, frac):
    """rank by md5 <= int(n * frac): the exact injection rule."""
    return (f"(row_number() OVER (ORDER BY md5(CAST(k AS VARCHAR) || ':{salt}')) "
            f"<= floor(count(*) OVER () * {_f(frac)}))")


_CHURN_BASE = (
    "keys AS (SELECT c_custkey AS k FROM customer), "
    "b0 AS (SELECT k, printf('CUST_%05d', k) AS customer_id, "
    f"CAST({s_uint('age42', 18, 70)} AS DOUBLE) AS age, CAST({s_uint('ten42', 1, 72)} AS DOUBLE) AS tenure_months, "
    f"{s_uniform('mc42', 20, 120)} AS monthly_charges, {s_normal('tc42', 0.0, 50.0)} AS noise, "
    f"{s_choice('ct42', *_fx.CONTRACTS)} AS contract, {s_choice('in42', *_fx.INTERNET)} AS internet_service, "
    f"{s_choice('pm42', *_fx.PAYMENT)} AS payment_method, "
    f"'City_' || CAST({s_uint('city42', 0, 150)} AS VARCHAR) AS city FROM keys), "
    "b1 AS (SELECT *, tenure_months * monthly_charges + noise AS total_charges, "
    + s_bern("churn42", "0.3::DOUBLE + 0.25::DOUBLE * CAST(contract = 'Month-to-month' AS DOUBLE) "
             "- 0.15::DOUBLE * (tenure_months / 72.0::DOUBLE) + 0.1::DOUBLE * CAST(internet_service = 'Fiber optic' AS DOUBLE)")
    + " AS churn FROM b0), "
    f"b2 AS (SELECT *, {s_pick('m_age42', 0.15)} AS miss_age, {s_pick('m_mc42', 0.12)} AS miss_mc, "
    f"{s_pick('o_tc42', 0.015)} AS out_tc FROM b1)")
oracle("a03_gen_churn", "WITH " + _CHURN_BASE +
       " SELECT customer_id, CASE WHEN miss_age THEN NULL ELSE round(age, 6) END AS age, "
       "CAST(CAST(tenure_months AS BIGINT) AS VARCHAR) || ' months' AS tenure_months, "
       "CASE WHEN miss_mc THEN NULL ELSE round(monthly_charges, 6) END AS monthly_charges, "
       f"round(CASE WHEN out_tc THEN {s_uniform('o_tc42_v', -500, -10)} ELSE total_charges END, 6) AS total_charges, "
       "contract, internet_service, payment_method, city, churn FROM b2")

_LOAN_BASE = (
    "keys AS (SELECT o_orderkey AS k FROM orders), "
    "b0 AS (SELECT k, printf('LOAN_%05d', k) AS loan_id, "
    f"CAST({s_uint('age42', 21, 65)} AS DOUBLE) AS age, 20000.0::DOUBLE + {s_expo('inc42', 50000)} AS income, "
    f"{s_uniform('amt42', 5000, 100000)} AS loan_amount, "
    f"CAST({s_choice('term42', *_fx.LOAN_TERMS)} AS BIGINT) AS loan_term, "
    f"CAST({s_uint('cs42', 300, 850)} AS DOUBLE) AS credit_score, "
    f"{s_choice('emp42', *_fx.EMPLOYMENT)} AS employment, {s_choice('pur42', *_fx.PURPOSE)} AS purpose FROM keys), "
    "b1 AS (SELECT *, loan_amount / income AS dti_ratio FROM b0), "
    "b2 AS (SELECT *, " + s_bern("def42", "0.05::DOUBLE + 0.15::DOUBLE * CAST(employment = 'Unemployed' AS DOUBLE) "
                                   "+ 0.1::DOUBLE * CAST(dti_ratio > 0.4 AS DOUBLE) - 0.05::DOUBLE * (credit_score / 850.0::DOUBLE)")
    + " AS \"default\" FROM b1), "
    f"b3 AS (SELECT *, {s_pick('m_cs42', 0.10)} AS miss_cs, {s_pick('m_inc42', 0.08)} AS miss_inc FROM b2), "
    "b4 AS (SELECT loan_id, round(age, 6) AS age, CASE WHEN miss_inc THEN NULL ELSE round(income, 6) END AS income, "
    "round(loan_amount, 6) AS loan_amount, loan_term, "
    "CASE WHEN miss_cs THEN NULL ELSE round(credit_score, 6) END AS credit_score, round(dti_ratio, 6) AS dti_ratio, "
    "employment, purpose, \"default\", CASE \"default\" WHEN 0 THEN 'Current' WHEN 1 THEN 'Charged-off' END AS loan_status, "
    f"{s_pick('dup42', 50 / 1200)} AS dup FROM b3)")
oracle("a04_gen_loan", "WITH " + _LOAN_BASE +
       " SELECT * EXCLUDE (dup) FROM b4 UNION ALL SELECT * EXCLUDE (dup) FROM b4 WHERE dup")

_MED_P = ("0.06::DOUBLE + 0.08::DOUBLE * (num_medications / 20.0::DOUBLE) + 0.06::DOUBLE * CAST(hba1c_result > 9 AS DOUBLE) "
          "+ 0.05::DOUBLE * CAST(age > 70 AS DOUBLE) - 0.03::DOUBLE * CAST(discharge_to = 'Home' AS DOUBLE)")
_AGE_BIN = "CASE " + " ".join(
    f"WHEN age >= {lo} AND age < {hi} THEN '{lab}'"
    for lo, hi, lab in zip(_fx.AGE_EDGES[:-1], _fx.AGE_EDGES[1:], _fx.AGE_LABELS)) + " ELSE 'nan' END"
_MED_BASE = (
    "keys AS (SELECT p_partkey AS k FROM part), "
    "b0 AS (SELECT k, printf('PT_%06d', k) AS patient_id, "
    f"CAST({s_uint('age42', 18, 95)} AS DOUBLE) AS age, {s_choice('gen42', *_fx.GENDER)} AS gender, "
    f"{s_choice('race42', *_fx.RACE)} AS race, {s_normal('bmi42', 28.0, 6.0)} AS bmi, "
    f"{s_normal('hb42', 7.5, 2.0)} AS hba1c_result, CAST({s_uint('meds42', 1, 20)} AS DOUBLE) AS num_medications, "
    f"CAST({s_uint('proc42', 0, 10)} AS DOUBLE) AS num_procedures, "
    f"CAST({s_uint('diag42', 1, 15)} AS DOUBLE) AS num_diagnoses, 1.0::DOUBLE + {s_expo('los42', 4)} AS los_days, "
    f"{s_choice('adm42', *_fx.ADMISSION)} AS admission_type, {s_choice('dis42', *_fx.DISCHARGE)} AS discharge_to, "
    f"{s_choice('pay42', *_fx.PAYER)} AS payer_code FROM keys), "
    f"b1 AS (SELECT *, {s_bern('re42', _MED_P)} AS readmitted FROM b0), "
    f"b2 AS (SELECT *, {s_pick('m_bmi42', 0.22)} AS m_bmi, {s_pick('m_hba1c_result42', 0.18)} AS m_hb, "
    f"{s_pick('m_num_medications42', 0.12)} AS m_meds, {s_pick('m_race42', 0.15)} AS m_race FROM b1)")
oracle("a05_gen_medical", "WITH " + _MED_BASE +
       f" SELECT patient_id, {_AGE_BIN} AS age, gender, CASE WHEN m_race THEN NULL ELSE race END AS race, "
       "CASE WHEN m_bmi THEN NULL ELSE round(bmi, 6) END AS bmi, "
       "CASE WHEN m_hb THEN NULL ELSE round(hba1c_result, 6) END AS hba1c_result, "
       "CASE WHEN m_meds THEN NULL ELSE round(num_medications, 6) END AS num_medications, "
       "round(num_procedures, 6) AS num_procedures, round(num_diagnoses, 6) AS num_diagnoses, "
       "round(los_days, 6) AS los_days, admission_type, discharge_to, payer_code, readmitted, "
       "CASE readmitted WHEN 0 THEN 'Stable discharge' WHEN 1 THEN 'High risk — follow up required' END "
       "AS discharge_summary, "
       f"CAST(CASE WHEN readmitted = 1 THEN 1 + floor({s_u('dtr42')} * 29) ELSE 0 END AS BIGINT) AS days_to_readmission "
       "FROM b2")


# ----------------------------------------------------------------- G2 SMOTE




# ----------------------------------------------------------------- A15 profile JSON
_PCOLS = ["position", "name", "dtype", "inferred_dtype", "missing_count", "missing_pct", "unique_count", "is_leaky",
          "is_high_cardinality", "is_skewed", "has_outliers", "correlated_with", "mean", "std", "skewness"]
_pc, _pbody = profile_ctes("orders_dirty", OD_COLS, "y", True)
oracle("a15_profile_json", with_(OD, *leakage_ctes("orders_dirty", OD_COLS, "y"), *_pc, f"prof AS ({_pbody})") +
       "SELECT CAST(to_json(list(struct_pack(" + ", ".join(f"{n} := {n}" for n in _PCOLS) +
       ", top_categories := CASE WHEN top_categories IS NULL THEN NULL ELSE string_split(top_categories, '|') END) "
       "ORDER BY position)) AS VARCHAR) AS profile_json FROM prof")


# ----------------------------------------------------------------- A7-A14, H2, J5-J7
def _pick_sql(key, salt, frac):
    return (f"(row_number() OVER (ORDER BY md5(CAST({key} AS VARCHAR) || ':{salt}')) "
            f"<= floor(count(*) OVER () * {_f(frac)}))")


oracle("a07_inject_missing",
       f"SELECT o_orderkey, o_custkey, CASE WHEN {_pick_sql('o_orderkey', 'miss_o_totalprice', 0.15)} THEN NULL "
       "ELSE round(o_totalprice, 6) END AS o_totalprice FROM orders")
oracle("a08_inject_duplicates",
       "SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders UNION ALL "
       f"SELECT o_orderkey, o_custkey, round(o_totalprice, 6) FROM orders QUALIFY {_pick_sql('o_orderkey', 'dup', 0.01)}")
oracle("a09_inject_unit",
       "SELECT o_orderkey, o_custkey, CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) || ' months' AS o_totalprice "
       "FROM orders")
oracle("a10_inject_outliers",
       f"SELECT o_orderkey, o_custkey, round(CASE WHEN {_pick_sql('o_orderkey', 'out_o_totalprice', 0.015)} "
       f"THEN {_f(-500.0)} + {sql_u('o_orderkey', 'out_o_totalprice_v')} * {_f(490.0)} ELSE o_totalprice END, 6) "
       "AS o_totalprice FROM orders")
oracle("a11_derive_map", "SELECT doc_id, quality, toxic, CASE toxic WHEN 0 THEN 'clean' WHEN 1 THEN 'toxic' END "
       "AS toxic_text FROM labels")
oracle("a12_derive_conditional", "SELECT doc_id, quality, toxic, CAST(CASE WHEN toxic = 1 THEN 1 + "
       f"floor({sql_u('doc_id', 'days')} * 29) ELSE 0 END AS BIGINT) AS days FROM labels")
_EDGES = [-1000.0, 0.0, 2500.0, 5000.0, 7500.0, 10000.0]
_LABS = ["[neg)", "[0-2500)", "[2500-5000)", "[5000-7500)", "[7500+)"]
oracle("a13_bin_labels", "SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal, CASE " + " ".join(
    f"WHEN c_acctbal >= {_f(lo)} AND c_acctbal < {_f(hi)} THEN '{lab}'"
    for lo, hi, lab in zip(_EDGES[:-1], _EDGES[1:], _LABS)) + " ELSE 'nan' END AS acct_band FROM customer")
oracle("a14_shuffle_positions", "SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':shuffle42')) - 1 AS position FROM orders")
oracle("g05_data_report_issues", with_(*issues_ctes(), _RESOLVED) +
       f"SELECT count(*) AS n_rows, CAST({len(OD_COLS)} AS BIGINT) AS n_cols, CAST({_NULLS_ALL} AS BIGINT) AS nulls, "
       f"CAST({_N_TEXT} AS BIGINT) AS unencoded_text, (SELECT count(*) FILTER (WHERE resolved) FROM resolved_issues) AS issues_resolved, "
       "(SELECT count(*) FROM resolved_issues) AS issues_total, round(" + _readiness_sql(
           "(SELECT count(*) FROM resolved_issues WHERE NOT resolved AND severity = 'critical')",
           "(SELECT count(*) FROM resolved_issues WHERE NOT resolved AND severity = 'high')") + ", 2) AS readiness FROM orders_dirty")
oracle("a14_shuffle", "SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders")
oracle("h02_resolve_by_type", with_(*issues_ctes()) +
       f"SELECT {ISSUE_COLS}, resolved OR issue_type IN (SELECT issue_type FROM issues WHERE severity = 'medium') "
       "AS resolved FROM issues")
oracle("j05_cumulative_reward", "WITH " + RUNLOG + f", rw AS (SELECT run_id, step, {_REWARD} AS reward FROM rl) "
       "SELECT run_id, step, round(sum(reward) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED "
       "PRECEDING AND CURRENT ROW), 4) + 0.0::DOUBLE AS cumulative_reward FROM rw")
oracle("j06_phase_order", "WITH " + RUNLOG + ", " + SCORES + " SELECT run_id, phase_order FROM scores")
oracle("j07_efficiency", "WITH " + RUNLOG + ", " + SCORES + " SELECT run_id, task_id, steps, efficiency FROM scores")


# ----------------------------------------------------------------- I4 golden churn pipeline
def _churn_pipeline_sql() -> str:
    one_hot = []
    for col, (levels, _p) in (("contract", _fx.CONTRACTS), ("internet_service", _fx.INTERNET),
                              ("payment_method", _fx.PAYMENT)):
        for lv in sorted(levels):
            one_hot.append(f"coalesce({col}, 'missing') = '{lv}' AS \"{col}_{lv}\"")
    top = ("(SELECT city FROM {src} WHERE city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 10)")
    steps = [
        "c0 AS (SELECT customer_id, CASE WHEN miss_age THEN NULL ELSE age END AS age, "
        "CAST(CAST(tenure_months AS BIGINT) AS VARCHAR) || ' months' AS tenure_months, "
        "CASE WHEN miss_mc THEN NULL ELSE monthly_charges END AS monthly_charges, "
        f"CASE WHEN out_tc THEN {s_uniform('o_tc42_v', -500, -10)} ELSE total_charges END AS total_charges, "
        "contract, internet_service, payment_method, city, churn FROM b2)",
        "c1 AS (SELECT * REPLACE (CASE WHEN city IN " + top.format(src="c0") + " THEN city ELSE 'Other' END AS city) "
        "FROM c0)",
        f"c2 AS (SELECT * REPLACE ({num_extract('tenure_months')} AS tenure_months) FROM c1)",
        "c3 AS (SELECT * REPLACE (coalesce(age, (SELECT quantile_cont(age, 0.5) FROM c2)) AS age, "
        "coalesce(monthly_charges, (SELECT quantile_cont(monthly_charges, 0.5) FROM c2)) AS monthly_charges) FROM c2)",
        "q4 AS (SELECT quantile_cont(total_charges, 0.25) AS q1, quantile_cont(total_charges, 0.75) AS q3 FROM c3)",
        "c4 AS (SELECT c3.* REPLACE (CASE WHEN total_charges IS NULL THEN NULL ELSE greatest(least(total_charges, "
        "q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) END AS total_charges) FROM c3, q4)",
        "c5 AS (SELECT * REPLACE (CASE WHEN city IN " + top.format(src="c4") + " THEN city ELSE 'Other' END AS city) "
        "FROM c4)",
        "c6 AS (SELECT customer_id, age, tenure_months, monthly_charges, total_charges, city, churn, "
        + ", ".join(one_hot) + " FROM c5)",
        "c7 AS (SELECT * REPLACE (CAST(dense_rank() OVER (ORDER BY coalesce(city, 'missing')) - 1 AS BIGINT) AS city) "
        "FROM c6)",
        "c8 AS (SELECT * REPLACE ("
        + ", ".join(f"(coalesce({n}, (SELECT quantile_cont({n}, 0.5) FROM c7)) - avg({n}) OVER ()) / "
                    f"stddev_samp({n}) OVER () AS {n}" for n in ("age", "monthly_charges", "total_charges"))
        + ") FROM c7)",
        "c9 AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY churn ORDER BY md5(customer_id || ':42')) <= "
        "floor(0.2 * count(*) OVER (PARTITION BY churn)) THEN 'test' ELSE 'train' END AS split FROM c8)",
    ]
    final = ("SELECT * REPLACE (round(age, 6) AS age, round(tenure_months, 6) AS tenure_months, "
             "round(monthly_charges, 6) AS monthly_charges, round(total_charges, 6) AS total_charges) FROM c9")
    return "WITH " + _CHURN_BASE + ", " + ", ".join(steps) + " " + final


oracle("i04_apply_plan_churn", _churn_pipeline_sql())
oracle("b03_infer_dtype_reference", with_(OD) + "\nUNION ALL ".join(
    f"SELECT '{n}' AS name, " + ("'numeric'" if t in NUMERIC else "'categorical'") + " AS dtype, " +
    (f"CASE WHEN least(count({n}), 50) > 5 THEN 'numeric' ELSE 'categorical' END AS inferred_dtype FROM orders_dirty"
     if t == "string" else "'numeric' AS inferred_dtype")
    for n, t in OD_COLS if n != "y"))


# ----------------------------------------------------------------- I4 golden loan pipeline
def _smote_ctes(src: str, cols: list[str], target: str, key: str, feats: list[str], types: dict,
                k: int = 5, prefix: str = "sm", pool: str = "true") -> tuple[list[str], str]:
    """SMOTE over a CTE ``src``; only rows of ``pool`` count, lend neighbours or are oversampled.
    Candidates: the k rows before and after in the order of each seeded projection of the min-max
    scaled features; neighbours: the k nearest of them by distance over all features.
    Returns (ctes, final select)."""
    from .operators.balance import directions
    offs = [o for d in range(1, k + 1) for o in (-d, d)]
    h, p = sql_hash52(key, "smote42"), prefix
    mm = ", ".join(f"min({f})::DOUBLE AS lo_{f}, max({f})::DOUBLE AS hi_{f}" for f in feats)
    xs = ", ".join(f"(coalesce(CAST({f} AS DOUBLE), lo_{f}) - lo_{f}) / CASE WHEN hi_{f} > lo_{f} THEN hi_{f} - lo_{f} ELSE 1.0::DOUBLE END AS x_{f}"
                   for f in feats)
    axes = directions(len(feats), 42)
    orders = ", ".join(" + ".join([f"{_f(r)} * x_{f}" for r, f in zip(axis, feats)]) + f" AS p{j}" for j, axis in enumerate(axes))
    row = "{'h': h, " + ", ".join(f"'x_{f}': x_{f}, 'v_{f}': CAST({f} AS DOUBLE)" for f in feats) + "}"
    near = ", ".join(f"{'lag' if o < 0 else 'lead'}({row}, {abs(o)}) OVER w{j}" for j in range(len(axes)) for o in offs)
    windows = ", ".join(f"w{j} AS (ORDER BY p{j}, h)" for j in range(len(axes)))
    gap = " + ".join(f"(s.x_{f} - x_{f}) * (s.x_{f} - x_{f})" for f in feats)
    found = "{'d': " + gap + ", 'h': s.h, " + ", ".join(f"'v_{f}': s.v_{f}" for f in feats) + "}"
    sk = f"CAST({key} AS VARCHAR) || '#s' || CAST(i AS VARCHAR)"
    ctes = [
        f"{p}_pool AS (SELECT * FROM {src} WHERE {pool})",
        f"{p}_cls AS (SELECT {target} AS t, count(*) AS c FROM {p}_pool WHERE {target} IS NOT NULL GROUP BY {target})",
        f"{p}_mino AS (SELECT t, c AS m, (SELECT max(c) FROM {p}_cls) - c AS need FROM {p}_cls "
        f"ORDER BY c, CAST(t AS VARCHAR) LIMIT 1)",
        f"{p}_mm AS (SELECT {mm} FROM {p}_pool, {p}_mino WHERE {target} = t)",
        f"{p}_scaled AS (SELECT s.*, {xs}, {h} AS h FROM {p}_pool s, {p}_mm, {p}_mino WHERE {target} = t)",
        f"{p}_minor AS (SELECT *, {orders} FROM {p}_scaled)",
        f"{p}_nbrs AS (SELECT *, [{near}] AS cand FROM {p}_minor WINDOW {windows})",
        f"{p}_near AS (SELECT *, list_slice(list_sort(list_distinct(list_transform(list_filter(cand, lambda s: s IS NOT NULL), lambda s: {found}))), 1, {k}) AS nr, "
        f"row_number() OVER (ORDER BY h) AS hr FROM {p}_nbrs)",
        f"{p}_rep AS (SELECT n.*, i FROM {p}_near n, {p}_mino, "
        f"range(1, CAST(need // m + CASE WHEN hr <= need % m THEN 1 ELSE 0 END AS BIGINT) + 1) r(i))",
        f"{p}_pick AS (SELECT *, {sql_u(sk, 'lambda42')} AS lam, "
        f"nr[CAST(floor({sql_u(sk, 'nn42')} * len(nr)) AS BIGINT) + 1] AS nb FROM {p}_rep)",
    ]
    out = []
    for c in cols:
        if c in feats:
            e = (f"CASE WHEN nb.v_{c} IS NULL THEN CAST({c} AS DOUBLE) ELSE CAST({c} AS DOUBLE) + lam * "
                 f"(nb.v_{c} - CAST({c} AS DOUBLE)) END")
            e = f"CAST(trunc({e}) AS BIGINT)" if types.get(c) == "bigint" else e
            out.append(f"{e} AS {c}")
        elif c == key:
            out.append(f"{sk} AS {key}")
        else:
            out.append(f'"{c}"')
    ctes.append(f"{p}_syn AS (SELECT {', '.join(out)} FROM {p}_pick)")
    final = (f"SELECT * REPLACE (CAST({key} AS VARCHAR) AS {key}) FROM {src} UNION ALL SELECT * FROM {p}_syn")
    return ctes, final


def _smote_oracle(name: str, feats: list[str], view: str, ctes: list[str], cols: list[str], types: dict, pool: str = "true"):
    more, final = _smote_ctes(view, cols, "toxic", "doc_id", feats, types, pool=pool)
    oracle(name, with_(*ctes, *more) + f"SELECT * FROM ({final})")


_SM_COLS = [n for n, _ in LDOC_COLS]
_smote_oracle("g02_smote", ["n_chars"], "labeled_documents", [LDOC], _SM_COLS, {"n_chars": "bigint"})
_SM2 = ("two AS (SELECT doc_id, toxic, n_chars, CAST((doc_id * 7919) % 1000 AS DOUBLE) AS spread, "
        "CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM labeled_documents)")
_smote_oracle("g02_smote_two_features", ["n_chars", "spread"], "two", [LDOC, _SM2], ["doc_id", "toxic", "n_chars", "spread", "split"],
              {"n_chars": "bigint"}, pool="split = 'train'")


def _loan_pipeline_sql() -> str:
    one_hot = []
    for col, (levels, _p) in (("employment", _fx.EMPLOYMENT), ("purpose", _fx.PURPOSE)):
        for lv in sorted(levels):
            one_hot.append(f"coalesce({col}, 'missing') = '{lv}' AS \"{col}_{lv}\"")
    steps = [
        "l0 AS (SELECT loan_id, age, CASE WHEN miss_inc THEN NULL ELSE income END AS income, loan_amount, loan_term, "
        "CASE WHEN miss_cs THEN NULL ELSE credit_score END AS credit_score, dti_ratio, employment, purpose, \"default\", "
        f"{s_pick('dup42', 50 / 1200)} AS dup FROM b3)",
        "l1 AS (SELECT * EXCLUDE (dup) FROM l0 UNION ALL SELECT * EXCLUDE (dup) FROM l0 WHERE dup)",
        "l2 AS (SELECT DISTINCT * FROM l1)",
        "l3 AS (SELECT * REPLACE (coalesce(credit_score, (SELECT quantile_cont(credit_score, 0.5) FROM l2)) AS credit_score, "
        "coalesce(income, (SELECT quantile_cont(income, 0.5) FROM l2)) AS income) FROM l2)",
        "l4 AS (SELECT * REPLACE (ln(1 + coalesce(income, (SELECT quantile_cont(income, 0.5) FROM l3))) AS income) FROM l3)",
        "l5 AS (SELECT loan_id, age, income, loan_amount, loan_term, credit_score, \"default\", "
        + ", ".join(one_hot) + " FROM l4)",
        "l6 AS (SELECT * REPLACE ("
        + ", ".join(f"(coalesce({n}, (SELECT quantile_cont({n}, 0.5) FROM l5)) - avg({n}) OVER ()) / "
                    f"stddev_samp({n}) OVER () AS {n}" for n in ("age", "loan_amount")) + ") FROM l5)",
        "q7 AS (SELECT quantile_cont(credit_score, 0.25) AS a, quantile_cont(credit_score, 0.5) AS b, "
        "quantile_cont(credit_score, 0.75) AS c FROM l6)",
        "l7 AS (SELECT l6.* REPLACE ((credit_score - b) / (c - a) AS credit_score) FROM l6, q7)",
        "l8 AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY \"default\" ORDER BY md5(loan_id || ':42')) <= "
        "floor(0.2 * count(*) OVER (PARTITION BY \"default\")) THEN 'test' ELSE 'train' END AS split FROM l7)",
    ]
    cols = (["loan_id", "age", "income", "loan_amount", "loan_term", "credit_score", "default"]
            + [f"{c}_{lv}" for c, (levels, _p) in (("employment", _fx.EMPLOYMENT), ("purpose", _fx.PURPOSE))
               for lv in sorted(levels)] + ["split"])
    feats = ["age", "income", "loan_amount", "loan_term", "credit_score"]
    sm, final = _smote_ctes("l8", cols, '"default"', "loan_id", feats, {"loan_term": "bigint"}, pool="split = 'train'")
    body = ("SELECT * REPLACE (" + ", ".join(f"round({n}, 6) AS {n}" for n in ("age", "income", "loan_amount",
                                                                              "credit_score")) + f") FROM ({final}) z")
    return "WITH " + _LOAN_BASE.split(", b4 AS")[0] + ", " + ", ".join(steps + sm) + " " + body


oracle("i04_apply_plan_loan", _loan_pipeline_sql())


# ----------------------------------------------------------------- I4 golden medical pipeline
def _medical_pipeline_sql() -> str:
    onehot = {"gender": _fx.GENDER, "admission_type": _fx.ADMISSION, "discharge_to": _fx.DISCHARGE}
    oh_cols = [f"{c}_{lv}" for c in ("gender", "admission_type", "discharge_to") for lv in sorted(onehot[c][0])]
    oh_sql = [f"coalesce({c}, 'missing') = '{lv}' AS \"{c}_{lv}\"" for c in ("gender", "admission_type", "discharge_to")
              for lv in sorted(onehot[c][0])]

    def med(n, src):
        return f"coalesce({n}, (SELECT quantile_cont({n}, 0.5) FROM {src}))"

    def std(n, src):
        return f"({med(n, src)} - avg({n}) OVER ()) / stddev_samp({n}) OVER () AS {n}"
    steps = [
        # generator output (unrounded), then the plan
        f"m0 AS (SELECT patient_id, {_AGE_BIN} AS age, gender, CASE WHEN m_race THEN NULL ELSE race END AS race, "
        "CASE WHEN m_bmi THEN NULL ELSE bmi END AS bmi, CASE WHEN m_hb THEN NULL ELSE hba1c_result END AS hba1c_result, "
        "CASE WHEN m_meds THEN NULL ELSE num_medications END AS num_medications, num_procedures, num_diagnoses, "
        "los_days, admission_type, discharge_to, payer_code, readmitted FROM b2)",
        f"m1 AS (SELECT * REPLACE ({num_extract('age')} AS age) FROM m0)",
        f"m2 AS (SELECT * REPLACE ({med('bmi', 'm1')} AS bmi, {med('hba1c_result', 'm1')} AS hba1c_result, "
        f"{med('num_medications', 'm1')} AS num_medications) FROM m1)",
        "m3 AS (SELECT * REPLACE (coalesce(race, (SELECT race FROM m2 WHERE race IS NOT NULL GROUP BY race "
        "ORDER BY count(*) DESC, race LIMIT 1)) AS race) FROM m2)",
        f"m4 AS (SELECT * EXCLUDE (num_procedures) REPLACE (ln(1 + {med('los_days', 'm3')}) AS los_days) FROM m3)",
        "m5 AS (SELECT patient_id, age, "
        "CAST(dense_rank() OVER (ORDER BY coalesce(race, 'missing')) - 1 AS BIGINT) AS race, bmi, hba1c_result, "
        "num_medications, num_diagnoses, los_days, "
        "CAST(dense_rank() OVER (ORDER BY coalesce(payer_code, 'missing')) - 1 AS BIGINT) AS payer_code, readmitted, "
        + ", ".join(oh_sql) + " FROM m4)",
        f"m6 AS (SELECT * REPLACE ({std('age', 'm5')}, {std('bmi', 'm5')}, {std('hba1c_result', 'm5')}) FROM m5)",
        "q7 AS (SELECT quantile_cont(num_medications, 0.25) AS a, quantile_cont(num_medications, 0.5) AS b, "
        "quantile_cont(num_medications, 0.75) AS c FROM m6)",
        "m7 AS (SELECT m6.* REPLACE ((num_medications - b) / (c - a) AS num_medications) FROM m6, q7)",
        f"m8 AS (SELECT * REPLACE ({std('los_days', 'm7')}, {std('num_diagnoses', 'm7')}) FROM m7)",
        "m9 AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY readmitted ORDER BY md5(patient_id || ':42')) <= "
        "floor(0.2 * count(*) OVER (PARTITION BY readmitted)) THEN 'test' ELSE 'train' END AS split FROM m8)",
    ]
    cols = (["patient_id", "age", "race", "bmi", "hba1c_result", "num_medications", "num_diagnoses", "los_days",
             "payer_code", "readmitted"] + oh_cols + ["split"])
    feats = ["age", "race", "bmi", "hba1c_result", "num_medications", "num_diagnoses", "los_days", "payer_code"]
    sm, final = _smote_ctes("m9", cols, "readmitted", "patient_id", feats, {"race": "bigint", "payer_code": "bigint"}, pool="split = 'train'")
    body = ("SELECT * REPLACE (" + ", ".join(f"round({n}, 6) AS {n}" for n in
                                             ("age", "bmi", "hba1c_result", "num_medications", "num_diagnoses",
                                              "los_days")) + f") FROM ({final}) z")
    return "WITH " + _MED_BASE + ", " + ", ".join(steps + sm) + " " + body


oracle("i04_apply_plan_medical", _medical_pipeline_sql())


# ----------------------------------------------------------------- I4 recommended plan on orders_dirty
def _orders_plan_sql() -> str:
    def med(n, src):
        return f"coalesce({n}, (SELECT quantile_cont({n}, 0.5) FROM {src}))"

    def clip(n, src):
        q = f"(SELECT quantile_cont({n}, 0.25) AS q1, quantile_cont({n}, 0.75) AS q3 FROM {src})"
        return (f"CASE WHEN {n} IS NULL THEN NULL ELSE greatest(least({n}, (SELECT q3 + 1.5 * (q3 - q1) FROM {q} x)), "
                f"(SELECT q1 - 1.5 * (q3 - q1) FROM {q} y)) END AS {n}")

    def std(n, src):
        return f"(({med(n, src)}) - (SELECT avg({n}) FROM {src})) / (SELECT stddev_samp({n}) FROM {src}) AS {n}"
    steps = [
        "o1 AS (SELECT * EXCLUDE (leak_label, leak_days) FROM orders_dirty)",
        f"o2 AS (SELECT * REPLACE ({num_extract('priority')} AS priority, {num_extract('tenure')} AS tenure) FROM o1)",
        "o3 AS (SELECT DISTINCT * FROM o2)",
        f"o4 AS (SELECT * REPLACE ({med('amount', 'o3')} AS amount) FROM o3)",
        "o5 AS (SELECT * REPLACE (coalesce(status, (SELECT status FROM o4 WHERE status IS NOT NULL GROUP BY status "
        "ORDER BY count(*) DESC, status LIMIT 1)) AS status) FROM o4)",
        "o6 AS (SELECT * REPLACE (CASE WHEN city IN (SELECT city FROM o5 WHERE city IS NOT NULL GROUP BY city "
        "ORDER BY count(*) DESC, city LIMIT 10) THEN city ELSE 'Other' END AS city) FROM o5)",
        f"o7 AS (SELECT * REPLACE ({clip('amount', 'o6')}) FROM o6)",
        f"o8 AS (SELECT * EXCLUDE (total2) REPLACE ({clip('los_days', 'o7')}) FROM o7)",
        f"o9 AS (SELECT * REPLACE (ln(1 + {med('los_days', 'o8')}) AS los_days) FROM o8)",
        "o10 AS (SELECT id, amount, total, priority, tenure, "
        "CAST(dense_rank() OVER (ORDER BY coalesce(city, 'missing')) - 1 AS BIGINT) AS city, los_days, y, "
        + ", ".join(f"coalesce(status, 'missing') = '{v}' AS status_{v}" for v in ("F", "O", "P")) + " FROM o9)",
        f"o11 AS (SELECT * REPLACE ({std('amount', 'o10')}) FROM o10)",
        f"o12 AS (SELECT * REPLACE ({std('total', 'o11')}) FROM o11)",
        f"o13 AS (SELECT * REPLACE ({std('los_days', 'o12')}) FROM o12)",
        "o14 AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY md5(CAST(id AS VARCHAR) || ':42')) <= "
        "floor(0.2 * count(*) OVER (PARTITION BY y)) THEN 'test' ELSE 'train' END AS split FROM o13)",
    ]
    cols = ["id", "amount", "total", "priority", "tenure", "city", "los_days", "y", "status_F", "status_O",
            "status_P", "split"]
    feats = ["amount", "total", "priority", "tenure", "city", "los_days"]
    sm, final = _smote_ctes("o14", cols, "y", "id", feats, {"city": "bigint"}, pool="split = 'train'")
    body = ("SELECT * REPLACE (" + ", ".join(f"round({n}, 6) AS {n}" for n in
                                             ("amount", "total", "priority", "tenure", "los_days")) + f") FROM ({final}) z")
    return with_(OD, *steps, *sm) + body


oracle("i04_apply_plan_orders", _orders_plan_sql())
