"""Analytics over a run log (many runs of action steps).

The log is derived from ``events`` (run = user, one step per event in
(ts, event_id) order).  Step numbers and cumulative rewards use the
distributed running aggregate (hot runs split across tasks); the EDA gate
uses each run's first successful step per EDA action (at most 8 per run)
instead of a growing set over a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.rand import u01
from ..functions.running import running
from .actions import ALL_ACTIONS, PHASE_ACTIONS, phase_of

# Fixed values of the scoring rules.
EDA_MIN = {1: 4, 2: 5, 3: 6}
MAX_STEPS = {1: 18, 2: 22, 3: 28}
TASK_ISSUES = {1: 5, 2: 7, 3: 10}
STEP_COST, INVALID, CRITICAL_FIX, ISSUE_FIX = -0.005, -0.05, 0.15, 0.08
W_COVERAGE, W_READINESS, W_ORDER, W_EFFICIENCY = 0.35, 0.25, 0.25, 0.15
ORDER_PENALTY = 0.05
REPRODUCIBLE = 0.001


def _lit_map(d: dict):
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def run_log(events: DataFrame) -> DataFrame:
    """(run_id, task_id, step, action_type, phase, success, blocked,
    readiness_before, readiness_after, critical_fixed, other_fixed)."""
    e = F.col("event_id")
    acts = F.array(*[F.lit(a) for a in ALL_ACTIONS])
    action = F.element_at(acts, (e % len(ALL_ACTIONS) + 1).cast("int"))
    base = events.select(F.col("user_id").alias("run_id"), "ts", "event_id", "value")
    base = base.select("*", action.alias("action_type")).withColumn("phase", phase_of(F.col("action_type")))
    blocked = (F.col("phase") != "eda") & (u01(e, "blk") < 0.1)
    success = ~blocked & (u01(e, "ok") < 0.85)
    before = F.round(u01(e, "rb"), 4)
    log = base.select(
        "run_id", (F.col("run_id") % 3 + 1).cast("int").alias("task_id"), "ts", "event_id", "action_type",
        "phase", success.alias("success"), blocked.alias("blocked"), before.alias("readiness_before"),
        F.round(before + F.when(success, F.lit(0.02) * u01(e, "ra")).otherwise(F.lit(0.0)), 4)
        .alias("readiness_after"),
        (success & (u01(e, "cf") < 0.05)).cast("int").alias("critical_fixed"),
        (success & (u01(e, "of") < 0.2)).cast("int").alias("other_fixed"))
    return running(log, ["run_id"], ["ts", "event_id"], row_number="step")


def eda_gate(log: DataFrame) -> DataFrame:
    """A cleaning/engineering step preceded by fewer than ``eda_min``
    distinct successful EDA actions is a violation."""
    eda = PHASE_ACTIONS["eda"]
    firsts = (log.filter(F.col("success") & F.col("action_type").isin(eda))
              .groupBy("run_id", "action_type").agg(F.min("step").alias("first"))
              .groupBy("run_id").agg(F.collect_list("first").alias("firsts")))   # <= 8 per run
    j = log.join(firsts, "run_id", "left")
    done = F.size(F.filter(F.coalesce(F.col("firsts"), F.array().cast("array<bigint>")),
                           lambda x: x < F.col("step")))
    need = _lit_map(EDA_MIN)[F.col("task_id")]
    gated = F.col("phase").isin("cleaning", "engineering")
    return j.select("run_id", "step", "action_type", done.cast("bigint").alias("eda_done"),
                    (gated & (done < need)).alias("violation"))


def phase_progress(log: DataFrame) -> DataFrame:
    """Running count of successful steps per phase."""
    sums = {f"progress_{p}": (F.col("success") & (F.col("phase") == p)).cast("bigint")
            for p in ("eda", "cleaning", "engineering", "validation")}
    r = running(log.select("run_id", "step", "success", "phase"), ["run_id"], ["step"], sums, row_number=None)
    return r.select("run_id", "step", *sums.keys())


def reward_expr() -> F.Column:
    delta = F.round(F.col("readiness_after") - F.col("readiness_before"), 4)
    fixes = F.lit(CRITICAL_FIX) * F.col("critical_fixed") + F.lit(ISSUE_FIX) * F.col("other_fixed")
    ok = F.when(F.col("success"), F.lit(STEP_COST)).otherwise(F.lit(INVALID))
    return F.when(F.col("blocked"), F.lit(INVALID)).otherwise(F.round(delta + fixes + ok, 4))


def rewards(log: DataFrame) -> DataFrame:
    """J4 + J5: per-step reward and its running sum per run."""
    r = log.select("run_id", "step", reward_expr().alias("reward"))
    r = running(r, ["run_id"], ["step"], {"cumulative": F.col("reward")}, row_number=None)
    return r.select("run_id", "step", (F.round("reward", 4) + F.lit(0.0)).alias("reward"),
                    (F.round("cumulative", 4) + F.lit(0.0)).alias("cumulative_reward"))


def round4(x: F.Column) -> F.Column:
    """Half-up at 4 digits after dropping binary noise at 10 digits, so a
    score of exactly .xxxx5 rounds up in any engine."""
    return F.round(x.cast("decimal(38,10)"), 4).cast("double")


def run_scores(log: DataFrame) -> DataFrame:
    """J6-J8 per run: phase-order score, efficiency, coverage, readiness, score."""
    g = log.groupBy("run_id", "task_id").agg(
        F.count(F.lit(1)).alias("steps"), F.count_if("blocked").alias("n_blocked"),
        F.sum("critical_fixed").alias("cf"), F.sum("other_fixed").alias("of"),
        F.max_by("readiness_after", "step").alias("readiness"))
    order = F.greatest(F.lit(0.0), F.lit(1.0) - F.lit(ORDER_PENALTY) * F.col("n_blocked"))
    eff = F.round(F.lit(1.0) - F.col("steps") / F.greatest(_lit_map(MAX_STEPS)[F.col("task_id")], F.lit(1)), 4)
    cov = F.least(F.lit(1.0), (F.col("cf") + F.col("of")) / _lit_map(TASK_ISSUES)[F.col("task_id")])
    score = (F.lit(W_COVERAGE) * cov + F.lit(W_READINESS) * F.col("readiness")
             + F.lit(W_ORDER) * order + F.lit(W_EFFICIENCY) * eff)
    return g.select("run_id", "task_id", "steps", F.round(order, 4).alias("phase_order"),
                    eff.alias("efficiency"), F.round(cov, 4).alias("coverage"), "readiness",
                    round4(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).alias("score"))


def task_summary(scores: DataFrame) -> DataFrame:
    """Mean score per task and the spread across its runs."""
    return scores.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("runs"), F.round(F.avg("score"), 6).alias("mean_score"),
        F.round(F.max("score") - F.min("score"), 6).alias("spread")).withColumn(
        "reproducible", F.col("spread") < F.lit(REPRODUCIBLE))
