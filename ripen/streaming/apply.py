"""Structured Streaming: fitted cleaning on a stream, and live run scores.

Cleaning operators split into *fit* (bounded aggregate jobs over a batch
table) and *transform* (a projection of literals).  ``fit_cleaning`` does
the fit once on a batch table; ``apply_fitted`` then applies the same
projection to a streaming DataFrame, so new rows are imputed, clipped and
scaled exactly like the batch.  ``stream_run_rewards`` keeps per-run reward
totals over an event stream (watermarked, update mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.quantile import exact_quantiles
from ..functions.stats import c
from ..operators.profile import fence_bounds
from ..plans import runlog


def fit_cleaning(batch: DataFrame, columns: list[str], clip: bool = True, scale: bool = True) -> dict:
    """Fit median fill, IQR fences and standard scaling for numeric columns
    on a batch table (one quantile selection + one aggregate pass)."""
    qs = exact_quantiles(batch, [c(n).cast("double") for n in columns], [0.25, 0.5, 0.75])
    params = {}
    exprs = []
    for n, (q1, med, q3) in zip(columns, qs):
        lo, hi = fence_bounds(q1, q3)
        params[n] = {"median": med, "lo": lo, "hi": hi}
        x = F.coalesce(c(n).cast("double"), F.lit(med))
        if clip:
            x = F.greatest(F.least(x, F.lit(hi)), F.lit(lo))
        exprs += [F.avg(x).alias(f"m_{n}"), F.stddev_samp(x).alias(f"s_{n}")]
    row = batch.agg(*exprs).first()
    for n in columns:
        params[n].update({"mean": row[f"m_{n}"], "std": row[f"s_{n}"] or 1.0, "clip": clip, "scale": scale})
    return params


def apply_fitted(df: DataFrame, params: dict) -> DataFrame:
    """Pure projection of fitted literals: works on batch and streaming input."""
    out = []
    for n in df.columns:
        if n not in params:
            out.append(c(n))
            continue
        p = params[n]
        x = F.coalesce(c(n).cast("double"), F.lit(p["median"]))
        if p["clip"]:
            x = F.greatest(F.least(x, F.lit(p["hi"])), F.lit(p["lo"]))
        if p["scale"]:
            x = (x - F.lit(p["mean"])) / F.lit(p["std"])
        out.append(x.alias(n))
    return df.select(*out)


def stream_run_rewards(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Per-run totals over an event stream: steps, blocked steps, total
    reward.  Each event's reward is a stateless projection; the per-run
    state is Spark's streaming aggregate state (checkpointed by the sink)."""
    e = F.col("event_id")
    acts = F.array(*[F.lit(a) for a in runlog.ALL_ACTIONS])
    action = F.element_at(acts, (e % len(runlog.ALL_ACTIONS) + 1).cast("int"))
    # watermarks need TIMESTAMP; the tables carry TIMESTAMP_NTZ (read as UTC)
    steps = (events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
             .select(F.col("user_id").alias("run_id"), "ts", "event_id", action.alias("action_type")))
    steps = steps.withColumn("phase", runlog.phase_of(F.col("action_type")))
    blocked = (F.col("phase") != "eda") & (runlog.u01(e, "blk") < 0.1)
    success = ~blocked & (runlog.u01(e, "ok") < 0.85)
    before = F.round(runlog.u01(e, "rb"), 4)
    rows = steps.select(
        "run_id", blocked.alias("blocked"), success.alias("success"), before.alias("readiness_before"),
        F.round(before + F.when(success, F.lit(0.02) * runlog.u01(e, "ra")).otherwise(F.lit(0.0)), 4)
        .alias("readiness_after"),
        (success & (runlog.u01(e, "cf") < 0.05)).cast("int").alias("critical_fixed"),
        (success & (runlog.u01(e, "of") < 0.2)).cast("int").alias("other_fixed"))
    return rows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("steps"), F.count_if("blocked").alias("n_blocked"),
        F.round(F.sum(runlog.reward_expr()), 4).alias("total_reward"))
