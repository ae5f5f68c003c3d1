import tempfile

from pyspark.sql import functions as F

from ripen.plans import runlog
from ripen.sources.dirty import lineitem_dirty
from ripen.streaming.apply import apply_fitted, fit_cleaning, stream_run_rewards

from conftest import SF


def test_fitted_projection_same_on_batch(spark):
    ld = lineitem_dirty(spark, SF)
    params = fit_cleaning(ld, ["l_tax", "l_extendedprice"])
    out = apply_fitted(ld, params)
    assert out.filter(F.col("l_tax").isNull()).count() == 0
    m = out.agg(F.avg("l_extendedprice")).first()[0]
    assert abs(m) < 1e-9


def test_stream_run_rewards_matches_batch(spark):
    path = f"{SF}/events.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    chk = tempfile.mkdtemp(prefix="ripen-stream-")
    q = (stream_run_rewards(stream).writeStream.outputMode("update").format("memory")
         .queryName("run_rewards").option("checkpointLocation", chk).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["run_id"]: (r["steps"], r["total_reward"]) for r in spark.sql("select * from run_rewards").collect()}
    log = runlog.run_log(spark.read.parquet(path))
    want = log.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"),
                                     F.round(F.sum(runlog.reward_expr()), 4).alias("r")).collect()
    assert len(got) == len(want)
    for r in want:
        assert got[r["run_id"]][0] == r["n"] and abs(got[r["run_id"]][1] - r["r"]) < 1e-9
