"""A device holding a third of all rows: results stay exact and the heavy
aggregations combine map-side before any shuffle."""

from pyspark.sql import functions as F

from freshstate.operators import merge, snapshot
from sim import fold_latest, simulate


def skewed(spark, n=3000):
    # every third row belongs to HOT; the rest spread over 50 devices
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("D"), (F.col("id") % 50).cast("string"))).alias("vin"),
        F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("sensor"),
        F.col("id").cast("string").alias("value"),
        ((F.col("id") * 7919) % 1000).alias("received_at"),
        F.col("id").alias("seq"),
        (F.col("id") * 1000).alias("arr"))


def test_hot_device_latest_exact_and_combined(spark):
    df = skewed(spark)
    rows = [tuple(r) for r in df.collect()]
    out = merge.latest_merge(df)
    got = {(r.vin, r.sensor): (r.value, r.received_at, r.seq) for r in out.collect()}
    assert got == fold_latest(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan            # map-side combine before the shuffle


def test_hot_device_snapshot_exact(spark):
    df = skewed(spark, 1200)
    rows = [tuple(r) for r in df.collect()]
    period, ttl, t_end = 50_000, 120_000, 1_300_000
    got = {(r.tick, r.vin, r.sensor): (r.value, r.received_at, r.seq)
           for r in snapshot.snapshots(df, period, ttl, t_end).collect()}
    want, _ = simulate(rows, period, ttl, t_end)
    assert got == want
    plan = snapshot.interval_table(df, period)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "partial_min" in plan
