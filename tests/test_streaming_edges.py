"""Bulk bootstrap of the state and its hand-over to a stream; readings behind the watermark."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from freshstate.streaming import latest as SL
from freshstate.streaming import topic_merge as TM
from freshstate.streaming.stats import MetricsCollector
from freshstate.streaming.window import windowed_latest
from test_streaming import SCHEMA, TOPIC, msg, write_batches

T0 = dt.datetime(2024, 1, 1)


def topic(spark, numbers):
    rows = [(None, msg(f"VIN{i % 7}", "ab"[i % 2], str(i), (i * 5) % 11), i % 3, i // 3, T0 + dt.timedelta(seconds=i)) for i in numbers]
    return spark.createDataFrame(rows, TOPIC)


@pytest.mark.parametrize("ttl", [None, 600_000])
def test_bootstrap_and_hand_over_equal_all_streaming(spark, scratch, ttl):
    src, boot = scratch("topic"), scratch("boot")
    topic(spark, range(60)).write.parquet(src)
    ends = TM.bootstrap_merge(spark.read.schema(TOPIC).parquet(src), boot, 1000, ttl_ms=ttl)
    assert ends == {0: 20, 1: 20, 2: 20}
    assert TM.starting_offsets("t", ends) == '{"t": {"0": 20, "1": 20, "2": 20}}'
    state, ckpt = scratch("state"), scratch("ckpt")
    whole, whole_ckpt = scratch("whole"), scratch("whole_ckpt")

    def run(now):
        stream = spark.readStream.schema(TOPIC).parquet(src)
        TM.start_merge(TM.records_from(stream, ends), state, ckpt, bootstrap=boot, ttl_ms=ttl, clock=lambda: now).awaitTermination()
        TM.start_merge(spark.readStream.schema(TOPIC).parquet(src), whole, whole_ckpt, ttl_ms=ttl, clock=lambda: now).awaitTermination()

    def rows(path):
        return sorted(tuple(r) for r in SL.read_state(spark, path).select("vin", "sensor", F.to_json("value"), "received_at", "seq", "last_seen").collect())
    for k, now in enumerate((1000, 2000, 3000)):              # each run after the first is a restart
        topic(spark, range(60 + 10 * k, 70 + 10 * k)).write.mode("append").parquet(src)
        run(now)
        assert rows(state) == rows(whole)


def test_records_that_arrive_during_the_bootstrap_are_left_to_the_stream(spark):
    records, ends = topic(spark, range(30)), {0: 4, 1: 3}
    assert TM.records_upto(records, ends).count() == 7 and TM.records_from(records, ends).count() == 23
    assert TM.records_upto(records, {}).count() == 0 and TM.records_from(records, {}).count() == 30


def test_late_readings_are_counted(spark, scratch):
    base = 1_704_067_200_000
    src, out, ckpt = scratch("src"), scratch("out"), scratch("ckpt")
    seen = MetricsCollector()
    spark.streams.addListener(seen)
    try:
        for k, batch in enumerate(([("V", "s", "a", 1, 1, base + 1_000)], [("V", "s", "b", 1, 2, base + 600_000)],
                                   [("V", "s", "late", 9, 3, base + 2_000), ("W", "s", "late", 9, 4, base + 3_000), ("V", "s", "c", 2, 5, base + 601_000)])):
            write_batches(spark, f"{src}/{k}", [batch])
            stream = spark.readStream.schema(SCHEMA).parquet(f"{src}/*/*").withColumn("event_time", F.timestamp_millis("arr"))
            (windowed_latest(stream, "event_time", 120_000, 10_000).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
        deadline = time.time() + 20
        while seen.late_rows < 2 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(seen)
    assert seen.late_rows == 2
    assert "late" not in {r.value for r in spark.read.parquet(out).collect()}
