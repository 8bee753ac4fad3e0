import json

from pyspark.sql import functions as F

from freshstate.operators import merge
from freshstate.streaming import latest as SL
from freshstate.streaming import sinks
from freshstate.streaming.tables import VersionedTable
from freshstate.streaming.window import windowed_latest

SCHEMA = "vin string, sensor string, value string, received_at long, seq long, arr long"


def write_batches(spark, path, batches):
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/part{i:03d}")


def test_stream_equals_batch(spark, scratch):
    data = [(f"V{i % 3}", "ab"[i % 2], str(i), (i * 7) % 5, i, i) for i in range(30)]
    src = scratch("src")
    write_batches(spark, src, [data[:10], data[10:20], data[20:]])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    state = scratch("state")
    q = SL.start_latest_state(stream, state, scratch("ck"))
    q.awaitTermination()
    got = {tuple(r) for r in SL.read_state(spark, state).where("sensor is not null")
           .select("vin", "sensor", "value", "received_at", "seq").collect()}
    want = {tuple(r) for r in merge.latest_merge(spark.createDataFrame(data, SCHEMA))
            .select("vin", "sensor", "value", "received_at", "seq").collect()}
    assert got == want
    table = VersionedTable(spark, state)
    assert table.versions() == [1, 2]          # three batches, the last two versions retained


def test_only_touched_buckets_are_rewritten(spark, scratch):
    fn = SL.LatestStateBatch(scratch("state"), clock=lambda: 0, buckets=32)
    fn(spark.createDataFrame([(f"V{i}", "s", "1", 1, i, i) for i in range(40)], SCHEMA), 0)
    fn(spark.createDataFrame([("V3", "s", "2", 2, 99, 99)], SCHEMA), 1)
    held = VersionedTable(spark, fn.state_path).manifest()["buckets"]
    assert sorted(held.values()).count(1) == 1 and len(held) > 10
    got = {r.vin: r.value for r in SL.read_state(spark, fn.state_path).collect()}
    assert got["V3"] == "2" and len(got) == 40
    fn(spark.createDataFrame([("V3", "s", "2", 2, 99, 99)], SCHEMA), 1)     # a retried batch rewrites its version
    assert SL.read_state(spark, fn.state_path).count() == 40


def test_rebuild_over_an_existing_path_starts_empty(spark, scratch):
    state = scratch("state")
    for vins, ck in ((["OLD", "BOTH"], "ck1"), (["NEW", "BOTH"], "ck2")):
        src = scratch("src")
        write_batches(spark, src, [[(v, "s", ck, 1, i, i)] for i, v in enumerate(vins)])
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
        SL.start_latest_state(stream, state, scratch(ck)).awaitTermination()
    assert {(r.vin, r.value) for r in SL.read_state(spark, state).collect()} == {("NEW", "ck2"), ("BOTH", "ck2")}


def test_flush_statistics(spark, scratch):
    seen = []
    fn = SL.LatestStateBatch(scratch("state"), strategy="log_compacted", strategy_options={"batch_size": 2},
                             emit_fn=lambda df, i: df.collect(), clock=lambda: 5, stats_fn=seen.append)
    fn(spark.createDataFrame([(f"V{i}", s, "1", 1, i, i) for i in range(3) for s in "ab"], SCHEMA), 0)
    assert [(s["vin_count"], s["value_count"], s["message_count"]) for s in seen] == [(3, 6, 2)]
    assert seen[0]["duration_ms"] >= 0


def test_flush_evicts_idle_devices(spark, scratch):
    clock = iter([0, 5 * 60_000, 11 * 60_000])
    emitted = []
    fn = SL.LatestStateBatch(scratch("state"), ttl_ms=10 * 60_000, strategy="inline",
                             emit_fn=lambda df, i: emitted.append((i, sorted(r.key for r in df.collect()))),
                             clock=lambda: next(clock))
    fn(spark.createDataFrame([("VIN_A", "s", "1", 1, 1, 1), ("VIN_B", "s", "2", 1, 2, 2)], SCHEMA), 0)
    fn(spark.createDataFrame([("VIN_B", "s", "3", 2, 3, 3)], SCHEMA), 1)
    fn(spark.createDataFrame([("VIN_C", None, None, None, 4, 4)], SCHEMA), 2)
    # at 11 min: VIN_A (seen at 0) is evicted, VIN_B (seen at 5 min) kept; VIN_C has
    # no sensors but is live, so it is emitted with an id-only payload
    assert emitted[0] == (0, ["VIN_A", "VIN_B"])
    assert emitted[2] == (2, ["VIN_B", "VIN_C"])
    st = SL.read_state(spark, fn.state_path).collect()
    assert {r.vin for r in st} == {"VIN_B", "VIN_C"}
    assert [r.sensor for r in st if r.vin == "VIN_C"] == [None]


def test_window_stream_with_sentinel(spark, scratch):
    base = 1_704_067_200_000
    data = [("V", "s", "a", 5, 1, base + 1_000), ("V", "s", "b", 3, 2, base + 2_000),
            ("V", "s", "c", 1, 3, base + 130_000), ("V", "s", "late", 9, 4, base + 500_000_000)]
    src = scratch("wsrc")
    write_batches(spark, src, [data])
    stream = (spark.readStream.schema(SCHEMA).parquet(f"{src}/*")
              .withColumn("event_time", F.timestamp_millis("arr")))
    out = scratch("wout")
    q = (windowed_latest(stream, "event_time", 120_000, 10_000).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", scratch("wck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.window_start - base, r.value) for r in spark.read.parquet(out).collect())
    assert got == [(0, "a"), (120_000, "c")]


def test_kafka_options():
    o = sinks.kafka_source_options("b:9092", "aggregated", group_id="merger")
    assert o["startingOffsets"] == "earliest" and o["subscribe"] == "aggregated" and o["kafka.group.id"] == "merger"
    assert "failOnDataLoss" not in o       # lost offsets fail the replay, unless a caller says otherwise
    assert sinks.kafka_source_options("b:9092", "t", failOnDataLoss="false")["failOnDataLoss"] == "false"
    assert sinks.kafka_sink_options("b:9092", "out")["topic"] == "out"


def test_write_topic_rows(spark, scratch):
    path = scratch("sink")
    sinks.write_topic(spark.createDataFrame([("V1", 1.5, 9)], "key string, value double, other int"), "b:9092", "t",
                      fmt="parquet", path=path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("V1", "1.5")]


def test_route_counts_are_observed_in_the_merge(spark, scratch):
    from freshstate.streaming.stats import MetricsCollector
    seen = MetricsCollector()
    spark.streams.addListener(seen)
    try:
        run_merge(spark, scratch, [msg("V", "a", "1", 1), '{"_flush":true}', "bad", '{"_flush":true} x', "{}"])
        import time as _t
        for _ in range(50):
            found = [e["metrics"]["route_counts"] for e in seen.events if "route_counts" in e["metrics"]]
            if found:
                break
            _t.sleep(0.2)
    finally:
        spark.streams.removeListener(seen)
    total = {k: sum(f[k] for f in found) for k in ("flushes", "errors", "skips", "telemetry")}
    assert total == {"flushes": 1, "errors": 2, "skips": 1, "telemetry": 1}


def test_noop_sink(spark):
    sinks.write_noop(spark.range(10))


def test_route_metrics(spark):
    from freshstate.operators.messages import with_route
    from freshstate.streaming.stats import observe_routes
    df = spark.createDataFrame([('{"_flush":true}',), ("bad",), ('{"data":{"id":"V"}}',)], "value string")
    obs = observe_routes(with_route(df))
    assert obs.count() == 3
    assert json.dumps(sorted(r.route for r in obs.collect())) == json.dumps(["error", "flush", "telemetry"])


def test_state_store_emitter(spark, scratch):
    from freshstate.streaming.emitters import StateStoreEmitter
    clock = iter([0, 4 * 60_000, 8 * 60_000])
    em = StateStoreEmitter(scratch("kv"))
    fn = SL.LatestStateBatch(scratch("state"), ttl_ms=None, emitter=em, clock=lambda: next(clock))
    fn(spark.createDataFrame([("V1", "s", "1", 1, 1, 1)], SCHEMA), 0)
    fn(spark.createDataFrame([("V2", "s", "2", 1, 2, 2)], SCHEMA), 1)
    fn(spark.createDataFrame([("V2", "s", "3", 2, 3, 3)], SCHEMA), 2)
    # every flush re-writes every live device, so both keys stay fresh
    view = {r.key: r.produced_at for r in em.view(spark, 8 * 60_000 + 1).collect()}
    assert view == {"latest:V1": 8 * 60_000, "latest:V2": 8 * 60_000}
    got = json.loads([r.value for r in em.view(spark, 8 * 60_000).collect() if r.key == "latest:V2"][0])
    assert got["data"]["s"]["value"] == "3"


def test_window_stream_emitter(spark, scratch):
    from freshstate.streaming.emitters import WindowStreamEmitter
    out = []
    em = WindowStreamEmitter(scratch("buf"), lambda df, i: out.extend(
        (i, r.window_start, r.key, json.loads(r.value)) for r in df.collect()), 120_000, 10_000)
    clock = iter([0, 30_000, 60_000, 150_000])
    fn = SL.LatestStateBatch(scratch("state"), emitter=em, clock=lambda: next(clock))
    fn(spark.createDataFrame([("V", "s", "a", 1, 1, 1)], SCHEMA), 0)
    fn(spark.createDataFrame([("V", "s", "b", 2, 2, 2)], SCHEMA), 1)
    fn(spark.createDataFrame([("W", "s", "c", 1, 3, 3)], SCHEMA), 2)
    assert out == []
    fn(spark.createDataFrame([("V", "s", "d", 3, 4, 4)], SCHEMA), 3)
    # window [0, 120 s) closes at 130 s: last flush in it (60 s) wins per device
    assert sorted((i, w, k, m["data"]["s"]["value"], m["produced_at"]) for i, w, k, m in out) == [
        (3, 0, "V", "b", 120_000), (3, 0, "W", "c", 120_000)]


def test_idle_ticks_flush_and_evict(spark, scratch):
    import time as _t
    src = scratch("src")
    write_batches(spark, src, [[("VIN_A", "s", "1", 1, 1, 1)]])
    files = spark.readStream.schema(SCHEMA).parquet(f"{src}/*")
    ticks = SL.with_flush_ticks(files, rows_per_second=1)
    calls = {"n": 0}

    def clock():
        calls["n"] += 1
        return calls["n"] * 6 * 60_000      # every flush is 6 minutes later
    seen = []
    state = scratch("state")
    q = SL.start_latest_state(ticks, state, scratch("ck"), trigger={"processingTime": "1 second"},
                              ttl_ms=10 * 60_000, strategy="inline", clock=clock,
                              emit_fn=lambda df, i: seen.append(sorted(r.key for r in df.collect())))
    deadline = _t.time() + 90
    while len(seen) < 4 and _t.time() < deadline:
        _t.sleep(1)
    q.stop()
    # flushes keep running without new data; VIN_A (seen at 6 min) is gone by 18 min
    assert seen[0] == ["VIN_A"] and ["VIN_A"] not in seen[2:4] and len(seen) >= 4


TOPIC = "key string, value string, partition int, offset long, timestamp timestamp"


def run_merge(spark, scratch, messages):
    """Scenario 6: topic records through the merge half; returns emitted (key, payload)."""
    import datetime as dt
    from freshstate.streaming.emitters import TopicEmitter
    from freshstate.streaming.topic_merge import start_merge
    src = scratch("topic")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(None, m, 0, i, t0 + dt.timedelta(seconds=i)) for i, m in enumerate(messages)]
    spark.createDataFrame(rows, TOPIC).coalesce(1).write.parquet(src)
    out = []
    em = TopicEmitter("inline", lambda df, i: out.extend((r.key, json.loads(r.value)) for r in df.collect()))
    q = start_merge(spark.readStream.schema(TOPIC).parquet(src), scratch("state"), scratch("ck"),
                    ttl_ms=10 * 60_000, emitter=em, clock=lambda: 1_704_067_260_000)
    q.awaitTermination()
    return out


def msg(vin, sensor, value, ra):
    return json.dumps({"num_of_data": 1, "data": {"id": vin, sensor: {"value": value, "received_at": ra}},
                       "produced_at": 1})


def test_scenario_6_1_latest_per_sensor(spark, scratch):
    out = run_merge(spark, scratch, [msg("VIN1", "a", "1", 100), msg("VIN1", "a", "2", 200),
                                     msg("VIN1", "b", "x", 50), msg("VIN1", "a", "old", 150),
                                     '{"_flush":true}', "not json", '{"data":{"id":""}}'])
    assert len(out) == 1 and out[0][0] == "VIN1"
    data = out[0][1]["data"]
    assert data["a"] == {"value": "2", "received_at": 200} and data["b"]["value"] == "x"


def test_scenario_6_2_two_devices(spark, scratch):
    out = run_merge(spark, scratch, [msg("VIN1", "a", "1", 1), msg("VIN2", "a", "2", 2), '{"_flush": true}'])
    assert sorted(k for k, _ in out) == ["VIN1", "VIN2"]


def test_scenario_6_3_only_flush_triggers(spark, scratch):
    assert run_merge(spark, scratch, ['{"_flush":true}', '{"_flush":true}']) == []


def test_id_only_device_is_flushed(spark, scratch):
    out = run_merge(spark, scratch, ['{"data":{"id":"VIN1"}}', '{"_flush":true}'])
    assert len(out) == 1 and out[0][0] == "VIN1" and out[0][1]["data"] == {"id": "VIN1"}
