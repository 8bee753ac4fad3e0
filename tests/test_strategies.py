import json

from freshstate.operators import rollup
from freshstate.operators import strategies as ST

SNAP = "tick long, vin string, sensor string, value double, received_at long, seq long"


def test_batched_250_by_100(spark):
    data = [(0, f"VIN{i:03d}", "s", float(i), i, i) for i in range(250)]
    out = rollup.batched_payloads(spark.createDataFrame(data, SNAP), 100, 7).orderBy("msg_idx").collect()
    assert [r.num_of_data for r in out] == [100, 100, 50]
    p = json.loads(out[0].payload)
    assert p["num_of_data"] == 100 and len(p["data"]) == 100 and p["produced_at"] == 7
    assert p["data"][0]["id"] == "VIN000"


def test_batched_per_tick(spark):
    data = [(t, f"V{i}", "s", 1.0, 1, 1) for t in (10, 20) for i in range(5)]
    out = ST.log_compacted(spark.createDataFrame(data, SNAP), batch_size=2).collect()
    assert sorted((r.tick, r.num_of_data) for r in out) == [(10, 1), (10, 2), (10, 2), (20, 1), (20, 2), (20, 2)]


def test_global_index_dense(spark):
    df = spark.range(0, 1000).selectExpr("cast(id * 7 % 1000 as long) as k")
    got = sorted((r.k, r.idx) for r in rollup.global_index(df, ["k"], num_partitions=5).collect())
    assert [i for _, i in got] == list(range(1000)) and [k for k, _ in got] == list(range(1000))


def test_inline_one_message_per_device(spark):
    data = [(5, "VIN_A", "s1", 1.0, 1, 1), (5, "VIN_B", "s1", 2.0, 2, 2), (5, "VIN_A", "s2", 3.0, 3, 3)]
    out = ST.emit("inline", spark.createDataFrame(data, SNAP)).collect()
    assert sorted(r.key for r in out) == ["VIN_A", "VIN_B"]
    a = json.loads([r.value for r in out if r.key == "VIN_A"][0])
    assert set(a["data"]) == {"id", "s1", "s2"} and a["produced_at"] == 5


def test_state_store_view(spark):
    data = [(0, "V1", "s", 1.0, 1, 1), (600_000, "V2", "s", 1.0, 2, 2)]
    w = ST.state_store_writes(spark.createDataFrame(data, SNAP))
    keys = {r.key for r in ST.state_store_view(w, 600_000 + 60_000).collect()}
    assert keys == {"latest:V2"}   # V1 written 11 min earlier: expired after 5 min


def test_window_flush_last_flush_wins(spark):
    # ticks every 30 s, window 2 min, lateness 10 s
    data = [(0, "V", "s", 1.0, 1, 1), (30_000, "V", "s", 2.0, 2, 2), (60_000, "W", "s", 3.0, 3, 3),
            (150_000, "V", "s", 4.0, 4, 4)]
    out = ST.window_last_flush(spark.createDataFrame(data, SNAP), 30_000, 300_000).collect()
    got = {(r.window_start, r.vin): (r.value, r.produced_at, r.emit_tick) for r in out}
    assert got[(0, "V")] == (2.0, 120_000, 150_000)
    assert got[(0, "W")] == (3.0, 120_000, 150_000)
    assert got[(120_000, "V")] == (4.0, 240_000, 270_000)


def test_register_strategy(spark):
    @ST.register_strategy("count_only")
    def count_only(snapshot):
        return snapshot.groupBy("tick").count()
    data = [(0, "V", "s", 1.0, 1, 1)]
    assert ST.emit("count_only", spark.createDataFrame(data, SNAP)).first()["count"] == 1


def test_device_without_sensors_gets_a_message(spark):
    # state {"VIN1": {}} -> one message, id only, produced_at > 0
    data = [(5, "VIN1", None, None, None, None)]
    out = ST.emit("inline", spark.createDataFrame(data, SNAP)).collect()
    assert len(out) == 1 and out[0].key == "VIN1"
    p = json.loads(out[0].value)
    assert p["data"] == {"id": "VIN1"} and p["produced_at"] > 0
    w = ST.state_store_writes(spark.createDataFrame(data, SNAP)).first()
    assert w.n_sensors == 0
    b = rollup.batched_payloads(spark.createDataFrame(data, SNAP), 100, 7).first()
    assert json.loads(b.payload)["data"] == [{"id": "VIN1"}]
