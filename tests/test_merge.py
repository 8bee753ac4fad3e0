from hypothesis import given, settings
from hypothesis import strategies as st

from freshstate.operators import merge
from sim import fold_latest

LONG = "vin string, sensor string, value string, received_at long, seq long, arr long"


def rows(spark, data):
    return spark.createDataFrame(data, LONG)


def latest(spark, data):
    out = merge.latest_merge(rows(spark, data)).collect()
    return {(r.vin, r.sensor): (r.value, r.received_at, r.seq) for r in out}


def test_newer_received_at_wins(spark):
    assert latest(spark, [("VIN1", "a", "old", 100, 1, 1), ("VIN1", "a", "new", 200, 2, 2)])[("VIN1", "a")][0] == "new"


def test_older_does_not_overwrite(spark):
    assert latest(spark, [("VIN1", "x", "newer", 200, 1, 1), ("VIN1", "x", "older", 100, 2, 2)])[("VIN1", "x")][0] == "newer"


def test_different_sensors_union(spark):
    got = latest(spark, [("VIN1", "a", "1", 100, 1, 1), ("VIN1", "b", "2", 200, 2, 2)])
    assert set(got) == {("VIN1", "a"), ("VIN1", "b")}


def test_tie_later_arrival_wins(spark):
    assert latest(spark, [("VIN1", "a", "p", 100, 1, 1), ("VIN1", "a", "q", 100, 2, 2)])[("VIN1", "a")][0] == "q"


def test_negative_received_at_not_stored(spark):
    assert latest(spark, [("VIN1", "a", "neg", -1, 1, 1)]) == {}


def test_empty_vin_ignored(spark):
    got = latest(spark, [("", "a", "x", 1, 1, 1), ("VIN1", "a", "y", 1, 2, 2)])
    assert set(got) == {("VIN1", "a")}


def test_incremental_equals_one_merge(spark):
    data = [("V", "a", str(i), i % 3, i, i) for i in range(10)]
    s1 = merge.latest_merge(rows(spark, data[:4]))
    s2 = merge.merge_incremental(s1, rows(spark, data[4:]))
    assert {tuple(r) for r in s2.collect()} == {tuple(r) for r in merge.latest_merge(rows(spark, data)).collect()}


def test_batch_last_value_ignores_timestamps(spark):
    df = spark.createDataFrame([(0, "V", "a", "first", 500, 1), (0, "V", "a", "last", 100, 2)],
                               "batch_id long, vin string, sensor string, value string, received_at long, seq long")
    r = merge.batch_last_value(df).collect()
    assert [(x.value, x.received_at) for x in r] == [("last", 100)]


def test_received_at_default(spark):
    df = spark.createDataFrame([(0,), (42,)], "ts long")
    got = [r[0] for r in df.select(merge.received_at_default("ts", 999)).collect()]
    assert got == [999, 42]


def test_log_compact_keeps_last_offset(spark):
    df = spark.createDataFrame([("k1", "a", 0, 1), ("k1", "b", 0, 5), ("k2", "c", 3, 2)],
                               "key string, value string, partition int, offset long")
    got = {r.key: r.value for r in merge.log_compact(df).collect()}
    assert got == {"k1": "b", "k2": "c"}


msg = st.tuples(st.sampled_from(["", "V1", "V2"]), st.sampled_from(["a", "b"]),
                st.integers(0, 9).map(str), st.integers(-2, 5))


@settings(max_examples=15, deadline=None)
@given(st.lists(msg, min_size=1, max_size=25))
def test_kernel_matches_sequential_fold(spark, ms):
    data = [(v, s, val, ra, i, i) for i, (v, s, val, ra) in enumerate(ms)]
    assert latest(spark, data) == fold_latest(data)


NUM = "vin string, sensor string, value double, received_at long, seq long, arr long"

num_msg = st.tuples(st.sampled_from(["V1", "V2"]), st.sampled_from(["a", "b"]),
                    st.floats(-1e6, 1e6, allow_nan=False), st.integers(-2, 4_000_000_000_000))


@settings(max_examples=12, deadline=None)
@given(st.lists(num_msg, min_size=1, max_size=25), st.booleans())
def test_hash_aggregate_path_matches_fold(spark, ms, negative_seq):
    # fixed-width carry -> decimal ordering key + hash aggregate; seq may be negative
    base = -(2 ** 62) if negative_seq else 0
    data = [(v, s, val, ra, base + i, i) for i, (v, s, val, ra) in enumerate(ms)]
    df = spark.createDataFrame(data, NUM)
    out = merge.latest_merge(df)
    assert "HashAggregate" in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.vin, r.sensor): (r.value, r.received_at, r.seq) for r in out.collect()}
    assert got == fold_latest(data)


def test_order_key_orders_like_the_pair(spark):
    pairs = [(0, -(2 ** 63)), (0, 2 ** 63 - 1), (1, -(2 ** 63)), (1_700_000_000_000, 5), (1_700_000_000_000, 6)]
    df = spark.createDataFrame(pairs, "received_at long, seq long")
    keys = [r.k for r in df.select(merge.order_key().alias("k")).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_transform_chain(spark):
    # Processors compose with DataFrame.transform
    from freshstate.operators.lookup import lookup_inner
    from freshstate.operators.rollup import device_rollup
    from freshstate.plans.telemetry import sensor_dictionary
    rows = spark.createDataFrame([("V", "view", "1", 5, 1, 1), ("V", "signup", "2", 6, 2, 2), ("V", "view", "3", 4, 3, 3)],
                                 "vin string, resource_id string, value string, received_at long, seq long, arr long")
    out = (rows.transform(lookup_inner, sensor_dictionary(spark))
           .transform(merge.latest_merge).transform(device_rollup)).collect()
    assert len(out) == 1 and dict(out[0].metrics)["page_view"].value == "1"


def test_order_key_is_exact_at_the_extremes(spark):
    top = 2 ** 63 - 1
    data = [("V", "a", 1.0, top, -(2 ** 63), 0), ("V", "a", 2.0, top, top, 0), ("V", "a", 3.0, top - 1, top, 0),
            ("W", "a", 4.0, 0, -(2 ** 63), 0), ("W", "a", 5.0, 0, top, 0)]
    out = merge.latest_merge(spark.createDataFrame(data, LONG.replace("value string", "value double")))
    assert {r.vin: r.value for r in out.collect()} == {"V": 2.0, "W": 5.0}
