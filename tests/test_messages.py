import json
import re

from pyspark.sql import functions as F

from freshstate.operators import messages as M


def routes(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq long, value string")
    return [r.route for r in M.with_route(df).orderBy("seq").collect()]


def test_flush_triggers(spark):
    # fixture table 1: flush column and the resulting route
    assert routes(spark, ['{"_flush":true}', '{"_flush": true}', '{"_flush":false}', "{}", "not json",
                          '{"x":1}', '{"_flush":"true"}']) == \
        ["flush", "flush", "skip", "skip", "error", "skip", "skip"]


def test_payload_errors(spark):
    assert routes(spark, [
        '{"data":{"id":"V","s":"oops"}}',                        # sensor not an object
        '{"data":[{"id":"V"}]}',                                  # batched payload
        '{"data":{"id":"V","s":{"value":1,"received_at":"5"}}}',  # string received_at
        '{"data":{"id":"V","s":{"value":1,"received_at":1.5}}}',  # non-integer
        '{"num_of_data":"1","data":{"id":"V"}}',                  # string count
        '[1,2]',                                                  # not an object
        '{"data":{"id":5}}',                                      # id not a string
    ]) == ["error"] * 7


def test_payload_ok_and_skip(spark):
    assert routes(spark, [
        '{"data":{"id":"V","s":null}}',
        '{"data":{"id":"V"}}',
        '{"data":{"s":{"value":1,"received_at":2}}}',
        'null',
        '{"data":null}',
    ]) == ["telemetry", "telemetry", "skip", "skip", "skip"]


def decode(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq long, value string")
    out = M.decode_payloads(df, keep=("seq",), **kw)
    return [(r.seq, r.vin, r.sensor, None if r.value is None else json.loads(r.value.toJson()), r.received_at,
             r.produced_at) for r in out.orderBy("seq", "sensor").collect()]


def test_decode_basic_and_key_order(spark):
    a = '{"num_of_data":1,"data":{"id":"VIN1","sensor_a":{"value":"88.5","received_at":1700000000123}},"produced_at":1700000005000}'
    b = '{"data":{"sensor_a":{"value":"88.5","received_at":1700000000123},"id":"VIN1"}}'
    got = decode(spark, [a, b])
    assert got[0] == (0, "VIN1", "sensor_a", "88.5", 1700000000123, 1700000005000)
    assert got[1][1:5] == ("VIN1", "sensor_a", "88.5", 1700000000123)


def test_decode_id_only_and_nulls(spark):
    got = decode(spark, ['{"data":{"id":"VIN1"}}', '{"data":{"id":"V2","s":null,"t":{"value":3}}}'],
                 with_device_rows=True)
    assert got[0] == (0, "VIN1", None, None, None, 0)
    assert (1, "V2", "s", None, 0, 0) in got and (1, "V2", "t", 3, 0, 0) in got


def test_flushes_and_telemetry_from_one_parse(spark):
    texts = ['{"_flush":true}', '{"data":{"id":"V","s":{"value":1,"received_at":2}}}', '{"_flush":true,"data":{"id":"V","s":"oops"}}',
             '{"_flush":"true"}', "not json", '{"data":{"id":"W"}}', '{"_flush":false,"data":{"id":"V"}}', None]
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, value string")
    plain = M.decode_payloads(df, keep=("seq",), with_device_rows=True)
    both = M.decode_payloads(df, keep=("seq",), with_device_rows=True, with_flushes=True)
    assert both.columns == [*plain.columns, "flush"]
    shown = lambda d: sorted((tuple(str(x) for x in r) for r in d.collect()))
    assert shown(both.where("NOT flush").drop("flush")) == shown(plain)
    routed = M.with_route(df).where(F.col("route") == M.ROUTE_FLUSH).select("seq")
    assert sorted(r.seq for r in both.where("flush").collect()) == sorted(r.seq for r in routed.collect()) == [0, 2]
    assert both.where("flush AND coalesce(vin, sensor, to_json(value), received_at) IS NOT NULL").count() == 0


def test_duplicate_keys_last_wins(spark):
    got = decode(spark, ['{"data":{"id":"A","s":{"value":1,"received_at":1},"id":"B"}}'])
    assert got[0][1] == "B"


def test_encode_roundtrip(spark):
    df = spark.createDataFrame([("VIN1", "b", 1.5, 10), ("VIN1", "a", None, 20), ("V2", "z", 7.0, 5)],
                               "vin string, sensor string, value double, received_at long")
    enc = M.encode_devices(df, 123)
    payloads = {r.vin: json.loads(r.payload) for r in enc.collect()}
    assert payloads["VIN1"] == {"num_of_data": 1, "produced_at": 123,
                                "data": {"id": "VIN1", "a": {"value": None, "received_at": 20},
                                         "b": {"value": 1.5, "received_at": 10}}}
    # keys are emitted in sorted order
    raw = enc.where(F.col("vin") == "VIN1").first().payload
    assert raw.index('"a"') < raw.index('"b"') < raw.index('"id"')
    back = M.decode_payloads(enc, raw="payload", keep=())
    got = {(r.vin, r.sensor, r.received_at) for r in back.collect()}
    assert got == {("VIN1", "a", 20), ("VIN1", "b", 10), ("V2", "z", 5)}


def test_encode_omits_empty_id(spark):
    df = spark.createDataFrame([("", "s", 1.0, 1)], "vin string, sensor string, value double, received_at long")
    p = json.loads(M.encode_devices(df, 1).first().payload)
    assert "id" not in p["data"]


def test_key_extract(spark):
    df = spark.createDataFrame([('{"data":{"id":"V1"}}',), ('{"data":[1]}',), ("nope",), ('{"_flush":true}',)],
                               "payload string")
    assert [r.key for r in M.key_extract(df).collect()] == ["V1", None, None, None]


def test_only_one_document(spark):
    ok = '{"data":{"id":"V","s":{"value":1,"received_at":2}}}'
    assert routes(spark, ['{"_flush":true} garbage', ok + ok, ok + "," + ok, ok + "],[" + ok, ok + ",0],[", "", " ",
                          ok + "]", " " + ok + "\n"]) == ["error"] * 8 + ["telemetry"]


def test_number_out_of_range(spark):
    assert routes(spark, ['{"data":{"id":"V","s":{"value":1e400,"received_at":2}}}',
                          '{"data":{"id":"V","s":{"value":"Infinity","received_at":2}}}']) == ["error", "telemetry"]


def test_sensor_named_id_is_left_out(spark):
    df = spark.createDataFrame([("VIN1", "id", 1.5, 10), ("VIN1", "a", 2.0, 20)],
                               "vin string, sensor string, value double, received_at long")
    data = json.loads(M.encode_devices(df, 1).first().payload)["data"]
    assert data == {"id": "VIN1", "a": {"value": 2.0, "received_at": 20}}


def test_members_are_asked_for_once_and_only_where_they_are(spark):
    """Reading at a path that leads nowhere costs as much as the parse: ``id`` alone is
    read by its path, where the data has one."""
    plan = M.with_envelope(spark.createDataFrame([("{}",)], "value string"))._jdf.queryExecution().optimizedPlan().toString()
    paths = re.findall(r"try_variant_get\(_(?:whole|doc|v|env)\S*, (\S+), ", plan)
    assert sorted(paths) == ["$[0]", "$[0].data.id", "$[1]"]


def test_whole_documents_only(spark):
    texts = ["null", " null\n", "\t{}\r\n", "{} ", " [] ", "[1]", "-1", "0.5 ", '"}"', "true", "false ", '{"a":"}"}', "{}}", "{} x", "x {}",
             "{}{}", "{},{}", "[1] [2]", "1 2", "1,2", "nul", "nulls", "not json", "{", "}", "]", "-", '"', '"a', "", " ",
             "\u00a0{}", "\ufeff{}", "\x0b{}", "//\n{}", "('a')"]

    def loaded(t):
        try:
            return json.dumps(json.loads(t))
        except ValueError:
            return "none"
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, value string")
    got = M.with_body(df).selectExpr("seq", "IF(_v IS NULL, 'none', coalesce(to_json(_v), 'null')) AS j").orderBy("seq").collect()
    assert [r.j if r.j == "none" else json.dumps(json.loads(r.j)) for r in got] == [loaded(t) for t in texts]
