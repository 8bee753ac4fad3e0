import json

from freshstate.sources import dictionary as D
from freshstate.sources import lines as L
from freshstate.sources import range_scan as R


def test_csv_cases(spark, scratch):
    path = scratch("lines")
    text = "\n".join([
        "i1,V1,r1,n1,10,1,2,csv,3",          # 9 columns
        "i2,V1,r1,n1,10,1,2,csv",            # 8 columns: dropped
        "i3,V1,r1,n1,10,1,2,csv,3,x,y",      # 11 columns: extras ignored
        "",                                  # blank: skipped
        "i4,V1,r1,n1,10,1,abc,csv,3",        # non-numeric ts -> 0
        "i5,V1,r1,n1,10,1,99999999999999999999,csv,3",   # overflow -> clamp
        "i6,V1,r1,n1,10,1, 5,csv,-99999999999999999999",  # ' 5' -> 0, negative overflow
    ])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    rows = {r.id: r for r in L.read_reading_lines(spark, path, max_lines=None).collect()}
    assert set(rows) == {"i1", "i3", "i4", "i5", "i6"}
    assert rows["i3"].ns_ts == 3 and rows["i4"].ts == 0
    assert rows["i5"].ts == 9223372036854775807
    assert rows["i6"].ts == 0 and rows["i6"].ns_ts == -9223372036854775808


def test_csv_max_lines_in_file_order(spark, scratch):
    path = scratch("lines_cap")
    text = "\n".join(f"i{i},V,r,n,1,1,{i},csv,1" if i % 4 else "short" for i in range(200))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    got = [r.ts for r in L.read_reading_lines(spark, path, max_lines=10).collect()]
    valid = [i for i in range(200) if i % 4][:10]
    assert sorted(got) == valid


def write_json(spark, scratch, obj):
    path = scratch("dict") + ".json"
    spark.createDataFrame([(json.dumps(obj),)], "value string").coalesce(1).write.text(path)
    return path


def test_resource_matrix_first_wins(spark, scratch):
    path = write_json(spark, scratch, {"resource_matrix": [
        {"resource_id": "a", "resource_name": "first", "operation": "R", "state": "Active", "description": "d"},
        {"resource_id": "", "resource_name": "blank", "operation": "R", "state": "Active"},
        {"resource_id": "a", "resource_name": "second", "operation": "R", "state": "Active"},
        {"resource_id": "b", "resource_name": "ts", "operation": "R", "state": "InActive"},
        {"resource_id": "c", "resource_name": "ts", "operation": "R", "state": "Active"},
    ]})
    got = {r.resource_id: (r.resource_name, r.state) for r in D.load_resource_matrix(spark, path).collect()}
    assert got == {"a": ("first", "Active"), "b": ("ts", "InActive"), "c": ("ts", "Active")}


def test_resource_list_last_wins_blanks_kept(spark, scratch):
    path = write_json(spark, scratch, [
        {"resource_id": "a", "resource_name": "first"}, {"resource_id": "", "resource_name": "blank"},
        {"resource_id": "a", "resource_name": "second"}])
    got = {r.resource_id: r.resource_name for r in D.load_resource_list(spark, path).collect()}
    assert got == {"a": "second", "": "blank"}


def test_chunk_count():
    assert R.chunk_count(10_000, 2_000) == 5
    assert R.chunk_count(9_000, 2_000) == 5   # the last chunk is short
    assert R.chunk_count(1_000, 2_000) == 1


def test_range_scan_pruning_plan(spark, scratch):
    path = scratch("pods")
    spark.range(0, 100).selectExpr("id as arr", "cast(id % 4 as int) as pod").write.partitionBy("pod").parquet(path)
    df = R.range_scan(spark.read.parquet(path), [1, 2], 10, 50)
    assert sorted(r.arr for r in df.collect()) == [i for i in range(10, 50) if i % 4 in (1, 2)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan


def test_normalize_records(spark):
    from freshstate.plans.telemetry import sensor_dictionary
    rec = spark.createDataFrame(
        [("2024-01-01 00:00:00.001", 5, "f", "", "V9", "view"), ("2024-01-01 00:00:00", None, "f", "V", "", "")],
        "_time string, _value long, _field string, vincode string, vin string, resource_id string",
    ).selectExpr("cast(_time as timestamp_ntz) as _time", "_value", "_field", "vincode", "vin", "resource_id")
    out = R.normalize_records(rec, sensor_dictionary(spark)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.vincode, r.resource_id, r.resource_name, r.value, r.ts, r.source) == \
        ("V9", "view", "page_view", "5", 1704067200001, "influx")
    assert r.id == "influx_1704067200001000000" and r.ns_ts == 1704067200001000000


def test_line_over_one_mib_fails_the_read(spark, scratch):
    import pytest
    path = scratch("long_line")
    spark.createDataFrame([("a,b,c,d,e,1,2,x,3",), ("x" * (1024 * 1024 + 1),)], "value string") \
        .coalesce(1).write.text(path)
    with pytest.raises(Exception, match="1 MiB"):
        L.read_reading_lines(spark, path, strict_line_length=True).collect()
    rows = L.read_reading_lines(spark, path).collect()     # by default it is a line like any other
    assert len(rows) == 1


def test_bad_dictionaries_fail(spark, scratch):
    import pytest
    for text in ('{"resource_matrix": [{"resource_id": "a"', '{"resource_matrix": []}', '{"other": 1}',
                 '{"resource_matrix": [{"resource_id": 7, "resource_name": "n"}]}', '{"resource_matrix": [null]}'):
        path = scratch("bad") + ".json"
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
        with pytest.raises(Exception, match="not a resource dictionary"):
            D.load_resource_matrix(spark, path).collect()


def test_line_position_orders_readings(spark, scratch):
    from freshstate.operators.etl import etl_messages
    from freshstate.operators.messages import decode_payloads
    path = scratch("ordered")
    text = "\n".join(f"i{i},V,r,n,{i},1,{100 - i},csv,{'n/a' if i % 2 else 100 - i}" for i in range(50))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    dim = spark.createDataFrame([("r", "sensor")], "resource_id string, resource_name string")
    out = decode_payloads(etl_messages(L.read_reading_lines(spark, path), dim, 7), raw="value", keep=())
    assert [r.value.toJson() for r in out.collect()] == ['"49"']


def test_time_between_is_pushed_down(spark, scratch):
    path = scratch("times")
    spark.range(0, 10).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) AS ts", "id").write.parquet(path)
    df = spark.read.parquet(path).where(R.time_between("ts", 1_704_067_202_000, 1_704_067_205_000))
    assert sorted(r.id for r in df.collect()) == [2, 3, 4]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in df._jdf.queryExecution().executedPlan().toString()
