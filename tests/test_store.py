"""The store connector — partitions per pod × chunk, range semantics,
contiguous streaming cycles — against a parquet-backed store."""

from pyspark.sql import functions as F

from freshstate.sources import store
from freshstate.sources.range_scan import normalize_records

FETCH = "store_client:parquet_fetch"
BASE = 1_704_067_200_000


def make_store(spark, path, n=400):
    df = spark.range(0, n).select(
        (F.lit(BASE) + F.col("id") * 250).alias("_time_ms"),
        F.col("id").cast("string").alias("_value"),
        F.lit("speed").alias("_field"),
        F.when(F.col("id") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("V"), (F.col("id") % 7).cast("string"))).alias("vincode"),
        F.concat(F.lit("W"), (F.col("id") % 7).cast("string")).alias("vin"),
        F.lit("view").alias("resource_id"),
        (F.col("id") % 3).cast("string").alias("pod"))
    df.write.partitionBy("pod").parquet(path)
    return df


def test_partitions_per_pod_and_chunk():
    parts = store.chunk_partitions(["a", "b"], 0, 10_000, 2_000)
    assert len(parts) == 10 and parts[0].lo == 0 and parts[4].hi == 10_000
    ragged = store.chunk_partitions(["a"], 0, 9_000, 2_000)
    assert len(ragged) == 5 and ragged[-1].hi == 9_000                  # the last chunk is short
    short = store.chunk_partitions(["a"], 0, 1_000, 2_000)
    assert [(p.lo, p.hi) for p in short] == [(0, 1_000)]
    # a long outage: more chunks to a partition, nothing left out
    many = store.chunk_partitions(["a", "b"], 0, 86_400_000, 2_000, max_partitions=100)
    assert len(many) <= 100
    own = [p for p in many if p.pod == "a"]
    assert own[0].lo == 0 and own[-1].hi == 86_400_000 and all(x.hi == y.lo for x, y in zip(own, own[1:]))


def test_restart_without_start_reads_every_row_once(spark, scratch, monkeypatch):
    path = scratch("store")
    make_store(spark, path)
    clock = {"now": BASE + 31_500}
    monkeypatch.setattr(store, "_now", lambda: clock["now"])
    o = {"pods": "0,1,2", "fetch": FETCH, "store_path": path, "lookback_ms": "9000", "chunk_ms": "2000"}
    first = store.TelemetryStoreStreamReader(o)
    at, read = first.initialOffset(), []
    origin = at["end_ms"]
    for reader, now in ((first, BASE + 31_500), (None, BASE + 44_444), (None, BASE + 90_100)):
        clock["now"] = now
        reader = reader or store.TelemetryStoreStreamReader(o)          # a restart: only the offset is known
        end = reader.latestOffset()
        for p in reader.partitions(at, end):
            for b in reader.read(p):
                read += [int(v) for v in b.column("_value").to_pylist()]
        at = end
    want = [i for i in range(400) if origin <= BASE + i * 250 < at["end_ms"]]
    assert sorted(read) == want and at["end_ms"] <= BASE + 90_100


def test_batch_read(spark, scratch):
    path = scratch("store")
    src = make_store(spark, path)
    store.register(spark)
    df = (spark.read.format("telemetry_store")
          .option("store_path", path).option("fetch", FETCH).option("pods", "0,2").option("start_ms", BASE + 10_000)
          .option("lookback_ms", 50_000).option("chunk_ms", 20_000).load())
    assert df.rdd.getNumPartitions() == 6           # 2 pods x 3 chunks, the last one short
    got = sorted(int(r._value) for r in df.collect())
    want = sorted(int(r._value) for r in src.where(
        (F.col("pod").isin("0", "2")) & (F.col("_time_ms") >= BASE + 10_000)
        & (F.col("_time_ms") < BASE + 60_000)).collect())
    assert got == want and len(got) > 0
    from freshstate.plans.telemetry import sensor_dictionary
    norm = normalize_records(df, sensor_dictionary(spark)).collect()
    assert all(r.source == "influx" and r.resource_name == "page_view" for r in norm)
    assert {r.vincode[0] for r in norm} == {"V", "W"}   # empty vincode falls back to vin


def test_filters_narrow_what_is_fetched(spark, scratch):
    """Pods and chunks outside the filters have no partition; rows are those of a filter after the scan."""
    path = scratch("store")
    src = make_store(spark, path)
    store.register(spark)

    def read():
        return (spark.read.format("telemetry_store").option("store_path", path).option("fetch", FETCH).option("pods", "0,1,2")
                .option("start_ms", BASE + 1_000).option("lookback_ms", 90_000).option("chunk_ms", 10_000).load())
    lo, hi = BASE + 23_250, BASE + 41_000
    t = F.unix_millis("_time")
    df = read().where((F.col("pod") == "1") & (F.col("_time") >= F.timestamp_millis(F.lit(lo))) & (F.col("_time") < F.timestamp_millis(F.lit(hi))))
    got = sorted(int(r._value) for r in df.collect())
    assert got == sorted(int(r._value) for r in src.where((F.col("pod") == "1") & F.col("_time_ms").between(lo, hi - 1)).collect()) and got
    assert got == sorted(int(r._value) for r in read().where(F.concat("pod", F.lit("")) == "1").where(t.between(lo, hi - 1)).collect())
    assert df.rdd.getNumPartitions() == 2            # chunks from 21 s and from 31 s on of one pod
    assert read().where(F.col("pod").isin("0", "2", "9")).rdd.getNumPartitions() == 18
    assert read().where("_measurement = 'other'").count() == 0


def test_pushed_filters_pick_chunks():
    from datetime import datetime, timedelta, timezone
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual
    o = {"pods": "a,b,c", "fetch": FETCH, "start_ms": "5000", "lookback_ms": "20000", "chunk_ms": "2000"}
    at = lambda ms: datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=ms)
    r = store.TelemetryStoreReader(o)
    time = [GreaterThan(("_time",), at(8_999)), LessThanOrEqual(("_time",), at(11_000))]
    assert list(r.pushFilters([In(("pod",), ("a", "c")), *time])) == time     # pods are settled, times are checked again
    assert [(p.pod, p.lo, p.hi) for p in r.partitions()] == [(p, lo, lo + 2_000) for p in "ac" for lo in (7_000, 9_000, 11_000)]
    none = store.TelemetryStoreReader(o)
    list(none.pushFilters([EqualTo(("_time",), at(99_000))]))
    assert none.partitions() == []


def test_stream_cycles_contiguous(spark, scratch):
    path = scratch("store")
    make_store(spark, path)
    store.register(spark)
    stream = (spark.readStream.format("telemetry_store")
              .option("store_path", path).option("fetch", FETCH).option("pods", "0,1,2").option("start_ms", BASE)
              .option("stop_ms", BASE + 100_000).option("lookback_ms", 30_000).option("chunk_ms", 10_000).load())
    out = scratch("out")
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch("ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(int(r._value) for r in spark.read.parquet(out).collect())
    # three whole 30 s cycles: [BASE, BASE + 90 s); the partial fourth cycle waits
    assert got == list(range(0, 360))
