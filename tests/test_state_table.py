"""The appended and folded state: what a flush writes, folding, splitting, eviction, commits."""

import os
import random

import pytest
from pyspark.sql import functions as F

from freshstate.streaming import latest as SL
from freshstate.streaming import tables
from freshstate.streaming.emitters import StateStoreEmitter, WindowStreamEmitter
from freshstate.streaming.tables import VersionedTable

SCHEMA = "vin string, sensor string, value string, received_at long, seq long, arr long"


def local(path):
    return path.replace("file:", "")


def files(path):
    return [(os.path.join(d, f), os.path.getsize(os.path.join(d, f))) for d, _, fs in os.walk(local(path)) for f in fs if f.endswith(".parquet")]


def part_files(state, version):
    return [x for x in files(state) if f"part=v{version}_" in x[0]]


class Devices:
    """The state as a plain dictionary: merge, refresh, then evict, as a flush does."""

    def __init__(self, ttl):
        self.ttl, self.seen, self.held = ttl, {}, {}

    def flush(self, rows, now):
        for vin, sensor, value, ra, seq, _ in rows:
            if not vin:
                continue
            self.seen[vin] = now
            own = self.held.setdefault(vin, {})
            if sensor is not None and ra is not None and ra >= 0 and (sensor not in own or (ra, seq) >= own[sensor][:2]):
                own[sensor] = (ra, seq, value)
        if self.ttl is not None:
            for vin in [v for v, t in self.seen.items() if now - t > self.ttl]:
                del self.seen[vin], self.held[vin]

    def rows(self):
        return sorted(((v, s, x[2], x[0], x[1]) for v, own in self.held.items() for s, x in own.items()), key=str) + sorted(
            (v, None, None, None, None) for v, own in self.held.items() if not own)


def state_rows(spark, path):
    got = [(r.vin, r.sensor, r.value, r.received_at, r.seq) for r in SL.read_state(spark, path).collect()]
    return (sorted((g for g in got if g[1] is not None), key=str)
            + sorted((g[0], None, None, None, None) for g in got if g[1] is None))


@pytest.mark.parametrize("seed,ttl", [(1, 25), (2, 25), (3, None)])
def test_flushes_equal_a_sequential_run(spark, scratch, monkeypatch, seed, ttl):
    """Random flushes, with folds, a split, idle buckets, devices that come back, retried and empty batches."""
    monkeypatch.setattr(tables, "MAX_PARTS", 3)
    monkeypatch.setattr(tables, "SPLIT_BYTES", 2500)
    rnd, now, seq, want = random.Random(seed), 0, 0, Devices(ttl)
    clock = iter([])
    fn = SL.LatestStateBatch(scratch("state"), ttl_ms=ttl, clock=lambda: next(clock), buckets=2)
    split = False
    for k in range(14):
        now += rnd.choice([0, 5, 10, 30])
        batch = []
        for _ in range(rnd.choice([0, 3, 12])):
            seq += 1
            batch.append((rnd.choice(["", *(f"V{i}" for i in range(9))]), rnd.choice(["a", "b", None]), str(seq), rnd.choice([-1, 1, 5, seq]), seq, seq))
        clock = iter([now, now])
        fn(spark.createDataFrame(batch, SCHEMA), k)
        if rnd.random() < 0.3:
            fn(spark.createDataFrame(batch, SCHEMA), k)     # retried
        want.flush(batch, now)
        assert state_rows(spark, fn.state_path) == want.rows(), k
        table = VersionedTable(spark, fn.state_path)
        split |= table.manifest()["n"] > 2
        assert len(table.versions()) <= tables.RETAIN
    assert split or seed != 1


def test_a_flush_writes_what_its_batch_touches(spark, scratch):
    """100 of 10^5 devices: a thousandth of the state is written, one file for each touched bucket."""
    fn = SL.LatestStateBatch(scratch("state"), clock=lambda: 7, buckets=64)
    devices = spark.range(100_000).select(
        F.concat(F.lit("VIN"), "id").alias("vin"), F.lit("speed").alias("sensor"), F.col("id").cast("string").alias("value"),
        F.lit(1).cast("long").alias("received_at"), F.col("id").alias("seq"), F.col("id").alias("arr"))
    fn(devices, 0)
    fn(devices.where("id % 1000 = 0").withColumn("value", F.lit("new")).withColumn("seq", F.col("seq") + 200_000), 1)
    first, second = part_files(fn.state_path, 0), part_files(fn.state_path, 1)
    assert len(first) == 64 and sum(n for _, n in first) > 1_000_000
    held = VersionedTable(spark, fn.state_path).manifest()["buckets"]
    assert len(second) == sum(v == 1 for v in held.values()) <= 64
    assert sum(n for _, n in second) < 2_500 * len(second)      # a few rows and a footer
    got = SL.read_state(spark, fn.state_path)
    assert got.count() == 100_000 and got.where("value = 'new'").count() == 100


def test_outgrown_buckets_are_folded(spark, scratch):
    fn = SL.LatestStateBatch(scratch("state"), clock=lambda: 7, buckets=1)
    rows = [(f"V{i}", "s", "x" * 30, 1, i, i) for i in range(3000)]
    fn(spark.createDataFrame(rows, SCHEMA), 0)
    for k in range(1, 40):
        fn(spark.createDataFrame([("V1", "s", str(k), 1, 10_000 + k, 0)], SCHEMA), k)
        parts = VersionedTable(spark, fn.state_path).manifest()["parts"]["0"]
        assert len(parts) <= tables.MAX_PARTS + 1
    kept = {f.split("part=")[1].split("/")[0] for f, _ in files(fn.state_path)}
    assert len(kept) <= 2 * (tables.MAX_PARTS + 1)               # folded parts are gone
    assert {r.vin: r.value for r in SL.read_state(spark, fn.state_path).where("vin = 'V1'").collect()} == {"V1": "39"}


def test_a_bucket_of_dropped_devices_goes_unread(spark, scratch):
    clock = iter([0, 5, 40, 41])
    fn = SL.LatestStateBatch(scratch("state"), ttl_ms=10, clock=lambda: next(clock), buckets=8)
    fn(spark.createDataFrame([(f"V{i}", "s", "1", 1, i, i) for i in range(30)], SCHEMA), 0)
    for k in (1, 2, 3):
        fn(spark.createDataFrame([("V3", "s", str(k), 1, 100 + k, 0)], SCHEMA), k)
    assert state_rows(spark, fn.state_path) == [("V3", "s", "3", 1, 103)]
    assert len(VersionedTable(spark, fn.state_path).manifest()["parts"]) == 1


def test_a_failed_commit_leaves_the_last_version(spark, scratch, monkeypatch):
    fn = SL.LatestStateBatch(scratch("state"), clock=lambda: 7)
    fn(spark.createDataFrame([("A", "s", "1", 1, 1, 1)], SCHEMA), 0)
    write = VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        fn(spark.createDataFrame([("B", "s", "2", 1, 2, 2)], SCHEMA), 1)
    assert state_rows(spark, fn.state_path) == [("A", "s", "1", 1, 1)]
    monkeypatch.setattr(VersionedTable, "_write", write)
    fn(spark.createDataFrame([("B", "s", "2", 1, 2, 2)], SCHEMA), 1)
    assert [r[0] for r in state_rows(spark, fn.state_path)] == ["A", "B"]


def test_a_replaced_run_is_removed(spark, scratch):
    path = scratch("state")
    for run, vin in (("one", "A"), ("two", "B")):
        for v in range(2):
            table = VersionedTable(spark, path, run)
            table.commit(spark.createDataFrame([(vin, v, 0)], "vin string, x int, bucket int"), v, None)
            assert VersionedTable(spark, path).run == run
    assert [d for d in os.listdir(local(path)) if d.startswith("run=")] == ["run=two"]
    assert [tuple(r) for r in VersionedTable(spark, path).read().collect()] == [("B", 1)]


def test_the_store_drops_expired_folders_and_reads_one_bucket(spark, scratch):
    em = StateStoreEmitter(scratch("kv"), ttl_ms=100)
    snap = spark.createDataFrame([(f"V{i}", "s", "1", 1, i) for i in range(50)], "vin string, sensor string, value string, received_at long, seq long")
    for k, now in enumerate((0, 60, 130, 190)):
        em(snap.where(f"seq >= {10 * k}").withColumn("tick", F.lit(now).cast("long")), k, now)
    table = VersionedTable(spark, em.path)
    assert {p[0] for parts in table.manifest()["parts"].values() for p in parts} == {"v2_0", "v3_0"}
    assert {r.key: r.produced_at for r in em.view(spark, 195).collect()} == {
        f"latest:V{i}": 190 if i >= 30 else 130 for i in range(20, 50)}
    one = em.view(spark, 195, key="latest:V25")
    assert [(r.key, r.produced_at) for r in one.collect()] == [("latest:V25", 130)]
    assert len({f.split("bucket=")[1].split("/")[0] for f in one.inputFiles()}) == 1
    assert em.view(spark, 230, key="latest:V25").count() == 0


def test_the_window_buffer_grows_by_snapshots(spark, scratch):
    out = []
    em = WindowStreamEmitter(scratch("buf"), lambda df, i: out.extend((i, r.window_start, r.key) for r in df.collect()), 120, 10)
    snap = spark.range(2000).select(F.concat(F.lit("V"), "id").alias("vin"), F.lit("s").alias("sensor"), F.col("id").cast("string").alias("value"),
                                    F.lit(1).cast("long").alias("received_at"), F.col("id").alias("seq"))
    sizes = []
    for k, now in enumerate((0, 30, 60, 100, 140)):
        em(snap.withColumn("tick", F.lit(now).cast("long")), k, now)
        sizes.append(sum(n for f, n in part_files(em.path, k)))
    assert max(sizes) < 1.5 * min(sizes)                         # no flush rewrites the window
    assert len(out) == 2000 and {o[:2] for o in out} == {(4, 0)}
    assert set(VersionedTable(spark, em.path).manifest()["parts"]) == {"1"}
