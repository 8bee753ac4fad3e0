"""Registered queries: one per operator of the inventory, each paired with a
DuckDB oracle over the same parquet tables.

Every query reads the driver's tables (through the telemetry view) and runs
over them whole. Outputs are scalar columns only, named identically in the
Spark result and the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge, messages, rollup
from ..operators.lookup import lookup_inner, lookup_left
from . import telemetry as tv
from .telemetry import DAY_MS, DICTIONARY_SQL, READINGS_SQL, TELEMETRY_SQL, with_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def sql(*ctes: str, select: str) -> str:
    """Oracle text: the telemetry CTEs, extra CTEs, then the final SELECT."""
    return with_ctes(DICTIONARY_SQL, TELEMETRY_SQL, READINGS_SQL, *ctes) + select.strip()


# Parameters of the registered queries.
NOW_MS = 1_735_689_600_000            # 2025-01-01T00:00:00Z, the "now" of P5
ORIGIN_MS = 1_704_067_200_000         # 2024-01-01T00:00:00Z, slices of the incremental fold
TOPIC_PARTITIONS = 12                 # partitions of the aggregated topic

LATEST_CTE = """latest AS (
  SELECT vin, sensor, value, received_at, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY vin, sensor ORDER BY received_at DESC, seq DESC) AS rn
    FROM readings WHERE vin <> '' AND received_at >= 0) WHERE rn = 1)"""

LATEST_SQL = sql(LATEST_CTE, select="SELECT vin, sensor, value, received_at, seq FROM latest")

BATCH_LAST_CTE = """batch_last AS (
  SELECT batch_id, vin, sensor, value, received_at, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_id, vin, sensor ORDER BY seq DESC) AS rn
    FROM readings) WHERE rn = 1)"""

TOPIC_CTE = """topic AS (
  SELECT vin AS key, batch_id, max(seq) AS "offset", count(*) AS n_sensors
  FROM batch_last GROUP BY vin, batch_id)"""

COMPACTED_CTE = """compacted AS (
  SELECT key, batch_id, "offset", n_sensors FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) AS rn FROM topic)
  WHERE rn = 1)"""


# -- J1 / J2 -----------------------------------------------------------------

@register("resource_lookup_inner", sql(select="SELECT seq, vin, resource_id, sensor, value, received_at FROM readings"))
def q_resource_lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tv.readings(spark, sf_dir).select("seq", "vin", "resource_id", "sensor", "value", "received_at")


@register("resource_lookup_left", sql(select="""
SELECT t.seq, t.vin, t.resource_id, coalesce(d.resource_name, t.resource_id) AS sensor
FROM tel t LEFT JOIN sensor_dict d ON t.resource_id = d.resource_id"""))
def q_resource_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookup_left(tv.telemetry(spark, sf_dir), tv.sensor_dictionary(spark))
    return rows.select("seq", "vin", "resource_id", "sensor")


# -- A2 / A3 -----------------------------------------------------------------

@register("latest_merge", LATEST_SQL)
def q_latest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.latest_merge(tv.readings(spark, sf_dir)).select(
        "vin", "sensor", "value", "received_at", "seq")


@register("latest_merge_incremental", LATEST_SQL)
def q_latest_merge_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State folded over three arrival-time slices: days [0,10), [10,20), [20,∞)."""
    from ..sources.range_scan import time_between
    events = tv.table(spark, sf_dir, "events")
    t1, t2 = ORIGIN_MS + 10 * DAY_MS, ORIGIN_MS + 20 * DAY_MS

    def rows(where) -> DataFrame:   # the raw time is filtered, so each slice prunes its scan
        return lookup_inner(tv.telemetry_from_events(events.where(where)), tv.sensor_dictionary(spark))
    state = merge.latest_merge(rows(~time_between("ts", t1)))
    state = merge.merge_incremental(state, rows(time_between("ts", t1, t2)))
    state = merge.merge_incremental(state, rows(time_between("ts", t2)))
    return state.select("vin", "sensor", "value", "received_at", "seq")


EXTREME_RA = f"CASE seq % 101 WHEN 0 THEN {2 ** 63 - 1} WHEN 1 THEN {2 ** 62} WHEN 2 THEN -1 ELSE received_at END"


@register("latest_merge_extremes", sql(select=f"""
SELECT vin, sensor, value, received_at, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY vin, sensor ORDER BY received_at DESC, seq DESC) AS rn
  FROM (SELECT vin, sensor, value, {EXTREME_RA} AS received_at, seq FROM readings) WHERE received_at >= 0)
WHERE rn = 1"""))
def q_latest_merge_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 with ``received_at`` at the int64 maximum, at 2^62 and negative among the readings."""
    rows = tv.readings(spark, sf_dir).withColumn("received_at", F.expr(EXTREME_RA))
    return merge.latest_merge(rows).select("vin", "sensor", "value", "received_at", "seq")


# -- A1 / P5 -----------------------------------------------------------------

@register("batch_last_value", sql(BATCH_LAST_CTE, select="""
SELECT batch_id, vin, sensor, value, received_at, seq FROM batch_last"""))
def q_batch_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.batch_last_value(tv.readings(spark, sf_dir)).select(
        "batch_id", "vin", "sensor", "value", "received_at", "seq")


@register("received_at_default", sql(select=f"""
SELECT seq, vin, sensor,
       CASE WHEN seq % 11 = 0 THEN {NOW_MS} ELSE received_at END AS received_at
FROM readings"""))
def q_received_at_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose ``ts`` is 0 (every 11th) take the batch's now."""
    rows = tv.readings(spark, sf_dir).withColumn(
        "ts", F.when(F.pmod("seq", F.lit(11)) == 0, F.lit(0)).otherwise(F.col("received_at")))
    return rows.select("seq", "vin", "sensor",
                       merge.received_at_default("ts", NOW_MS).alias("received_at"))


# -- A4 ----------------------------------------------------------------------

@register("device_rollup", sql(LATEST_CTE, select="""
SELECT vin, count(*) OVER (PARTITION BY vin) AS n_sensors, sensor, value, received_at FROM latest"""))
def q_device_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dev = rollup.device_rollup(merge.latest_merge(tv.readings(spark, sf_dir)))
    rows = dev.select("vin", F.size("metrics").cast("long").alias("n_sensors"), F.explode("metrics").alias("sensor", "_m"))
    return rows.select("vin", "n_sensors", "sensor", "_m.value", "_m.received_at")


def decoded(msgs: DataFrame, keep: tuple[str, ...], raw: str = "value") -> DataFrame:
    """Emitted messages back in long form: ``keep``, vin, sensor, value (a double), received_at, produced_at."""
    return messages.decode_payloads(msgs, raw=raw, keep=keep).withColumn("value", F.try_variant_get("value", "$", "double"))


def decoded_batches(msgs: DataFrame, keep: tuple[str, ...], raw: str = "payload") -> DataFrame:
    """Batched messages back in long form, with ``num_of_data`` and the device's place ``pos``."""
    return (messages.decode_batched(msgs, raw, keep).withColumn("value", F.try_variant_get("value", "$", "double"))
            .withColumn("pos", F.col("pos").cast("long")))


# -- A6 and replay -----------------------------------------------------------

def aggregated_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ETL half's output topic: per (batch, vin) one payload (A1 + A4 + P3),
    key = vin, partition = hash(key), offset rising with production order."""
    last = merge.batch_last_value(tv.readings(spark, sf_dir))
    e = F.struct(F.col("sensor"), F.col("value").cast("variant").alias("value"), F.col("received_at"))
    g = last.groupBy("batch_id", "vin").agg(
        F.collect_list(e).alias("_entries"), F.max("seq").alias("offset"),
        F.count(F.lit(1)).alias("n_sensors"))
    return g.select(
        F.col("vin").alias("key"),
        messages.encode_payload(F.col("vin"), F.col("_entries"), F.col("offset")).alias("value"),
        F.pmod(F.xxhash64("vin"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        "offset", "batch_id", "n_sensors")


@register("log_compact", sql(BATCH_LAST_CTE, TOPIC_CTE, COMPACTED_CTE, select="""
SELECT c.key, c.batch_id, c."offset", c.n_sensors, b.sensor, b.value, b.received_at, c."offset" AS produced_at
FROM compacted c JOIN batch_last b ON b.vin = c.key AND b.batch_id = c.batch_id"""))
def q_log_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a compacted topic retains, its payloads decoded."""
    kept = merge.log_compact(aggregated_topic(spark, sf_dir))
    return decoded(kept, ("key", "batch_id", "offset", "n_sensors")).select(
        "key", "batch_id", "offset", "n_sensors", "sensor", "value", "received_at", "produced_at")


@register("replay_compacted", sql(BATCH_LAST_CTE, TOPIC_CTE, COMPACTED_CTE, select="""
SELECT b.vin, b.sensor, b.value, b.received_at
FROM batch_last b JOIN compacted c ON b.vin = c.key AND b.batch_id = c.batch_id
WHERE b.received_at >= 0"""))
def q_replay_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 ∘ A6: rebuild state from a compacted topic (sensors absent from each
    key's last message are lost, unlike the live state)."""
    kept = merge.log_compact(aggregated_topic(spark, sf_dir))
    decoded = messages.decode_payloads(kept.withColumnRenamed("offset", "seq"), raw="value", keep=("seq",))
    state = merge.latest_merge(decoded)
    return state.select("vin", "sensor", F.try_variant_get("value", "$", "double").alias("value"),
                        "received_at")


# -- U1 ----------------------------------------------------------------------

FAN_IN_PERIOD_MS = 6 * tv.HOUR_MS


@register("fan_in", sql(f"""ticks AS (
  SELECT unnest(generate_series((min(arr) // {FAN_IN_PERIOD_MS} + 1) * {FAN_IN_PERIOD_MS},
                                (max(arr) // {FAN_IN_PERIOD_MS} + 1) * {FAN_IN_PERIOD_MS},
                                {FAN_IN_PERIOD_MS})) AS t
  FROM readings)""", select="""
SELECT 'msg' AS kind, arr AS t, vin FROM readings
UNION ALL
SELECT 'tick' AS kind, t, NULL AS vin FROM ticks"""))
def q_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.fan_in import fan_in, tick_rows
    rows = tv.readings(spark, sf_dir)
    msgs = rows.select(F.lit("msg").alias("kind"), F.col("arr").alias("t"), "vin")
    ticks = tick_rows(rows, FAN_IN_PERIOD_MS).select(F.lit("tick").alias("kind"), "t",
                                                       F.lit(None).cast("string").alias("vin"))
    return fan_in(msgs, ticks)


# -- T2 / T3 / A7 / S9 / W1 / A5 --------------------------------------------

SNAP_PERIOD_MS = 6 * tv.HOUR_MS          # flush tick period of the replay queries
SNAP_TTL_MS = 12 * tv.HOUR_MS            # idle-device TTL of the replay queries
# every replay runs through the first flush tick after the last arrival
SNAP_T_END = f"(SELECT (max(arr) // {SNAP_PERIOD_MS} + 1) * {SNAP_PERIOD_MS} FROM readings)"
VIEW_NOW_MS = ORIGIN_MS + 19 * DAY_MS + 60_000   # state-store read time: 1 min after a tick
WINDOW_FLUSH_MS = DAY_MS                 # W1 window size for the replay query
WINDOW_FLUSH_LATENESS_MS = tv.HOUR_MS    # W1 allowed lateness for the replay query
EVENT_WINDOW_MS = 2 * 60 * 1000          # W2 window size
BATCH_SIZE = 100                         # A5 devices per message


def snapshot_ctes(ttl_ms: int | None, source: str = "readings") -> list[str]:
    """Oracle for T2/T3: join every tick with every earlier message (arr < T)."""
    P = SNAP_PERIOD_MS
    starts = "prev IS NULL" if ttl_ms is None else f"prev IS NULL OR ((prev + {ttl_ms}) // {P} + 1) * {P} <= arr"
    having = "" if ttl_ms is None else f"HAVING s.t - max(s.arr) <= {ttl_ms}"
    return [
        f"""incs AS (
  SELECT *, sum(CASE WHEN {starts} THEN 1 ELSE 0 END)
              OVER (PARTITION BY vin ORDER BY arr, seq ROWS UNBOUNDED PRECEDING) AS inc
  FROM (SELECT *, lag(arr) OVER (PARTITION BY vin ORDER BY arr, seq) AS prev
        FROM {source} WHERE vin <> ''))""",
        f"""ticks AS (SELECT unnest(generate_series((min(arr) // {P} + 1) * {P}, (max(arr) // {P} + 1) * {P}, {P})) AS t FROM {source})""",
        """seen AS (SELECT tk.t, i.* FROM ticks tk JOIN incs i ON i.arr < tk.t)""",
        """cur AS (SELECT t, vin, max(inc) AS inc FROM seen GROUP BY t, vin)""",
        f"""live AS (
  SELECT s.t, s.vin, s.inc FROM seen s JOIN cur c ON s.t = c.t AND s.vin = c.vin AND s.inc = c.inc
  GROUP BY s.t, s.vin, s.inc {having})""",
        """snap AS (
  SELECT t AS tick, vin, sensor, value, received_at, seq FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.t, s.vin, s.sensor
                                   ORDER BY s.received_at DESC, s.seq DESC) AS rn
    FROM seen s JOIN live l ON s.t = l.t AND s.vin = l.vin AND s.inc = l.inc
    WHERE s.received_at >= 0 AND s.sensor IS NOT NULL) WHERE rn = 1)""",
    ]


def _snapshots(spark: SparkSession, sf_dir: str, ttl_ms: int | None) -> DataFrame:
    from ..operators.snapshot import snapshots
    return snapshots(tv.readings(spark, sf_dir), SNAP_PERIOD_MS, ttl_ms, None)


@register("flush_snapshots", sql(*snapshot_ctes(None), select="""
SELECT tick, vin, sensor, value, received_at, seq FROM snap"""))
def q_flush_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 without eviction: every device at every tick after its first message."""
    return _snapshots(spark, sf_dir, None)


@register("flush_snapshot_ttl", sql(*snapshot_ctes(SNAP_TTL_MS), select="""
SELECT tick, vin, sensor, value, received_at, seq FROM snap"""))
def q_flush_snapshot_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T3: idle devices evicted at flush and restarted empty."""
    return _snapshots(spark, sf_dir, SNAP_TTL_MS)


@register("flush_empty_devices", sql("""allr AS (
  SELECT t.vin, t.seq, t.arr, t.received_at, d.resource_name AS sensor, t.value
  FROM tel t LEFT JOIN sensor_dict d ON t.resource_id = d.resource_id)""", *snapshot_ctes(SNAP_TTL_MS, "allr"), select="""
SELECT t AS tick, vin FROM live EXCEPT SELECT tick, vin FROM snap"""))
def q_flush_empty_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live devices without a stored sensor (only unknown sensors so far) at every flush."""
    from ..operators.snapshot import snapshots
    rows = lookup_left(tv.telemetry(spark, sf_dir), tv.sensor_dictionary(spark))
    rows = rows.withColumn("sensor", F.when(F.col("sensor") != F.col("resource_id"), F.col("sensor")))
    out = snapshots(rows, SNAP_PERIOD_MS, SNAP_TTL_MS, None, with_empty_devices=True)
    return out.where("sensor IS NULL").select("tick", "vin")


@register("flush_stats", sql(*snapshot_ctes(SNAP_TTL_MS), select=f"""
SELECT l.tick, l.vin_count, coalesce(v.value_count, 0) AS value_count,
       (l.vin_count + {BATCH_SIZE - 1}) // {BATCH_SIZE} AS message_count
FROM (SELECT t AS tick, count(*) AS vin_count FROM live GROUP BY t) l
LEFT JOIN (SELECT tick, count(*) AS value_count FROM snap GROUP BY tick) v ON l.tick = v.tick"""))
def q_flush_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.snapshot import flush_stats
    return flush_stats(tv.readings(spark, sf_dir), SNAP_PERIOD_MS, SNAP_TTL_MS, None, BATCH_SIZE)


@register("state_store_view", sql(*snapshot_ctes(SNAP_TTL_MS), f"""writes AS (
  SELECT 'latest:' || vin AS key, vin, tick AS produced_at, tick + 300000 AS expires_at,
         count(*) OVER (PARTITION BY tick, vin) AS n_sensors, sensor, value, received_at
  FROM snap WHERE tick <= {VIEW_NOW_MS})""", select=f"""
SELECT key, vin, produced_at, expires_at, n_sensors, sensor, value, received_at FROM (
  SELECT *, max(produced_at) OVER (PARTITION BY key) AS newest FROM writes)
WHERE produced_at = newest AND expires_at > {VIEW_NOW_MS}"""))
def q_state_store_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader of the keyed store sees one minute after a flush."""
    from ..operators.snapshot import last_emission
    from ..operators.strategies import state_store_view, state_store_writes
    # only each device's last flush at or before now can be visible
    last = last_emission(tv.readings(spark, sf_dir), SNAP_PERIOD_MS, SNAP_TTL_MS, None, VIEW_NOW_MS)
    view = state_store_view(state_store_writes(last), VIEW_NOW_MS)
    return decoded(view, ("key", "expires_at", "n_sensors")).select(
        "key", "vin", "produced_at", "expires_at", "n_sensors", "sensor", "value", "received_at")


@register("window_flush", sql(*snapshot_ctes(SNAP_TTL_MS), f"""win AS (
  SELECT *, tick - tick % {WINDOW_FLUSH_MS} AS window_start FROM snap)""", select=f"""
SELECT window_start, vin AS key, vin, sensor, value, received_at,
       window_start + {WINDOW_FLUSH_MS} AS produced_at,
       (window_start + {WINDOW_FLUSH_MS + WINDOW_FLUSH_LATENESS_MS} + {SNAP_PERIOD_MS - 1}) // {SNAP_PERIOD_MS} * {SNAP_PERIOD_MS} AS tick
FROM (SELECT *, max(tick) OVER (PARTITION BY window_start, vin) AS last_tick FROM win)
WHERE tick = last_tick
  AND (window_start + {WINDOW_FLUSH_MS + WINDOW_FLUSH_LATENESS_MS} + {SNAP_PERIOD_MS - 1}) // {SNAP_PERIOD_MS} * {SNAP_PERIOD_MS} <= {SNAP_T_END}"""))
def q_window_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flush-time tumbling windows (1 day, 1 h lateness) over the TTL snapshots,
    computed from ranges (windows overlapped), not from every exploded tick."""
    from ..operators.snapshot import window_flush_replay
    from ..operators.strategies import window_messages
    rows = window_flush_replay(tv.readings(spark, sf_dir), SNAP_PERIOD_MS, SNAP_TTL_MS, None,
                               WINDOW_FLUSH_MS, WINDOW_FLUSH_LATENESS_MS)
    return decoded(window_messages(rows), ("tick", "key", "window_start")).select(
        "window_start", "key", "vin", "sensor", "value", "received_at", "produced_at", "tick")


@register("window_event_time", sql(f"""ew AS (
  SELECT *, arr - arr % {EVENT_WINDOW_MS} AS window_start FROM readings
  WHERE vin <> '' AND received_at >= 0)""", select="""
SELECT window_start, vin, sensor, value, received_at, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, vin, sensor
                               ORDER BY received_at DESC, seq DESC) AS rn FROM ew) WHERE rn = 1"""))
def q_window_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 (batch): 2-minute event-time windows, latest value per sensor inside each."""
    from ..operators.windows import window_latest
    return window_latest(tv.readings(spark, sf_dir), EVENT_WINDOW_MS).select(
        "window_start", "vin", "sensor", "value", "received_at", "seq")


@register("batched_payload", sql(LATEST_CTE, f"""devs AS (
  SELECT vin, n // {BATCH_SIZE} AS msg_idx, n % {BATCH_SIZE} AS pos
  FROM (SELECT vin, row_number() OVER (ORDER BY vin) - 1 AS n FROM (SELECT DISTINCT vin FROM latest)))""", select=f"""
SELECT d.msg_idx, count(DISTINCT d.vin) OVER (PARTITION BY d.msg_idx) AS num_of_data, d.pos, d.vin, l.sensor, l.value,
       l.received_at, {NOW_MS} AS produced_at
FROM devs d JOIN latest l USING (vin)"""))
def q_batched_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the merged state packed 100 devices per message."""
    state = merge.latest_merge(tv.readings(spark, sf_dir))
    return decoded_batches(rollup.batched_payloads(state, BATCH_SIZE, NOW_MS), ("msg_idx",)).select(
        "msg_idx", "num_of_data", "pos", "vin", "sensor", "value", "received_at", "produced_at")


# -- P1-P4 --------------------------------------------------------------------

ROUTE_SQL_CASE = """CASE event_id % 14 WHEN 0 THEN 'flush' WHEN 1 THEN 'flush' WHEN 2 THEN 'skip'
  WHEN 3 THEN 'error' WHEN 4 THEN 'skip' WHEN 5 THEN 'error' WHEN 6 THEN 'error'
  WHEN 7 THEN 'telemetry' WHEN 8 THEN 'error' WHEN 9 THEN 'telemetry' ELSE 'error' END"""


@register("message_route", sql(select=f"""
SELECT event_id AS seq, {ROUTE_SQL_CASE} AS route FROM events"""))
def q_message_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .derived import raw_messages
    msgs = raw_messages(tv.telemetry(spark, sf_dir))
    return messages.with_route(msgs, "value").select("seq", "route")


@register("key_extract", sql(select="""
SELECT seq, CASE WHEN seq % 14 IN (5, 7, 8, 9, 12) THEN vin END AS key FROM tel"""))
def q_key_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .derived import raw_messages
    msgs = raw_messages(tv.telemetry(spark, sf_dir))
    return messages.key_extract(msgs, raw="value").select("seq", "key")


@register("payload_decode", sql(select="""
SELECT t.seq, t.vin, d.resource_name AS sensor,
       CASE WHEN d.resource_name IS NULL THEN NULL ELSE t.value END AS value,
       CASE WHEN d.resource_name IS NULL THEN NULL ELSE t.received_at END AS received_at,
       t.arr AS produced_at
FROM tel t LEFT JOIN sensor_dict d ON t.resource_id = d.resource_id"""))
def q_payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 then P2 on every telemetry row; unknown sensors become id-only payloads."""
    from .derived import device_messages
    named = lookup_left(tv.telemetry(spark, sf_dir), tv.sensor_dictionary(spark)).withColumn(
        "_known", F.col("sensor") != F.col("resource_id"))
    decoded = messages.decode_payloads(device_messages(named), raw="value", keep=("seq",),
                                       with_device_rows=True)
    return decoded.select("seq", "vin", "sensor", F.try_variant_get("value", "$", "double").alias("value"),
                          "received_at", "produced_at")


@register("payload_roundtrip", sql(LATEST_CTE, select="SELECT vin, sensor, value, received_at FROM latest"))
def q_payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged state -> one payload per device -> decoded back to long form."""
    state = merge.latest_merge(tv.readings(spark, sf_dir))
    enc = messages.encode_devices(state, NOW_MS).withColumnRenamed("vin", "_vin")
    dec = messages.decode_payloads(enc, raw="payload", keep=())
    return dec.select("vin", "sensor", F.try_variant_get("value", "$", "double").alias("value"), "received_at")


# -- S1 / S2 / S4 / S5 / S6 ---------------------------------------------------

STORE_START_MS = ORIGIN_MS + 3 * DAY_MS      # range_scan window
STORE_STOP_MS = ORIGIN_MS + 27 * DAY_MS
CHUNK_LOOKBACK_MS = 29 * DAY_MS + 12 * tv.HOUR_MS   # one cycle: 14 chunks of 2 days and a short one
CHUNK_MS = 2 * DAY_MS
CYCLE_START_MS = ORIGIN_MS + 2 * DAY_MS      # resume point of the incremental cycles
CYCLE_LOOKBACK_MS = DAY_MS
CYCLE_CHUNK_MS = 6 * tv.HOUR_MS


def _tel_between(spark: SparkSession, sf_dir: str, start_ms: int, stop_ms: int | None = None) -> DataFrame:
    """Telemetry of a time range; the raw time column is filtered in the scan."""
    from ..sources.range_scan import time_between
    return tv.telemetry_from_events(tv.table(spark, sf_dir, "events").where(time_between("ts", start_ms, stop_ms)))


def _line_files(spark: SparkSession, sf_dir: str) -> str:
    """Reading lines derived from events as text files, in arrival order by path."""
    from ..session import scratch_path
    from .derived import reading_lines
    path = scratch_path(spark, "reading_lines")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (reading_lines(tv.telemetry(spark, sf_dir)).repartitionByRange(n, "seq").sortWithinPartitions("seq")
     .select("value").write.text(path))
    return path


@register("range_scan", sql(select=f"""
SELECT seq, vin, pod, arr, resource_id, value FROM tel
WHERE pod IN (0, 2) AND arr >= {STORE_START_MS} AND arr < {STORE_STOP_MS}"""))
def q_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.range_scan import range_scan
    return range_scan(_tel_between(spark, sf_dir, STORE_START_MS, STORE_STOP_MS), [0, 2], STORE_START_MS, STORE_STOP_MS).select(
        "seq", "vin", "pod", "arr", "resource_id", "value")


@register("range_scan_chunks", sql(select=f"""
SELECT pod, (arr - {ORIGIN_MS}) // {CHUNK_MS} AS chunk, count(*) AS n_rows, min(arr) AS min_arr, max(arr) AS max_arr
FROM tel WHERE pod <> 1 AND arr >= {ORIGIN_MS} AND arr < {ORIGIN_MS + CHUNK_LOOKBACK_MS}
GROUP BY pod, (arr - {ORIGIN_MS}) // {CHUNK_MS}"""))
def q_range_scan_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.range_scan import range_scan_chunks
    r = range_scan_chunks(_tel_between(spark, sf_dir, ORIGIN_MS, ORIGIN_MS + CHUNK_LOOKBACK_MS), [0, 2, 3],
                          ORIGIN_MS, CHUNK_LOOKBACK_MS, CHUNK_MS)
    return r.groupBy("pod", "chunk").agg(F.count(F.lit(1)).alias("n_rows"), F.min("arr").alias("min_arr"),
                                         F.max("arr").alias("max_arr"))


@register("incremental_cycles", sql(select=f"""
SELECT (arr - {CYCLE_START_MS}) // {CYCLE_LOOKBACK_MS} AS cycle, pod,
       ((arr - {CYCLE_START_MS}) % {CYCLE_LOOKBACK_MS}) // {CYCLE_CHUNK_MS} AS chunk,
       count(*) AS n_rows, min(seq) AS min_seq, max(seq) AS max_seq
FROM tel WHERE arr >= {CYCLE_START_MS} GROUP BY 1, 2, 3"""))
def q_incremental_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 batch form: contiguous 1-day cycles from a resume point, 6-hour chunks."""
    from ..sources.range_scan import cycles
    c = cycles(_tel_between(spark, sf_dir, CYCLE_START_MS), CYCLE_START_MS, CYCLE_LOOKBACK_MS, CYCLE_CHUNK_MS)
    return c.groupBy("cycle", "pod", "chunk").agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.min("seq").alias("min_seq"), F.max("seq").alias("max_seq"))


@register("record_normalize", sql(select="""
SELECT 'influx_' || CAST(epoch_us(e.ts) * 1000 AS VARCHAR) AS id,
       CASE WHEN e.event_id % 5 = 0 THEN t.vin || '-v' ELSE t.vin END AS vincode,
       CASE WHEN e.event_id % 3 = 0 THEN 'f_' || t.resource_id ELSE t.resource_id END AS resource_id,
       coalesce(d.resource_name,
                CASE WHEN e.event_id % 3 = 0 THEN 'f_' || t.resource_id ELSE t.resource_id END) AS resource_name,
       CAST(CAST(round(t.value * 100) AS BIGINT) AS VARCHAR) AS value,
       t.arr AS captured_ts, t.arr AS ts, 'influx' AS source, epoch_us(e.ts) * 1000 AS ns_ts
FROM events e JOIN tel t ON e.event_id = t.seq
LEFT JOIN sensor_dict d
  ON d.resource_id = CASE WHEN e.event_id % 3 = 0 THEN 'f_' || t.resource_id ELSE t.resource_id END
WHERE e.event_id % 13 <> 0"""))
def q_record_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.range_scan import normalize_records
    from .derived import store_records
    recs = store_records(tv.telemetry_from_events(tv.table(spark, sf_dir, "events"), extra=("ts",)))
    return normalize_records(recs, tv.sensor_dictionary(spark))


@register("csv_scan_parse", sql(select="""
SELECT 'csv_' || CAST(seq AS VARCHAR) AS id, vin AS vincode, resource_id, resource_id AS resource_name,
       CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS value,
       CASE WHEN seq % 9 = 6 THEN -42 ELSE arr END AS captured_ts,
       CASE seq % 9 WHEN 2 THEN 0 WHEN 3 THEN 9223372036854775807 WHEN 4 THEN 0 ELSE received_at END AS ts,
       'csv' AS source, CASE WHEN seq % 7 = 0 THEN 0 ELSE 2000000000000000000 - seq END AS ns_ts
FROM tel WHERE seq % 9 NOT IN (0, 5)"""))
def q_csv_scan_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading lines derived from events are written as text files and read back."""
    from ..schemas import READING_COLUMNS
    from ..sources.lines import read_reading_lines
    return read_reading_lines(spark, _line_files(spark, sf_dir)).select(*READING_COLUMNS)


ROW_CAP = 500


@register("csv_row_cap", sql(select=f"""
SELECT 'csv_' || CAST(seq AS VARCHAR) AS id, vin AS vincode, seq FROM tel
WHERE seq % 9 NOT IN (0, 5) ORDER BY seq LIMIT {ROW_CAP}"""))
def q_csv_row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first valid rows in file order (the cap is the feature)."""
    from ..sources.lines import read_reading_lines
    rows = read_reading_lines(spark, _line_files(spark, sf_dir), max_lines=ROW_CAP)
    return rows.select("id", "vincode", F.substring("id", 5, 20).cast("long").alias("seq"))


@register("resource_load_json", sql(select="""
SELECT resource_id, arg_min(resource_id || '_' || CAST(CAST(substr(vin, 4) AS BIGINT) % 3 AS VARCHAR), seq) AS resource_name,
       'R' AS operation, 'Active' AS state
FROM tel GROUP BY resource_id"""))
def q_resource_load_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary document written by Spark and loaded, the first entry of an id winning."""
    from ..session import scratch_path
    from ..sources.dictionary import load_resource_matrix
    from .derived import dictionary_document
    path = scratch_path(spark, "dictionary")
    dictionary_document(tv.telemetry(spark, sf_dir)).write.text(path)
    return load_resource_matrix(spark, path)


@register("resource_dim_first", sql(select="""
SELECT resource_id, resource_name, operation, state, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY pos) AS rn FROM (
    SELECT seq AS pos, CASE WHEN seq % 17 = 0 THEN '' ELSE resource_id END AS resource_id,
           resource_id || '_' || CAST(seq % 3 AS VARCHAR) AS resource_name, 'R' AS operation,
           CASE WHEN seq % 2 = 0 THEN 'Active' ELSE 'InActive' END AS state FROM tel)
  WHERE resource_id <> '') WHERE rn = 1"""))
def q_resource_dim_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.dictionary import dedupe_first
    from .derived import dictionary_entries
    return dedupe_first(dictionary_entries(tv.telemetry(spark, sf_dir)))


@register("resource_dim_last", sql(select="""
SELECT resource_id, resource_name, operation, state, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY pos DESC) AS rn FROM (
    SELECT seq AS pos, CASE WHEN seq % 17 = 0 THEN '' ELSE resource_id END AS resource_id,
           resource_id || '_' || CAST(seq % 3 AS VARCHAR) AS resource_name, 'R' AS operation,
           CASE WHEN seq % 2 = 0 THEN 'Active' ELSE 'InActive' END AS state FROM tel))
WHERE rn = 1"""))
def q_resource_dim_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.dictionary import dedupe_last
    from .derived import dictionary_entries
    return dedupe_last(dictionary_entries(tv.telemetry(spark, sf_dir)))


# -- T1 / W2 streaming --------------------------------------------------------

SLICES = 4                                       # runs of the streaming replays, each one micro-batch
SENTINEL_TS = "2100-01-01 00:00:00"              # event time that closes every real window

# The slice of an event: a quarter of the id range each.
SLICE_SQL = f"(seq * {SLICES}) // ((SELECT max(seq) FROM tel) + 1)"


def _stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream, in place: a folder of files, or one file (by its folder and name)."""
    root, source = sf_dir.rstrip("/"), spark.readStream.schema(tv.table(spark, sf_dir, name).schema)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return source.parquet(f"{root}/{name}.parquet")
    return source.option("pathGlobFilter", f"{name}.parquet").parquet(root)


def _replay(spark: SparkSession, rows: DataFrame, start) -> None:
    """Streams ``rows`` in ``SLICES`` runs by ``seq``: each slice is written as files
    (as many as the session's shuffle partitions) to the folder a file stream reads,
    and ``start(stream)`` takes it up where the checkpoint left off, so every run
    after the first is a restart."""
    from ..session import scratch_path
    path, top = scratch_path(spark, "stream_in"), rows.agg(F.max("seq")).first()[0]
    for i in range(SLICES):
        lo, hi = (None if top is None else -(-i * (top + 1) // SLICES)), (None if top is None else -(-(i + 1) * (top + 1) // SLICES))
        part = rows if top is None else rows.where((F.col("seq") >= lo) & (F.col("seq") < hi))
        part.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).write.mode("append").parquet(path)
        start(spark.readStream.schema(rows.schema).parquet(path)).awaitTermination()


def _replay_readings(spark: SparkSession, sf_dir: str, name: str, **kw) -> str:
    """The readings through ``start_latest_state``; returns the state's path."""
    from ..session import scratch_path
    from ..streaming.latest import start_latest_state
    state, ckpt = scratch_path(spark, f"{name}_state"), scratch_path(spark, f"{name}_ckpt")

    def start(stream):
        readings = lookup_inner(stream, tv.sensor_dictionary(spark))
        return start_latest_state(readings.select("vin", "sensor", "value", "received_at", "seq"), state, ckpt, **kw)
    _replay(spark, tv.telemetry(spark, sf_dir), start)
    return state


@register("stream_latest", LATEST_SQL)
def q_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file stream, restarted between slices, through J1 into the bucketed
    latest-state table via foreachBatch; returns the final state."""
    from ..streaming.latest import read_state
    state = _replay_readings(spark, sf_dir, "latest")
    return read_state(spark, state).where(F.col("sensor").isNotNull()).select(
        "vin", "sensor", "value", "received_at", "seq")


MINUTE_MS = 60_000


@register("stream_latest_ttl", sql(f"sliced AS (SELECT *, {SLICE_SQL} AS slice FROM readings)", """life AS (
  SELECT vin, max(slice) AS last, bool_or(slice = 0) AND bool_or(slice = 3) AND NOT bool_or(slice IN (1, 2)) AS restarted
  FROM sliced GROUP BY vin)""", select="""
SELECT vin, sensor, value, received_at, seq FROM (
  SELECT s.*, row_number() OVER (PARTITION BY s.vin, s.sensor ORDER BY s.received_at DESC, s.seq DESC) AS rn
  FROM sliced s JOIN life l USING (vin)
  WHERE s.received_at >= 0 AND l.last >= 2 AND (NOT l.restarted OR s.slice = 3))
WHERE rn = 1"""))
def q_stream_latest_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 in streaming: flushes 10 minutes apart, a 15-minute TTL. A device last seen
    two flushes ago is gone; one that comes back after that starts empty."""
    from ..streaming.latest import read_state
    clock = iter(range(NOW_MS, NOW_MS + 1_000 * MINUTE_MS, 10 * MINUTE_MS))
    state = _replay_readings(spark, sf_dir, "ttl", ttl_ms=15 * MINUTE_MS, clock=lambda: next(clock))
    return read_state(spark, state).where(F.col("sensor").isNotNull()).select(
        "vin", "sensor", "value", "received_at", "seq")


@register("stream_topic_merge", sql(select="""
SELECT vin, resource_id AS sensor, value, received_at, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY vin, resource_id ORDER BY received_at DESC, seq DESC) AS rn
  FROM tel WHERE seq % 14 IN (7, 9) AND received_at >= 0) WHERE rn = 1"""))
def q_stream_topic_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge half end to end: topic records through routing, decoding (VARIANT
    values) and the latest state."""
    from ..session import scratch_path
    from ..streaming.latest import read_state
    from ..streaming.topic_merge import start_merge
    from .derived import topic_records
    state, ckpt = scratch_path(spark, "merge_state"), scratch_path(spark, "merge_ckpt")
    records = topic_records(tv.telemetry(spark, sf_dir)).withColumn("seq", F.col("offset"))
    _replay(spark, records, lambda stream: start_merge(stream, state, ckpt))
    return read_state(spark, state).where(F.col("sensor").isNotNull()).select(
        "vin", "sensor", F.try_variant_get("value", "$", "double").alias("value"), "received_at", "seq")


@register("stream_window", REGISTRY["window_event_time"].sql)
def q_stream_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark (10 s) + 2-minute event-time windows, append mode into a
    parquet sink. The events are streamed in place; a second stream of one
    far-future row moves the watermark past every real window, and its own window
    never closes."""
    from ..session import scratch_path
    from ..streaming.window import windowed_latest
    events = tv.table(spark, sf_dir, "events")
    end = scratch_path(spark, "sentinel")
    sentinel_ms = F.unix_millis(F.lit(SENTINEL_TS).cast("timestamp"))
    (events.limit(1).withColumn("event_type", F.lit(tv.SENSOR_DICTIONARY[0][0]))
     .withColumn("ts", F.lit(SENTINEL_TS).cast("timestamp_ntz")).write.parquet(end))
    stream = _stream_table(spark, sf_dir, "events").unionByName(spark.readStream.schema(events.schema).parquet(end))
    readings = lookup_inner(tv.telemetry_from_events(stream), tv.sensor_dictionary(spark)).withColumn(
        "event_time", F.timestamp_millis("arr"))
    out = scratch_path(spark, "window_out")
    q = (windowed_latest(readings, "event_time", EVENT_WINDOW_MS, 10_000)
         .writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "window_ckpt"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).where(F.col("window_start") < sentinel_ms).select("window_start", "vin", "sensor", "value", "received_at", "seq")


# flushes of the W1 stream: two in the first window, one in the second, one after it
WINDOW_CLOCK = [NOW_MS, NOW_MS + MINUTE_MS, NOW_MS + 150_000, NOW_MS + 300_000]


@register("stream_window_flush", sql(f"sliced AS (SELECT *, {SLICE_SQL} AS slice FROM readings)", f"""emitted AS (
  SELECT * FROM (VALUES (1, {NOW_MS}, {NOW_MS + 150_000}), (2, {NOW_MS + 120_000}, {NOW_MS + 300_000})) AS e(upto, window_start, tick))""",
                                    select="""
SELECT tick, window_start, vin AS key, sensor, value, received_at, window_start + 120000 AS produced_at FROM (
  SELECT e.tick, e.window_start, s.*,
         row_number() OVER (PARTITION BY e.tick, s.vin, s.sensor ORDER BY s.received_at DESC, s.seq DESC) AS rn
  FROM emitted e JOIN sliced s ON s.slice <= e.upto WHERE s.received_at >= 0) WHERE rn = 1"""))
def q_stream_window_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 in streaming: 2-minute flush-time windows, 10 s lateness, over four flushes;
    the emitted messages, decoded."""
    from ..session import scratch_path
    from ..streaming.emitters import WindowStreamEmitter
    out, clock = scratch_path(spark, "window_messages"), iter(WINDOW_CLOCK)
    emitter = WindowStreamEmitter(scratch_path(spark, "window_buffer"),
                                  lambda df, i: df.write.mode("overwrite").parquet(f"{out}/flush={i}"))
    _replay_readings(spark, sf_dir, "wflush", emitter=emitter, clock=lambda: next(clock))
    return decoded(spark.read.parquet(out), ("tick", "key", "window_start")).select(
        "tick", "window_start", "key", "sensor", "value", "received_at", "produced_at")


# -- volume: A2 on lineitem ---------------------------------------------------

@register("latest_merge_volume", sql(select="""
SELECT vin, sensor, value, received_at, seq FROM (
  SELECT 'SUP' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS vin,
         'line_' || CAST(l_linenumber AS VARCHAR) AS sensor,
         l_extendedprice AS value, epoch_us(l_shipdate) // 1000 AS received_at,
         l_orderkey * 8 + l_linenumber AS seq,
         row_number() OVER (PARTITION BY l_suppkey, l_linenumber
                            ORDER BY epoch_us(l_shipdate) // 1000 DESC, l_orderkey * 8 + l_linenumber DESC) AS rn
  FROM lineitem) WHERE rn = 1"""))
def q_latest_merge_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 over lineitem read as readings: device = supplier, sensor = line number,
    received_at = ship date, arrival = (order, line)."""
    from ..functions import epoch_millis
    li = tv.table(spark, sf_dir, "lineitem")
    rows = li.select(
        F.concat(F.lit("SUP"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0")).alias("vin"),
        F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")).alias("sensor"),
        F.col("l_extendedprice").alias("value"),
        epoch_millis("l_shipdate").alias("received_at"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))
    return merge.latest_merge(rows).select("vin", "sensor", "value", "received_at", "seq")


# -- more T4 / W2 views ---------------------------------------------------------

@register("window_device_rollup", sql(f"""ew AS (
  SELECT *, arr - arr % {EVENT_WINDOW_MS} AS window_start FROM readings
  WHERE vin <> '' AND received_at >= 0)""", f"""wl AS (
  SELECT window_start, vin, sensor, received_at FROM (
    SELECT *, row_number() OVER (PARTITION BY window_start, vin, sensor
                                 ORDER BY received_at DESC, seq DESC) AS rn FROM ew) WHERE rn = 1)""", select="""
SELECT window_start, vin, count(*) AS n_sensors, max(received_at) AS max_received_at
FROM wl GROUP BY window_start, vin"""))
def q_window_device_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 chained with a device roll-up per (window, vin)."""
    from ..operators.windows import window_device_rollup, window_latest
    return window_device_rollup(window_latest(tv.readings(spark, sf_dir), EVENT_WINDOW_MS)).select(
        "window_start", "vin", "n_sensors", "max_received_at")


@register("flush_inline", sql(*snapshot_ctes(SNAP_TTL_MS), select="""
SELECT tick, vin AS key, sensor, value, received_at, tick AS produced_at FROM snap"""))
def q_flush_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 inline: one keyed payload per live device per flush, decoded."""
    from ..operators.strategies import emit
    out = emit("inline", _snapshots(spark, sf_dir, SNAP_TTL_MS))
    return decoded(out, ("tick", "key")).select("tick", "key", "sensor", "value", "received_at", "produced_at")


@register("batched_flush", sql(*snapshot_ctes(SNAP_TTL_MS), f"""devs AS (
  SELECT tick, vin, n // {BATCH_SIZE} AS msg_idx, n % {BATCH_SIZE} AS pos FROM (
    SELECT tick, vin, row_number() OVER (PARTITION BY tick ORDER BY vin) - 1 AS n FROM (SELECT DISTINCT tick, vin FROM snap)))""",
                             select="""
SELECT d.tick, d.msg_idx, count(DISTINCT d.vin) OVER (PARTITION BY d.tick, d.msg_idx) AS num_of_data, d.pos, d.vin,
       s.sensor, s.value, s.received_at, d.tick AS produced_at
FROM devs d JOIN snap s ON s.tick = d.tick AND s.vin = d.vin"""))
def q_batched_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 log_compacted with batch size 100: every flush packed on its own (A5 per tick), decoded."""
    from ..operators.strategies import emit
    out = emit("log_compacted", _snapshots(spark, sf_dir, SNAP_TTL_MS), batch_size=BATCH_SIZE)
    return decoded_batches(out, ("tick", "msg_idx")).select(
        "tick", "msg_idx", "num_of_data", "pos", "vin", "sensor", "value", "received_at", "produced_at")


# -- volume: T2/T3 replay on lineitem --------------------------------------------

LI_DAY_MS = DAY_MS
LI_SEQ_SHIFT = 1 << 40                   # seq = ship day * 2^40 + order * 8 + line (monotone in arrival)
LI_PERIOD_MS = 30 * DAY_MS               # flush every 30 days
LI_TTL_MS = 45 * DAY_MS                  # evict suppliers idle for 45 days

LINEITEM_READINGS_CTE = f"""li AS (
  SELECT 'SUP' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS vin,
         'line_' || CAST(l_linenumber AS VARCHAR) AS sensor,
         l_extendedprice AS value,
         epoch_us(l_shipdate) // 1000 AS arr,
         epoch_us(l_shipdate) // 1000 - (l_orderkey % 5) * {LI_DAY_MS} AS received_at,
         (epoch_us(l_shipdate) // 1000 // {LI_DAY_MS}) * {LI_SEQ_SHIFT} + l_orderkey * 8 + l_linenumber AS seq
  FROM lineitem)"""


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as readings: device = supplier, sensor = line number, arrival =
    ship date, received_at = ship date minus 0-4 days (out of order, tied)."""
    from ..functions import epoch_millis, floor_div
    li = tv.table(spark, sf_dir, "lineitem")
    arr = epoch_millis("l_shipdate")
    return li.select(
        F.concat(F.lit("SUP"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0")).alias("vin"),
        F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")).alias("sensor"),
        F.col("l_extendedprice").alias("value"),
        arr.alias("arr"),
        (arr - F.pmod("l_orderkey", F.lit(5)) * LI_DAY_MS).alias("received_at"),
        (floor_div(arr, LI_DAY_MS) * LI_SEQ_SHIFT + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))


def _li_snapshot_sql() -> str:
    P, ttl = LI_PERIOD_MS, LI_TTL_MS
    return sql(LINEITEM_READINGS_CTE, f"""incs AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR ((prev + {ttl}) // {P} + 1) * {P} <= arr THEN 1 ELSE 0 END)
              OVER (PARTITION BY vin ORDER BY arr, seq ROWS UNBOUNDED PRECEDING) AS inc
  FROM (SELECT *, lag(arr) OVER (PARTITION BY vin ORDER BY arr, seq) AS prev FROM li))""",
               f"""ticks AS (SELECT unnest(generate_series((min(arr) // {P} + 1) * {P}, (max(arr) // {P} + 1) * {P}, {P})) AS t FROM li)""",
               """seen AS (SELECT tk.t, i.* FROM ticks tk JOIN incs i ON i.arr < tk.t)""",
               """cur AS (SELECT t, vin, max(inc) AS inc FROM seen GROUP BY t, vin)""",
               f"""live AS (
  SELECT s.t, s.vin, s.inc FROM seen s JOIN cur c ON s.t = c.t AND s.vin = c.vin AND s.inc = c.inc
  GROUP BY s.t, s.vin, s.inc HAVING s.t - max(s.arr) <= {ttl})""",
               """snap AS (
  SELECT t AS tick, vin, sensor, value, received_at, seq FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.t, s.vin, s.sensor
                                   ORDER BY s.received_at DESC, s.seq DESC) AS rn
    FROM seen s JOIN live l ON s.t = l.t AND s.vin = l.vin AND s.inc = l.inc
    WHERE s.received_at >= 0) WHERE rn = 1)""", select="""
SELECT tick, vin, sensor, value, received_at, seq FROM snap""")


@register("flush_snapshot_volume", _li_snapshot_sql())
def q_flush_snapshot_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T3 on lineitem: 30-day flushes, 45-day idle TTL, every supplier × line."""
    from ..operators.snapshot import snapshots
    return snapshots(lineitem_readings(spark, sf_dir), LI_PERIOD_MS, LI_TTL_MS, None)


@register("stream_state_store", sql(LATEST_CTE, select=f"""
SELECT 'latest:' || vin AS key, vin, count(*) OVER (PARTITION BY vin) AS n_sensors, sensor, value, received_at,
       {NOW_MS + (SLICES - 1) * 1_000} AS produced_at
FROM latest"""))
def q_stream_state_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 in streaming: every micro-batch (flush) upserts ``latest:<vin>`` into
    the keyed store; the view after the last flush shows every device, decoded."""
    from ..session import scratch_path
    from ..streaming.emitters import StateStoreEmitter
    store = StateStoreEmitter(scratch_path(spark, "kv_store"))
    ticks = iter(range(NOW_MS, NOW_MS + 10_000_000, 1_000))   # deterministic flush clock, 1 s apart
    _replay_readings(spark, sf_dir, "kv", emitter=store, clock=lambda: next(ticks))
    view = store.view(spark, NOW_MS + SLICES * 1_000)
    return decoded(view, ("key", "n_sensors")).select(
        "key", "vin", "n_sensors", "sensor", "value", "received_at", "produced_at")


@register("route_counts", sql(select=f"""
SELECT {ROUTE_SQL_CASE} AS route, count(*) AS n_messages FROM events GROUP BY 1"""))
def q_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flush / error / skip / telemetry message counts (the merger's skip
    and error counters), one map-side-combined count per route."""
    from .derived import raw_messages
    routed = messages.with_route(raw_messages(tv.telemetry(spark, sf_dir)), "value")
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n_messages"))


TRIGGER_TTL_MS = 3 * tv.HOUR_MS          # idle devices are gone after three hours


@register("flush_on_trigger", sql("""flushes AS (
  SELECT row_number() OVER (ORDER BY seq) AS flush, seq, arr AS tick FROM tel WHERE seq % 14 IN (0, 1))""", """sent AS (
  SELECT *, lag(arr) OVER w AS prev, lag(seq) OVER w AS prev_seq FROM tel WHERE seq % 14 IN (7, 9) WINDOW w AS (PARTITION BY vin ORDER BY seq))""",
                                  f"""dropped AS (
  SELECT DISTINCT s.seq FROM sent s JOIN flushes f ON f.seq > s.prev_seq AND f.seq < s.seq AND f.tick - s.prev > {TRIGGER_TTL_MS})""",
                                  """incs AS (
  SELECT s.*, count(d.seq) OVER (PARTITION BY s.vin ORDER BY s.seq) AS inc FROM sent s LEFT JOIN dropped d USING (seq))""",
                                  f"""lives AS (
  SELECT f.flush, f.tick, f.seq AS at, i.vin, arg_max(i.inc, i.seq) AS inc, max(i.arr) AS seen
  FROM flushes f JOIN incs i ON i.seq < f.seq GROUP BY ALL HAVING f.tick - max(i.arr) <= {TRIGGER_TTL_MS})""", select="""
SELECT flush, tick, vin, sensor, value, received_at, seq FROM (
  SELECT l.flush, l.tick, l.vin, i.resource_id AS sensor, i.value, i.received_at, i.seq,
         row_number() OVER (PARTITION BY l.flush, l.vin, i.resource_id ORDER BY i.received_at DESC, i.seq DESC) AS rn
  FROM lives l JOIN incs i ON i.vin = l.vin AND i.inc = l.inc AND i.seq < l.at WHERE i.received_at >= 0) WHERE rn = 1"""))
def q_flush_on_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 / P1 with the flushes that the message stream itself asks for: raw messages are
    routed, `_flush` messages are the ticks, telemetry between them is decoded. They are
    parsed once; both are read several times from a scratch table."""
    from ..operators.snapshot import snapshots_on
    from ..session import scratch_path
    from .derived import raw_messages
    path = scratch_path(spark, "flush_messages")
    msgs = messages.decode_payloads(raw_messages(tv.telemetry(spark, sf_dir), ("arr",)), with_device_rows=True, with_flushes=True)
    (msgs.select("flush", "seq", "arr", "vin", "sensor", F.try_variant_get("value", "$", "double").alias("value"), "received_at")
     .write.parquet(path))
    decoded = spark.read.parquet(path)
    ticks = decoded.where("flush").select("seq", F.col("arr").alias("at"))
    return snapshots_on(decoded.where("NOT flush").drop("flush"), ticks, TRIGGER_TTL_MS)


@register("etl_payloads", sql(f"""lines AS (
  SELECT vin, resource_id, seq, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS value,
         CASE seq % 9 WHEN 2 THEN {NOW_MS} WHEN 4 THEN {NOW_MS} WHEN 3 THEN 9223372036854775807
              ELSE received_at END AS received_at
  FROM tel WHERE seq % 9 NOT IN (0, 5))""", """named AS (
  SELECT l.vin, d.resource_name AS sensor, l.value, l.received_at, l.seq
  FROM lines l JOIN sensor_dict d ON l.resource_id = d.resource_id)""", """last AS (
  SELECT vin, sensor, value, received_at FROM (
    SELECT *, row_number() OVER (PARTITION BY vin, sensor ORDER BY seq DESC) AS rn FROM named)
  WHERE rn = 1)""", select=f"""
SELECT vin AS key, count(*) OVER (PARTITION BY vin) AS n_sensors, sensor, value, received_at, {NOW_MS} AS produced_at
FROM last"""))
def q_etl_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> J1 -> P5 -> A1 -> A4/P3 -> P4: reading lines, whose own timestamps fall
    or do not parse, become one keyed payload per device; decoded."""
    from ..operators.etl import etl_messages
    from ..sources.lines import parse_lines
    from .derived import reading_lines
    lines = parse_lines(reading_lines(tv.telemetry(spark, sf_dir)), keep=("seq",))
    msgs = etl_messages(lines, tv.sensor_dictionary(spark), NOW_MS, order_col="seq")
    out = messages.decode_payloads(msgs, raw="value", keep=("key", "n_sensors"))
    return out.select("key", "n_sensors", "sensor", F.try_variant_get("value", "$", "string").alias("value"),
                      "received_at", "produced_at")


@register("stream_etl", sql(f"""lines AS (
  SELECT vin, resource_id, seq, {SLICE_SQL} AS slice, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS value,
         CASE WHEN seq % 9 IN (2, 4) THEN NULL WHEN seq % 9 = 3 THEN 9223372036854775807 ELSE received_at END AS received_at
  FROM tel WHERE seq % 9 NOT IN (0, 5))""", f"""named AS (
  SELECT l.vin, d.resource_name AS sensor, l.value, l.slice, l.seq, coalesce(l.received_at, {NOW_MS} + l.slice * 1000) AS received_at
  FROM lines l JOIN sensor_dict d ON l.resource_id = d.resource_id)""", """newest AS (SELECT vin, max(slice) AS slice FROM named GROUP BY vin)""",
                            """last AS (
  SELECT vin, sensor, value, received_at, slice FROM (
    SELECT n.*, row_number() OVER (PARTITION BY vin, sensor ORDER BY seq DESC) AS rn FROM named n JOIN newest USING (vin, slice))
  WHERE rn = 1)""", select=f"""
SELECT vin AS key, slice AS epoch, sensor, value, received_at, {NOW_MS} + slice * 1000 AS produced_at FROM last"""))
def q_stream_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ETL half as a stream: reading files arrive in four lots, each a micro-batch after
    a restart; every lot's last values go to a compacted topic, whose last message of
    each device is decoded."""
    from ..session import scratch_path
    from ..streaming.etl import line_stream, start_etl
    from ..streaming.keyed_topic import _EPOCH_BITS, CompactedTopic
    from .derived import reading_lines
    path, ckpt = scratch_path(spark, "etl_lines"), scratch_path(spark, "etl_ckpt")
    topic, clock = CompactedTopic(scratch_path(spark, "etl_topic")), iter(range(NOW_MS, NOW_MS + 1_000_000, 1000))
    tel = tv.telemetry(spark, sf_dir)
    top = tel.agg(F.max("seq")).first()[0]
    for i in range(SLICES):
        part = tel if top is None else tel.where(F.expr(f"(seq * {SLICES}) div {top + 1}") == i)
        # lines in arrival order by path; the files of a lot sort after those of the lot before
        (reading_lines(part).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "seq").sortWithinPartitions("seq")
         .select("value").write.text(f"{path}/lot={i}"))
        start_etl(line_stream(spark, f"{path}/lot=*"), tv.sensor_dictionary(spark), topic.publish, ckpt, clock=lambda: next(clock)).awaitTermination()
    held = topic.latest(spark).withColumn("epoch", F.shiftright("offset", _EPOCH_BITS))
    out = messages.decode_payloads(held, raw="value", keep=("key", "epoch"))
    return out.select("key", "epoch", "sensor", F.try_variant_get("value", "$", "string").alias("value"), "received_at", "produced_at")
