"""S2, S4, S5 (batch form) — time-range scans of a pod-partitioned reading table.

The table is written with ``partitionBy("pod")`` so a pod list prunes
directories and the time range becomes a pushed-down parquet filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_millis, epoch_nanos, first_non_empty, floor_div
from ..operators.lookup import lookup_left


def range_scan(table: DataFrame, pods, start_ms: int, stop_ms: int,
               time_col: str = "arr", pod_col: str = "pod",
               measurement: str | None = None) -> DataFrame:
    """Rows of the given pods with ``start <= time < stop`` (and measurement)."""
    cond = F.col(pod_col).isin(list(pods)) & (F.col(time_col) >= start_ms) & (F.col(time_col) < stop_ms)
    if measurement is not None:
        cond = cond & (F.col("_measurement") == measurement)
    return table.where(cond)


def time_between(time_col: str, start_ms: int, stop_ms: int | None = None):
    """``start <= time < stop`` on a raw TIMESTAMP_NTZ column, as literals a parquet scan takes over."""
    def at(ms: int):
        moment = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=int(ms))
        return F.expr(f"timestamp_ntz'{moment.isoformat(sep=' ', timespec='milliseconds')}'")
    cond = F.col(time_col) >= at(start_ms)
    return cond if stop_ms is None else cond & (F.col(time_col) < at(stop_ms))


def chunk_count(lookback_ms: int, chunk_ms: int) -> int:
    """Chunks per cycle: ceil(lookback / chunk); the last one may be short."""
    return max(1, -(-int(lookback_ms) // int(chunk_ms)))


def range_scan_chunks(table: DataFrame, pods, start_ms: int, lookback_ms: int, chunk_ms: int,
                      time_col: str = "arr", pod_col: str = "pod") -> DataFrame:
    """One cycle: every pod, ``[start, start + lookback)`` in chunks of ``chunk_ms``. Adds ``chunk``."""
    return (range_scan(table, pods, start_ms, start_ms + lookback_ms, time_col, pod_col)
            .withColumn("chunk", floor_div(F.col(time_col) - F.lit(start_ms), chunk_ms)))


def cycles(table: DataFrame, start_ms: int, lookback_ms: int, chunk_ms: int,
           time_col: str = "arr") -> DataFrame:
    """S5 batch form: contiguous cycles ``[start + c*lookback, start + (c+1)*lookback)``
    from a resume point; adds ``cycle`` and ``chunk`` (chunk within the cycle)."""
    rel = F.col(time_col) - F.lit(start_ms)
    return (table.where(F.col(time_col) >= start_ms)
            .withColumn("cycle", floor_div(rel, lookback_ms))
            .withColumn("chunk", floor_div(F.pmod(rel, F.lit(lookback_ms)), chunk_ms)))


def normalize_records(records: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Store records -> READING rows.

    ``records``: ``_time`` (timestamp), ``_value`` (any; NULL rows dropped),
    ``_field``, tags ``vincode``, ``vin``, ``resource_id``. Device = vincode else
    vin; resource id = tag else field; name = dictionary name else the id.
    """
    r = records.where(F.col("_value").isNotNull())
    r = r.select(
        first_non_empty("vincode", "vin").alias("vincode"),
        first_non_empty("resource_id", "_field").alias("resource_id"),
        F.col("_value").cast("string").alias("value"),
        epoch_millis("_time").alias("_ms"),
        epoch_nanos("_time").alias("_ns"),
    )
    named = lookup_left(r, dictionary)
    return named.select(
        F.concat(F.lit("influx_"), F.col("_ns").cast("string")).alias("id"),
        "vincode", "resource_id", F.col("sensor").alias("resource_name"), "value",
        F.col("_ms").alias("captured_ts"), F.col("_ms").alias("ts"),
        F.lit("influx").alias("source"), F.col("_ns").alias("ns_ts"))
