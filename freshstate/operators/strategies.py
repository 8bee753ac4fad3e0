"""Emission strategies (T4, A5, S9, W1) and the strategy registry.

A strategy turns a *snapshot* — long form ``(tick, vin, sensor, value,
received_at, seq)``, one row per live device and sensor at a flush tick, and
one row with ``sensor`` NULL for a live device without stored sensors — into
output rows. ``inline`` and ``log_compacted`` with batch size 1 are the same
message: one payload per device, key = vin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ceil_div, col, window_start
from .asof import count_before
from .messages import encode_payload, sensor_entry
from .rollup import batched_payloads, global_index

StrategyFn = Callable[..., DataFrame]

STRATEGIES: dict[str, StrategyFn] = {}

# Defaults of the reference's strategies.
STATE_STORE_TTL_MS = 5 * 60 * 1000          # cache entry TTL
STATE_STORE_PREFIX = "latest:"              # cache key prefix
WINDOW_SIZE_MS = 2 * 60 * 1000              # window_stream window size
WINDOW_LATENESS_MS = 10 * 1000              # window_stream allowed lateness


def register_strategy(name: str):
    """Make ``fn(snapshot_df, **options) -> DataFrame`` available by name."""
    def deco(fn: StrategyFn) -> StrategyFn:
        STRATEGIES[name] = fn
        return fn
    return deco


def emit(name: str, snapshot: DataFrame, **options) -> DataFrame:
    if name not in STRATEGIES:
        raise KeyError(f"unknown strategy {name!r}; known: {sorted(STRATEGIES)}")
    return STRATEGIES[name](snapshot, **options)


def _entries():
    return F.collect_list(sensor_entry())


@register_strategy("inline")
def inline(snapshot: DataFrame, produced_at=None) -> DataFrame:
    """One message per (tick, device): ``(tick, key, value)``; key = vin.

    ``produced_at`` defaults to the flush tick (the flush's "now")."""
    pa = F.col("tick") if produced_at is None else col(produced_at)
    g = snapshot.groupBy("tick", "vin").agg(_entries().alias("_e"))
    return g.select("tick", F.col("vin").alias("key"),
                    encode_payload(F.col("vin"), F.col("_e"), pa).alias("value"))


@register_strategy("log_compacted")
def log_compacted(snapshot: DataFrame, batch_size: int = 1, produced_at=None) -> DataFrame:
    """``batch_size <= 1``: as ``inline`` (keyed, for a compacted topic).
    Otherwise the devices of each flush tick are packed ``batch_size`` per
    message (A5), without a key."""
    if batch_size <= 1:
        return inline(snapshot, produced_at)
    return batched_payloads(snapshot, batch_size, produced_at, group_col="tick")


@register_strategy("state_store")
def state_store_writes(snapshot: DataFrame, ttl_ms: int = STATE_STORE_TTL_MS,
                       prefix: str = STATE_STORE_PREFIX) -> DataFrame:
    """The upserts a flush makes — ``(key, vin, produced_at, expires_at, n_sensors,
    max_received_at, value)``, key = prefix + vin. Nothing goes downstream."""
    g = snapshot.groupBy("tick", "vin").agg(
        _entries().alias("_e"), F.count("sensor").alias("n_sensors"),
        F.max("received_at").alias("max_received_at"))
    return g.select(
        F.concat(F.lit(prefix), F.col("vin")).alias("key"), "vin",
        F.col("tick").alias("produced_at"), (F.col("tick") + F.lit(ttl_ms)).alias("expires_at"),
        "n_sensors", "max_received_at",
        encode_payload(F.col("vin"), F.col("_e"), F.col("tick")).alias("value"))


def state_store_view(writes: DataFrame, now_ms: int) -> DataFrame:
    """Read side of S9: the last write per key made at or before ``now_ms``,
    visible while ``expires_at > now_ms``."""
    w = writes.where(F.col("produced_at") <= now_ms)
    last = w.groupBy("key").agg(F.max_by(F.struct(*[c for c in w.columns if c != "key"]),
                                         F.col("produced_at")).alias("_w"))
    return last.select("key", "_w.*").where(F.col("expires_at") > now_ms)


def window_last_flush(snapshot: DataFrame, period_ms: int | None = None, t_end: int | None = None,
                      window_ms: int = WINDOW_SIZE_MS, lateness_ms: int = WINDOW_LATENESS_MS) -> DataFrame:
    """W1, long form: a snapshot taken at tick T belongs to window ``T - T % window``;
    per (window, vin) the last flush in the window wins (a device absent from a
    later flush of the window keeps its earlier entry). The window is emitted at
    the first flush tick ``>= start + window + lateness`` (if one occurs by
    ``t_end``) with ``produced_at = start + window``. Without ``period_ms`` the
    flush ticks are those of the snapshot itself.
    """
    s = snapshot.withColumn("window_start", window_start("tick", window_ms))
    last = F.max("tick").over(Window.partitionBy("window_start", "vin"))
    s = (s.withColumn("_last", last).where(F.col("tick") == F.col("_last")).drop("_last")
         .withColumn("produced_at", F.col("window_start") + F.lit(window_ms)))
    closes = F.col("window_start") + F.lit(window_ms + lateness_ms)
    if period_ms is not None:
        s = s.withColumn("emit_tick", ceil_div(closes, period_ms) * period_ms)
    else:
        ticks = global_index(snapshot.select(F.col("tick").alias("_flush")).distinct(), ["_flush"], index_col="_before")
        s = (count_before(s.withColumn("_closes", closes), "_closes", ticks, "_flush", "_before")
             .join(ticks.withColumnRenamed("_flush", "emit_tick"), "_before", "left").drop("_before", "_closes"))
    return s.where(F.col("emit_tick").isNotNull() if t_end is None else F.col("emit_tick") <= F.lit(int(t_end)))


def window_messages(rows: DataFrame) -> DataFrame:
    """One message per (window, device) of long rows ``(window_start, vin, sensor,
    value, received_at, produced_at, emit_tick)``: ``(tick, key, value,
    window_start)``, ``tick`` the flush that emits it, key = vin."""
    g = rows.groupBy("emit_tick", "window_start", "produced_at", "vin").agg(_entries().alias("_e"))
    return g.select(F.col("emit_tick").alias("tick"), F.col("vin").alias("key"),
                    encode_payload(F.col("vin"), F.col("_e"), F.col("produced_at")).alias("value"), "window_start")


@register_strategy("window_stream")
def window_stream(snapshot: DataFrame, period_ms: int | None = None, t_end: int | None = None,
                  window_ms: int = WINDOW_SIZE_MS, lateness_ms: int = WINDOW_LATENESS_MS) -> DataFrame:
    """The messages of ``window_last_flush``, keyed by device, with ``window_start``."""
    return window_messages(window_last_flush(snapshot, period_ms, t_end, window_ms, lateness_ms))
