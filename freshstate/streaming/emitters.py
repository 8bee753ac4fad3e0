"""Per-flush emitters for the latest-state job (T4 in streaming).

``LatestStateBatch`` calls ``emitter(snapshot, batch_id, now_ms)`` once per
micro-batch (= flush) with the full live state as long form ``(tick, vin,
sensor, value, received_at, seq)``. Emitters that keep state of their own
(the keyed store, the window buffer) use the same versioned tables as the
latest state: version = batch id, so a retried batch rewrites the same version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import window_start
from ..operators.strategies import (
    STATE_STORE_PREFIX, STATE_STORE_TTL_MS, WINDOW_LATENESS_MS, WINDOW_SIZE_MS, emit, state_store_writes, window_messages,
)
from .tables import VersionedTable, bucket_of, current_run

#: Buckets of the keyed store: what a point read divides the table by.
STORE_BUCKETS = 64


class TopicEmitter:
    """Messages of a strategy handed to ``write_fn(df, batch_id)`` (e.g. a Kafka or
    file sink)."""

    def __init__(self, strategy: str, write_fn: Callable[[DataFrame, int], None], **options):
        self.strategy, self.write_fn, self.options = strategy, write_fn, options

    def __call__(self, snapshot: DataFrame, batch_id: int, now_ms: int) -> None:
        self.write_fn(emit(self.strategy, snapshot, **self.options), batch_id)


class StateStoreEmitter:
    """Upsert ``latest:<vin>`` entries with a TTL into a keyed table.

    A flush appends its entries to the buckets of their keys; all of them expire at
    the same time, so a later flush drops them as folders, unread. A key's newest
    entry counts."""

    def __init__(self, path: str, ttl_ms: int = STATE_STORE_TTL_MS, prefix: str = STATE_STORE_PREFIX,
                 buckets: int = STORE_BUCKETS):
        self.path, self.ttl_ms, self.prefix, self.buckets = path.rstrip("/"), ttl_ms, prefix, buckets

    def __call__(self, snapshot: DataFrame, batch_id: int, now_ms: int) -> None:
        table = VersionedTable(snapshot.sparkSession, self.path, current_run(snapshot.sparkSession))
        held = (table.manifest(batch_id) or {}).get("expires", {})
        over = {v for v, at in held.items() if at <= now_ms}
        writes = state_store_writes(snapshot, self.ttl_ms, self.prefix)
        left = {v: at for v, at in held.items() if v not in over}
        table.commit(writes.withColumn("bucket", bucket_of("key", self.buckets)).repartition("bucket"), batch_id,
                     facts={"n": self.buckets, "expires": {**left, str(batch_id): int(now_ms) + self.ttl_ms}},
                     expired={int(v) for v in over})

    def view(self, spark: SparkSession, now_ms: int, key: str | None = None) -> DataFrame | None:
        """The entries visible at ``now_ms``; with ``key`` that one, from its bucket alone."""
        table = VersionedTable(spark, self.path)
        m = table.manifest()
        if m is None:
            return None
        own = None if key is None else [spark.range(1).select(bucket_of(F.lit(key), m["n"])).first()[0]]
        rows = table.read(buckets=own)
        rows = rows.where((F.col("expires_at") > F.lit(int(now_ms))) & (F.lit(True) if key is None else F.col("key") == key))
        last = rows.groupBy("key").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "key"]), F.col("produced_at")).alias("_w"))
        return last.select("key", "_w.*")


class WindowStreamEmitter:
    """W1 across micro-batches: the snapshot taken at ``now`` goes to window
    ``now - now % window``; per (window, vin) the last flush wins; windows with
    ``start + window + lateness <= now`` are emitted as messages ``(tick, key,
    value, window_start)`` (``produced_at = start + window``) and dropped from
    the buffer.

    Each open window is a folder to which a flush appends its snapshot, so a flush
    writes its snapshot and nothing else; the last flush of every device is found
    when the window closes, and the folder goes."""

    def __init__(self, buffer_path: str, write_fn: Callable[[DataFrame, int], None],
                 window_ms: int = WINDOW_SIZE_MS, lateness_ms: int = WINDOW_LATENESS_MS):
        self.path, self.write_fn = buffer_path.rstrip("/"), write_fn
        self.window_ms, self.lateness_ms = window_ms, lateness_ms

    def __call__(self, snapshot: DataFrame, batch_id: int, now_ms: int) -> None:
        now, size = int(now_ms), self.window_ms
        table = VersionedTable(snapshot.sparkSession, self.path, current_run(snapshot.sparkSession))
        held = (table.manifest(batch_id) or {"parts": {}})["parts"]
        closed = [int(w) for w in held if (int(w) + 1) * size + self.lateness_ms <= now]
        rows = snapshot.withColumn("flush_ts", F.lit(now).cast("long"))
        # emitted before the commit: a batch that fails in between is retried with the folders still there
        done = table.read(batch_id, closed) if closed else rows.limit(0)
        start = window_start("flush_ts", size)
        last = F.max("flush_ts").over(Window.partitionBy("window_start", "vin"))
        out = (done.withColumn("window_start", start).withColumn("_last", last).where(F.col("flush_ts") == F.col("_last")).drop("_last")
               .withColumn("produced_at", F.col("window_start") + F.lit(size)).withColumn("emit_tick", F.lit(now).cast("long")))
        self.write_fn(window_messages(out), batch_id)
        table.commit(rows.withColumn("bucket", F.lit(now // size)), batch_id, dropped=closed)
