"""T1/T2/T3 — latest-value state across micro-batches.

Each micro-batch is a flush. ``foreachBatch`` reduces the batch to one row per
(device, sensor) and appends these rows to the state's buckets as version *k*:
what a flush writes follows its batch, and it reads no state. The live state is
merged when it is read: the greatest (received_at, seq) per sensor, among the rows
of the device's last incarnation. Every row carries the flush that wrote it
(``last_seen``) and the flush before that (``prior``), and that is enough for
eviction: a device was dropped between two of its rows if the later row's prior
flush came more than ``ttl_ms`` after the earlier row (some flush saw it idle for
too long), and it is dropped now if the newest flush did.

A bucket whose appended parts outweigh its base is folded at the next flush: its
merged live rows replace it. A bucket without a row for longer than the TTL is
dropped unread. When buckets grow beyond ``SPLIT_BYTES`` on average, their number
is doubled by one full fold. A retried batch rewrites the same version.

State rows: ``(vin, sensor, <carry>, received_at, seq, last_seen)``; a device
with no stored sensor keeps one row with ``sensor`` NULL. See ``tables`` for
the layout. The kernels are the same JVM-only DataFrame code as batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.merge import fixed_width, order_key, winner_aggs
from ..operators.strategies import emit
from . import tables
from .tables import DEFAULT_BUCKETS, VersionedTable, bucket_of, current_run, outgrown

_FACTS = {"last_seen", "prior"}


def read_state(spark: SparkSession, state_path: str, before: int | None = None) -> DataFrame | None:
    """The live rows of the newest committed state (optionally older than version ``before``)."""
    return _live(VersionedTable(spark, state_path), before)


def _live(table: VersionedTable, before: int | None = None) -> DataFrame | None:
    m = table.manifest(before)
    if m is None:
        return None
    rows = table.read(before)
    return merge_rows(rows, m["now"], m["ttl"], _carry(rows))


def _carry(rows: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in rows.columns if c not in {"vin", "sensor", "received_at", "seq"} | _FACTS)


def _last_incarnation(rows: DataFrame, ttl_ms: int) -> DataFrame:
    """Rows since the device was last dropped, told by the flushes that its rows name."""
    flushes = Window.partitionBy("vin").orderBy("last_seen")
    before = F.max("last_seen").over(flushes.rangeBetween(Window.unboundedPreceding, -1))
    starts = rows.withColumn("_start", F.when(F.col("prior") - before > F.lit(int(ttl_ms)), F.col("last_seen")))
    first = F.coalesce(F.max("_start").over(Window.partitionBy("vin")), F.col("last_seen"))
    return starts.withColumn("_first", first).where(F.col("last_seen") >= F.col("_first")).drop("_start", "_first")


def merge_rows(rows: DataFrame, now_ms: int, ttl_ms: int | None, carry: tuple[str, ...] = ("value",),
               buckets: int | None = None) -> DataFrame:
    """The live rows among appended ones (``last_seen`` and, with a TTL, ``prior`` given).

    One aggregation per (vin, sensor), combined map-side, gives the winner and the last
    time seen; one window per device, over a row per sensor, spreads the latter and drops
    idle devices. With ``buckets`` the result has a column ``bucket`` and lies together by
    it: the window and a bucketed write then need no further shuffle.
    """
    cols = ["vin", "sensor", *carry, "received_at", "seq"]
    if ttl_ms is not None and "prior" in rows.columns:
        rows = _last_incarnation(rows, ttl_ms)
    stored = F.col("sensor").isNotNull() & (F.col("received_at") >= 0)
    seen, own = F.max("last_seen").alias("last_seen"), [*carry, "received_at", "seq"]
    if fixed_width(rows, own):
        key = F.when(stored, order_key())
        merged = (rows.groupBy("vin", "sensor").agg(*winner_aggs(own, key), F.max(key).alias("_key"), seen)
                  .withColumn("_has", F.col("_key").isNotNull()))
    else:
        winner = F.max_by(F.when(stored, F.struct(*own)), F.when(stored, F.struct("received_at", "seq")))
        merged = (rows.groupBy("vin", "sensor").agg(winner.alias("_w"), seen)
                  .select("vin", "sensor", "_w.*", "last_seen", F.col("_w").isNotNull().alias("_has")))
    device, out = Window.partitionBy("vin"), [*cols, "last_seen"]
    if buckets is not None:
        merged, device, out = merged.withColumn("bucket", bucket_of("vin", buckets)).repartition("bucket"), Window.partitionBy("bucket", "vin"), [*out, "bucket"]
    merged = (merged.withColumn("last_seen", F.max("last_seen").over(device))
              .withColumn("_rank", F.row_number().over(device.orderBy(F.col("_has").desc(), "sensor")))
              .where(F.col("_has") | (F.col("_rank") == 1))
              .withColumn("sensor", F.when(F.col("_has"), F.col("sensor"))))
    if ttl_ms is not None:
        merged = merged.where(F.lit(int(now_ms)) - F.col("last_seen") <= F.lit(int(ttl_ms)))
    return merged.select(*out)


def _batch_rows(batch: DataFrame, now_ms: int, carry: tuple[str, ...]) -> DataFrame:
    return (batch.where(F.col("vin").isNotNull() & (F.col("vin") != ""))
            .select("vin", "sensor", *carry, "received_at", "seq", F.lit(int(now_ms)).cast("long").alias("last_seen")))


def merge_state(prev: DataFrame | None, batch: DataFrame, now_ms: int, ttl_ms: int | None,
                carry: tuple[str, ...] = ("value",)) -> DataFrame:
    """One flush over live rows: prev ⊕ batch, then eviction. ``batch`` is long form with
    optional NULL-sensor rows (device refresh only)."""
    rows = _batch_rows(batch, now_ms, carry)
    if prev is not None:
        rows = prev.select(*rows.columns).unionByName(rows)
    return merge_rows(rows, now_ms, ttl_ms, carry)


def bootstrap_state(rows: DataFrame, state_path: str, now_ms: int, ttl_ms: int | None = None, carry: tuple[str, ...] = ("value",),
                    buckets: int = DEFAULT_BUCKETS) -> None:
    """T5 in bulk: all of a topic's rows (long form) become a state in one batch job, as one
    flush at ``now_ms`` would make it. Hand its path to a new stream (``bootstrap``) that starts
    after the rows read here."""
    table = VersionedTable(rows.sparkSession, state_path, "bootstrap")
    state = merge_rows(_batch_rows(rows, now_ms, carry), now_ms, ttl_ms, carry, buckets).withColumn("prior", F.lit(None).cast("long"))
    table.commit(state, 0, None, {"n": buckets, "now": int(now_ms), "ttl": ttl_ms, "times": {"0": int(now_ms)}})


class LatestStateBatch:
    """The ``foreachBatch`` function of the latest-state job.

    ``stats_fn`` gets one dict per flush (A7): batch, duration_ms, vin_count,
    value_count and message_count (devices over the strategy's ``batch_size``).
    ``bootstrap``: the path of a state (``bootstrap_state``) that the first batch of
    a new run starts from.
    """

    def __init__(self, state_path: str, ttl_ms: int | None = None, carry: tuple[str, ...] = ("value",),
                 strategy: str | None = None, strategy_options: dict | None = None,
                 emit_fn: Callable[[DataFrame, int], None] | None = None,
                 clock: Callable[[], int] | None = None,
                 emitter: Callable[[DataFrame, int, int], None] | None = None,
                 buckets: int = DEFAULT_BUCKETS, stats_fn: Callable[[dict], None] | None = None,
                 bootstrap: str | None = None):
        self.state_path = state_path.rstrip("/")
        self.ttl_ms = ttl_ms
        self.carry = carry
        self.strategy = strategy
        self.strategy_options = strategy_options or {}
        self.emit_fn = emit_fn
        self.clock = clock or (lambda: int(time.time() * 1000))
        self.emitter = emitter
        self.buckets = buckets
        self.stats_fn = stats_fn
        self.bootstrap = bootstrap

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        spark = batch.sparkSession
        now = self.clock()
        table = VersionedTable(spark, self.state_path, current_run(spark))
        self._append(table, batch, batch_id, now)
        emits = self.emitter is not None or (self.strategy is not None and self.emit_fn is not None)
        if not emits and self.stats_fn is None:
            return
        # every live device, also those without stored sensors (sensor NULL row)
        snap = (_live(table).select("vin", "sensor", *self.carry, "received_at", "seq")
                .withColumn("tick", F.lit(int(now)).cast("long")))
        if emits and self.stats_fn is not None:
            snap = snap.persist()      # read once for both
        if self.emitter is not None:
            self.emitter(snap, batch_id, now)
        elif emits:
            self.emit_fn(emit(self.strategy, snap, **self.strategy_options), batch_id)
        if self.stats_fn is not None:
            values, devices = snap.agg(F.count("sensor"), F.count_distinct("vin")).first()
            size = max(1, int(self.strategy_options.get("batch_size", getattr(self.emitter, "options", {}).get("batch_size", 1))))
            self.stats_fn({"batch": batch_id, "duration_ms": int((time.monotonic() - began) * 1000), "vin_count": devices,
                           "value_count": values, "message_count": -(-devices // size)})
        snap.unpersist()


    def _append(self, table: VersionedTable, batch: DataFrame, batch_id: int, now: int) -> None:
        """Commits the batch as version ``batch_id``; folds and drops buckets that are due."""
        m = table.manifest(batch_id) or {"parts": {}, "buckets": {}, "n": self.buckets, "now": None, "times": {}}
        base = VersionedTable(table.spark, self.bootstrap) if self.bootstrap and not m["parts"] and m["now"] is None else None
        m["now"] = base.manifest()["now"] if base else m["now"]
        n, parts = m["n"], m["parts"]
        total = sum(size for p in parts.values() for _, size in p)
        split = total > tables.SPLIT_BYTES * n
        # the last flush has dropped all that these hold
        idle = [] if self.ttl_ms is None else [int(b) for b, v in m["buckets"].items() if m["now"] - m["times"][str(v)] > self.ttl_ms]
        fold = sorted(int(b) for b, p in parts.items() if int(b) not in idle and (split or outgrown(p)))
        n = 2 * n if split else n
        prior = F.lit(m["now"]).cast("long").alias("prior")
        batch = batch.persist() if fold else batch
        try:
            delta = merge_rows(_batch_rows(batch, now, self.carry), now, None, self.carry, n)
            out = delta.select("*", prior)
            if base:  # the state before the stream, and the batch upon it
                start = merge_rows(base.read().unionByName(out.drop("bucket")), now, self.ttl_ms, self.carry, n)
                out = start.withColumn("prior", F.lit(None).cast("long"))
            if fold:
                own = out if split else out.where(F.col("bucket").isin(fold))
                rows = table.read(batch_id, fold).unionByName(own.drop("bucket"))
                folded = merge_rows(rows, now, self.ttl_ms, self.carry, n).withColumn("prior", F.lit(None).cast("long"))
                out = folded if split else out.where(~F.col("bucket").isin(fold)).unionByName(folded)
            times = {str(v): m["times"][str(v)] for v in m["buckets"].values()}
            table.commit(out, batch_id, None if split else fold,
                         {"n": n, "now": now, "ttl": self.ttl_ms, "times": {**times, str(batch_id): now}}, dropped=idle)
        finally:
            if fold:
                batch.unpersist()


def start_latest_state(stream: DataFrame, state_path: str, checkpoint_location: str,
                       trigger: dict | None = None, query_name: str | None = None, **kw):
    """Start the job; ``trigger`` e.g. ``{"processingTime": "30 seconds"}`` (the
    flush interval) or ``{"availableNow": True}`` for a catch-up run."""
    w = (stream.writeStream.foreachBatch(LatestStateBatch(state_path, **kw))
         .option("checkpointLocation", checkpoint_location))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def with_flush_ticks(stream: DataFrame, rows_per_second: int = 1) -> DataFrame:
    """Union a ``rate`` tick stream (rows with ``sensor`` and ``vin`` NULL) so
    that idle triggers still run a micro-batch, i.e. still flush and evict."""
    spark = stream.sparkSession
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    shaped = ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields])
    return stream.unionByName(shaped)
