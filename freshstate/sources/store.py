"""S3 / S5 — the time-series store connector as a Python Data Source.

Batch (``spark.read.format("telemetry_store")``): one input partition per
pod × chunk of ``[start, start + lookback)``, read in parallel by executors (a
sequential cursor becomes a parallel scan). The last chunk may be short.

Streaming (``spark.readStream.format("telemetry_store")``): the offset is
the end of the last whole cycle read, in epoch ms. Without ``start_ms`` cycles
lie on the epoch's grid, so a restart finds the same grid. Each micro-batch
reads exactly ``[previous end, new end)``, every chunk clipped to it, so cycles
neither overlap nor leave gaps; the offset log in ``checkpointLocation`` is the
resume point after a restart. Offsets are committed only after the batch, never
before delivery. After an outage the range may span many cycles: chunks are
then read several to a partition, so a batch never has more than
``max_partitions`` tasks.

The store client is injected: option ``fetch`` names ``module:function``
with signature ``fetch(pod, lo_ms, hi_ms, measurement, options) -> iterable of
pyarrow.RecordBatch`` with columns ``_time_ms`` (epoch ms), ``_value``,
``_field``, ``vincode``, ``vin``, ``resource_id``. Batches stay columnar all the
way to Spark. Rows come back with ``pod`` and ``_measurement``; pass them to
``range_scan.normalize_records``.
"""

from __future__ import annotations

import importlib
import time
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual,
)

SCHEMA = ("_time timestamp, _value string, _field string, vincode string, vin string, "
          "resource_id string, pod string, _measurement string")

# Defaults of the store input.
DEFAULT_MEASUREMENT = "telemetry"
DEFAULT_LOOKBACK_MS = 10_000
DEFAULT_CHUNK_MS = 2_000
DEFAULT_MAX_PARTITIONS = 10_000


@dataclass
class StorePartition(InputPartition):
    pod: str
    lo: int
    hi: int
    chunk: int


def chunk_partitions(pods: list[str], lo: int, hi: int, chunk: int,
                     max_partitions: int = DEFAULT_MAX_PARTITIONS) -> list[StorePartition]:
    """``[lo, hi)`` of every pod in partitions of one chunk, or of several chunks
    where there would be more than ``max_partitions`` of them."""
    chunks = max(0, -(-(hi - lo) // chunk))
    most = max(1, max_partitions // max(1, len(pods)))
    span = chunk * max(1, -(-chunks // most))
    return [StorePartition(p, at, min(at + span, hi), chunk) for p in pods for at in range(lo, hi, span)]


def _resolve(path: str):
    mod, _, fn = path.partition(":")
    return getattr(importlib.import_module(mod), fn)


_TEXT = ["_value", "_field", "vincode", "vin", "resource_id"]


def _batches(fetch_path: str, part: StorePartition, measurement: str, options: dict):
    fetch = _resolve(fetch_path)
    for lo in range(part.lo, part.hi, part.chunk):
        for batch in fetch(part.pod, lo, min(lo + part.chunk, part.hi), measurement, options):
            batch = batch.filter(pc.is_valid(batch.column("_value")))
            millis = pc.cast(batch.column("_time_ms"), pa.int64())
            when = pc.cast(pc.multiply(millis, 1000), pa.timestamp("us", tz="UTC"))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [when, *[pc.cast(batch.column(c), pa.string()) for c in _TEXT],
                 pa.array([part.pod] * n, pa.string()), pa.array([measurement] * n, pa.string())],
                ["_time", *_TEXT, "pod", "_measurement"])


class _Opts:
    def __init__(self, options):
        self.options = dict(options)
        self.pods = [p for p in self.options.get("pods", "").split(",") if p]
        self.lookback = int(self.options.get("lookback_ms", DEFAULT_LOOKBACK_MS))
        self.chunk = int(self.options.get("chunk_ms", DEFAULT_CHUNK_MS))
        self.max_partitions = int(self.options.get("max_partitions", DEFAULT_MAX_PARTITIONS))
        self.measurement = self.options.get("measurement", DEFAULT_MEASUREMENT)
        if "fetch" not in self.options:
            raise ValueError("option fetch (module:function) names the store client")
        self.fetch = self.options["fetch"]

    def partitions(self, lo: int, hi: int) -> list[StorePartition]:
        return chunk_partitions(self.pods, lo, hi, self.chunk, self.max_partitions)


def _now() -> int:
    return int(time.time() * 1000)


def _millis(t: datetime, up: bool = False) -> int:
    """Epoch ms at or before ``t`` (at or after it with ``up``); UTC if it names no zone."""
    since = (t if t.tzinfo else t.replace(tzinfo=timezone.utc)) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return -(-since // timedelta(milliseconds=1)) if up else since // timedelta(milliseconds=1)


class TelemetryStoreReader(DataSourceReader):
    """Filters on the pod, the time and the measurement narrow what is fetched: pods that
    are not asked for and chunks wholly outside the time range have no partition.
    Chunks stay whole, so Spark evaluates the time filters again on their rows."""

    def __init__(self, options):
        self.o = _Opts(options)
        self.start = int(self.o.options.get("start_ms", _now() - self.o.lookback))
        self.lo, self.hi = self.start, self.start + self.o.lookback

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name == "pod" and isinstance(f, (EqualTo, In)):
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.o.pods = [p for p in self.o.pods if p in asked]
                continue
            if name == "_measurement" and isinstance(f, (EqualTo, In)):
                if self.o.measurement not in ([f.value] if isinstance(f, EqualTo) else f.value):
                    self.o.pods = []
                continue
            if name == "_time" and isinstance(getattr(f, "value", None), datetime):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.lo = max(self.lo, _millis(f.value))
                if isinstance(f, LessThan):
                    self.hi = min(self.hi, _millis(f.value, up=True))
                if isinstance(f, (LessThanOrEqual, EqualTo)):
                    self.hi = min(self.hi, _millis(f.value) + 1)
            yield f

    def partitions(self):
        # whole chunks of the range's own grid that overlap what is asked for
        first = self.start + (self.lo - self.start) // self.o.chunk * self.o.chunk
        last = self.start - (self.start - self.hi) // self.o.chunk * self.o.chunk
        return self.o.partitions(first, min(last, self.start + self.o.lookback))

    def read(self, partition):
        if partition is not None:  # Spark reads once without a partition where there is none
            yield from _batches(self.o.fetch, partition, self.o.measurement, self.o.options)


class TelemetryStoreStreamReader(DataSourceStreamReader):
    """Offsets ``{"end_ms": n}``: the end of the last whole cycle read."""

    def __init__(self, options):
        self.o = _Opts(options)
        grid = (_now() - self.o.lookback) // self.o.lookback * self.o.lookback
        self.start = int(self.o.options.get("start_ms", grid))
        self.stop = int(self.o.options["stop_ms"]) if "stop_ms" in self.o.options else None

    def initialOffset(self):
        return {"end_ms": self.start}

    def latestOffset(self):
        now = _now() if self.stop is None else min(_now(), self.stop)
        phase = self.start % self.o.lookback
        return {"end_ms": max(self.start, (now - phase) // self.o.lookback * self.o.lookback + phase)}

    def partitions(self, start, end):
        return self.o.partitions(int(start["end_ms"]), int(end["end_ms"]))

    def read(self, partition):
        yield from _batches(self.o.fetch, partition, self.o.measurement, self.o.options)

    def commit(self, end):
        pass


class TelemetryStoreDataSource(DataSource):
    @classmethod
    def name(cls):
        return "telemetry_store"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return TelemetryStoreReader(self.options)

    def streamReader(self, schema):
        return TelemetryStoreStreamReader(self.options)


def register(spark) -> None:
    """Makes the connector known to the session, and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TelemetryStoreDataSource)
