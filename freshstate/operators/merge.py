"""Latest-value kernels.

Every kernel is a ``groupBy(...).agg(max_by(...))``: Spark runs a partial
aggregate before the shuffle, so a device holding a third of all rows is
reduced to one row per (partition, key) before anything moves. ``seq`` (arrival
order) must be unique so every winner is deterministic. When the carried
columns are fixed-width the ordering pair becomes one decimal key and each
column its own ``max_by``, which keeps the aggregation in Spark's hash
aggregate; other types (strings, VARIANT) use a struct buffer (sort aggregate).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import col

# Packing (received_at, seq) into one decimal(38,0) ordering key,
# key = (received_at - 2^62) * 2^64 + (seq + 2^63). Centred, so that it fits 38
# digits for every long received_at >= 0 and every long seq.
ORDER_CENTRE = Decimal(2 ** 62)
ORDER_SCALE = Decimal(2 ** 64)
SEQ_SHIFT = Decimal(2 ** 63)

_FIXED_WIDTH = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType,
                T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def fixed_width(df: DataFrame, cols) -> bool:
    """True when every column has a fixed-width type: aggregation buffers over
    them (and a decimal key) stay in Spark's hash aggregate."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return all(isinstance(types[c], _FIXED_WIDTH) for c in cols)


def order_key(received_at="received_at", seq="seq") -> Column:
    """(received_at, seq) as one decimal(38,0) that orders exactly like the pair."""
    dec = "decimal(38,0)"
    return ((col(received_at).cast(dec) - F.lit(ORDER_CENTRE).cast(dec)) * F.lit(ORDER_SCALE).cast(dec)
            + (col(seq).cast(dec) + F.lit(SEQ_SHIFT).cast(dec))).cast(dec)


def winner_aggs(cols, key: Column) -> list[Column]:
    """``max_by(c, key)`` for every column: one consistent winner per group
    (keys are unique) with fixed-width buffers, so Spark plans a hash aggregate
    (partial + final) instead of the sort aggregate a struct buffer needs."""
    return [F.max_by(c, key).alias(c) for c in cols]


def received_at_default(ts, now_ms: int):
    """P5: a reading's ``received_at`` is its ``ts``, or ``now_ms`` when ``ts`` is 0."""
    return F.when(col(ts) == 0, F.lit(now_ms)).otherwise(col(ts))


def batch_last_value(rows: DataFrame, batch_col: str = "batch_id",
                     carry: tuple[str, ...] = ("value", "received_at")) -> DataFrame:
    """A1: last reading in *arrival order* per (batch, vin, sensor); timestamps ignored.

    Empty vins are kept here (the merger drops them later).
    """
    keys = [batch_col, "vin", "sensor"]
    if fixed_width(rows, carry):
        return rows.groupBy(*keys).agg(*winner_aggs(carry, F.col("seq")), F.max("seq").alias("seq"))
    w = F.max_by(F.struct(*carry, "seq"), F.col("seq"))
    return rows.groupBy(*keys).agg(w.alias("_w")).select(*keys, "_w.*")


def latest_merge(rows: DataFrame, keys: tuple[str, ...] = ("vin", "sensor"),
                 carry: tuple[str, ...] = ("value",)) -> DataFrame:
    """A2: per (vin, sensor) the reading with the greatest (received_at, seq).

    A reading replaces the stored one when ``received_at >= stored`` — later
    arrival wins ties; an absent sensor compares against 0, so negative
    ``received_at`` is never stored. Empty vins are ignored.
    """
    valid = rows.where((F.col("vin") != "") & (F.col("received_at") >= 0))
    if fixed_width(rows, carry):
        return valid.groupBy(*keys).agg(*winner_aggs([*carry, "received_at", "seq"], order_key()))
    w = F.max_by(F.struct(*carry, "received_at", "seq"), F.struct("received_at", "seq"))
    return valid.groupBy(*keys).agg(w.alias("_w")).select(*keys, "_w.*")


def merge_incremental(state: DataFrame, batch: DataFrame,
                      carry: tuple[str, ...] = ("value",)) -> DataFrame:
    """A3: state ⊕ batch. ``latest_merge`` is associative and commutative, so
    folding micro-batches one by one equals one merge over all of them."""
    cols = ["vin", "sensor", *carry, "received_at", "seq"]
    return latest_merge(state.select(*cols).unionByName(batch.select(*cols)), carry=carry)


def log_compact(records: DataFrame, key: str = "key",
                order: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """The latest record per key by (partition, offset) — what a compacted
    topic retains. One key always lives in one partition, so ``offset`` orders it."""
    other = [c for c in records.columns if c != key]
    w = F.max_by(F.struct(*other), F.struct(*order))
    return records.groupBy(key).agg(w.alias("_w")).select(key, "_w.*")
