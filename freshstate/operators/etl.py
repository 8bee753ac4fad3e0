"""The ETL half as one function: reading rows -> dictionary (J1) -> received_at
default (P5) -> last value per (batch, vin, sensor) in arrival order (A1) ->
one payload per (batch, device) (A4 + P3), keyed by the device (P4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import lookup_inner
from .merge import batch_last_value, received_at_default
from .messages import encode_payload


def etl_messages(readings: DataFrame, dictionary: DataFrame, now_ms: int,
                 batch_col: str | None = None, order_col: str = "line_pos") -> DataFrame:
    """READING rows (``vincode, resource_id, value, ts``) ->
    ``(batch, key, value, n_sensors, max_received_at)``.

    ``order_col`` is the arrival order and must be unique: the line position of
    the reading scan, whatever the readings' own timestamps say.
    One batch when ``batch_col`` is None (a whole file, as the reading scan
    delivers it). Every payload of a batch carries ``produced_at = now_ms``.
    Empty vins are kept here; the merge half drops them.
    """
    b = F.col(batch_col) if batch_col else F.lit(0).cast("long")
    rows = (lookup_inner(readings, dictionary)
            .select(b.alias("batch"), F.col("vincode").alias("vin"), "sensor", "value",
                    received_at_default("ts", now_ms).alias("received_at"), F.col(order_col).alias("seq")))
    last = batch_last_value(rows, "batch")
    e = F.struct(F.col("sensor"), F.col("value").cast("variant").alias("value"), F.col("received_at"))
    g = last.groupBy("batch", "vin").agg(F.collect_list(e).alias("_e"), F.count(F.lit(1)).alias("n_sensors"),
                                         F.max("received_at").alias("max_received_at"))
    return g.select("batch", F.col("vin").alias("key"),
                    encode_payload(F.col("vin"), F.col("_e"), F.lit(int(now_ms))).alias("value"),
                    "n_sensors", "max_received_at")
