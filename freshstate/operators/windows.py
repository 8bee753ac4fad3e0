"""W2 — event-time tumbling windows with the latest-wins rule inside each window.

Batch form: integer window starts (epoch-aligned, identical to
``window(ts, size).start``). The streaming form with a watermark lives in
``freshstate.streaming.window``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import window_start
from .merge import fixed_width, order_key, winner_aggs


def window_latest(rows: DataFrame, window_ms: int, time_col: str = "arr",
                  carry: tuple[str, ...] = ("value",)) -> DataFrame:
    """Per (window_start, vin, sensor): the reading with the greatest (received_at, seq)."""
    keys = ["window_start", "vin", "sensor"]
    valid = (rows.where((F.col("vin") != "") & (F.col("received_at") >= 0))
             .withColumn("window_start", window_start(time_col, window_ms)))
    if fixed_width(rows, carry):
        return valid.groupBy(*keys).agg(*winner_aggs([*carry, "received_at", "seq"], order_key()))
    w = F.max_by(F.struct(*carry, "received_at", "seq"), F.struct("received_at", "seq"))
    return valid.groupBy(*keys).agg(w.alias("_w")).select(*keys, "_w.*")


def window_device_rollup(window_rows: DataFrame) -> DataFrame:
    """Chained roll-up: per (window_start, vin) sensor count and newest received_at."""
    return window_rows.groupBy("window_start", "vin").agg(
        F.count(F.lit(1)).alias("n_sensors"), F.max("received_at").alias("max_received_at"))
