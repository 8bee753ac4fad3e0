"""W2 streaming — event-time tumbling windows with allowed lateness.

``withWatermark(event_time, lateness)`` + ``groupBy(window(event_time, size),
vin, sensor)`` + the latest-wins ``max_by``, append mode: a window is emitted
once, when the watermark passes its end; readings later than the watermark are
dropped. State is bounded by the open windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.strategies import WINDOW_LATENESS_MS, WINDOW_SIZE_MS


def windowed_latest(stream: DataFrame, event_time: str = "event_time",
                    window_ms: int = WINDOW_SIZE_MS, lateness_ms: int = WINDOW_LATENESS_MS,
                    carry: tuple[str, ...] = ("value",)) -> DataFrame:
    """(window_start ms, vin, sensor, <carry>, received_at, seq) per closed window."""
    valid = stream.where((F.col("vin") != "") & (F.col("received_at") >= 0))
    w = F.max_by(F.struct(*carry, "received_at", "seq"), F.struct("received_at", "seq"))
    agg = (valid.withWatermark(event_time, f"{int(lateness_ms)} milliseconds")
           .groupBy(F.window(event_time, f"{int(window_ms)} milliseconds").alias("_win"), "vin", "sensor")
           .agg(w.alias("_w")))
    return agg.select(F.unix_millis(F.col("_win.start")).alias("window_start"), "vin", "sensor", "_w.*")
