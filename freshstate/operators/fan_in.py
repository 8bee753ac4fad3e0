"""U1 — fan-in of inputs (a topic and flush ticks) into one stream of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import floor_div


def fan_in(*inputs: DataFrame) -> DataFrame:
    """Union by column name; works for batch and streaming DataFrames alike."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)


def tick_rows(rows: DataFrame, period_ms: int, time_col: str = "arr",
              through=None) -> DataFrame:
    """Flush ticks ``t`` at every multiple of ``period_ms`` from the first one
    after the earliest row to the first one after the latest row (or
    ``through``). One row per tick: its size is span / period, not data size.
    """
    lo = (floor_div(F.min(time_col), period_ms) + 1) * period_ms
    hi = (floor_div(F.max(time_col), period_ms) + 1) * period_ms if through is None else F.lit(through)
    span = rows.agg(lo.alias("_lo"), hi.alias("_hi"))
    return span.select(F.explode(F.sequence("_lo", "_hi", F.lit(period_ms))).alias("t"))
