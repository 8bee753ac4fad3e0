"""Scalar column helpers — all built-in Spark expressions (codegen'd, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT64_MAX = 9223372036854775807
INT64_MIN = -9223372036854775808



def col(x) -> Column:
    """Column from a name, a Column, or a literal number."""
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def floor_div(a, b) -> Column:
    """Exact floor division on longs, ``b > 0`` (SQL ``div`` truncates toward zero)."""
    a, b = col(a), col(b)
    return F.call_function("div", a - F.pmod(a, b), b)


def ceil_div(a, b) -> Column:
    """Exact ceiling division on longs, ``b > 0``."""
    a, b = col(a), col(b)
    return -floor_div(-a, b)


def window_start(ts, size) -> Column:
    """Start of the epoch-aligned tumbling window of ``size`` holding ``ts``."""
    ts = col(ts)
    return ts - F.pmod(ts, col(size))


def epoch_micros(ts) -> Column:
    """Epoch µs of a TIMESTAMP or TIMESTAMP_NTZ column, independent of the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, col(ts).cast("timestamp_ntz"))


def epoch_millis(ts) -> Column:
    """Epoch ms, floored (not rounded)."""
    return floor_div(epoch_micros(ts), 1000)


def epoch_nanos(ts) -> Column:
    """Epoch ns at µs precision (Spark timestamps hold µs)."""
    return epoch_micros(ts) * 1000


def first_non_empty(*cols) -> Column:
    """First argument that is neither NULL nor '' — else ''."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols], F.lit(""))


def parse_int64(s) -> Column:
    """String -> int64 with a strict decimal-integer grammar; anything else -> 0.

    ``try_cast`` alone is laxer (it trims blanks), hence the regex guard.
    Values beyond the int64 range clamp to the nearest bound.
    """
    s = col(s)
    ok = s.rlike(r"^[+-]?[0-9]+$")
    parsed = s.try_cast("long")
    clamped = F.when(s.startswith("-"), F.lit(INT64_MIN)).otherwise(F.lit(INT64_MAX))
    return (F.when(s.isNull() | ~ok, F.lit(0).cast("long"))
            .when(parsed.isNull(), clamped)
            .otherwise(parsed))
