from .core import (  # noqa: F401
    INT64_MAX, INT64_MIN, ceil_div, col, epoch_micros, epoch_millis,
    epoch_nanos, first_non_empty, floor_div, parse_int64, window_start,
)
