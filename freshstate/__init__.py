"""freshstate — latest-state device telemetry on Spark.

Batch and Structured Streaming DataFrame functions for keeping the newest value
of every sensor per device, evicting idle devices, emitting periodic snapshots
and moving the results through JSON / CSV / keyed-topic edges.
"""

__version__ = "0.1.0"
