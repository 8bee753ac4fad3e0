"""A7 — flush metrics in streaming: ``observe`` per-batch counts and read them
from a ``StreamingQueryListener`` (no driver-side collection of rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.messages import ROUTE_ERROR, ROUTE_FLUSH, ROUTE_SKIP, ROUTE_TELEMETRY


def observe_routes(routed: DataFrame, name: str = "route_counts") -> DataFrame:
    """Count flush / error / skip / telemetry messages per micro-batch."""
    r = F.col("route")
    return routed.observe(
        name,
        F.count_if(r == ROUTE_FLUSH).alias("flushes"),
        F.count_if(r == ROUTE_ERROR).alias("errors"),
        F.count_if(r == ROUTE_SKIP).alias("skips"),
        F.count_if(r == ROUTE_TELEMETRY).alias("telemetry"),
    )


class MetricsCollector(StreamingQueryListener):
    """Keeps the observed metrics of each progress event (small dicts), and in ``late_rows``
    how many rows the event-time windows (W2) left out as later than the watermark. Rows
    are counted after the map-side combine: late readings of one window and sensor in a task are one."""

    @property
    def late_rows(self) -> int:
        return sum(e["late_rows"] for e in self.events)

    def __init__(self):
        self.events: list[dict] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.events.append({"batch_id": p.batchId, "input_rows": p.numInputRows,
                            "late_rows": sum(op.numRowsDroppedByWatermark for op in p.stateOperators),
                            "metrics": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
