"""The merge half end to end: keyed topic records -> route (P1) -> decode
-> latest state with eviction (T1/T2) -> emission at every flush (T3/T4).

A micro-batch is a flush, so the trigger interval is the flush interval
(``with_flush_ticks`` keeps idle intervals flushing). ``_flush`` messages in
the topic are routed away; error and skip messages are counted with
``observe`` (A7) and dropped.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_millis
from ..operators.messages import decode_payloads
from .latest import bootstrap_state, start_latest_state
from .stats import observe_routes


def decoded_topic(records: DataFrame, carry_variant: bool = True, observe: str | None = None) -> DataFrame:
    """Topic records ``(key, value, partition, offset, timestamp)`` -> long form.

    ``seq`` = offset: one device always lives in one partition (the key is the
    device), so offsets order its messages. ``arr`` = record timestamp (ms).
    ``value`` stays VARIANT (any JSON type, stored as such in the state
    table); with ``carry_variant=False`` it becomes JSON text. ``observe`` names
    the metric with the route counts of every micro-batch (A7).
    """
    msgs = records.select(F.col("offset").alias("seq"), epoch_millis("timestamp").alias("arr"),
                          F.col("value").cast("string").alias("value"))
    tap = (lambda routed: observe_routes(routed, observe)) if observe else None
    long = decode_payloads(msgs, raw="value", keep=("seq", "arr"), with_device_rows=True, tap=tap)
    if not carry_variant:
        long = long.withColumn("value", F.to_json("value"))
    return long.select("vin", "sensor", "value", "received_at", "seq", "arr")


def end_offsets(records: DataFrame) -> dict[int, int]:
    """The offset after the last record of each partition (a number per partition)."""
    return {r["partition"]: r["o"] + 1 for r in records.groupBy("partition").agg(F.max("offset").alias("o")).collect()}


def starting_offsets(topic: str, ends: dict[int, int]) -> str:
    """``ends`` as a topic source's ``startingOffsets`` option."""
    return json.dumps({topic: {str(p): o for p, o in sorted(ends.items())}})


def records_from(records: DataFrame, ends: dict[int, int]) -> DataFrame:
    """The records at or after ``ends``, for sources without starting offsets."""
    start = F.coalesce(F.create_map(*[x for p, o in ends.items() for x in (F.lit(p), F.lit(o))])[F.col("partition")], F.lit(0)) if ends else F.lit(0)
    return records.where(F.col("offset") >= start)


def bootstrap_merge(records: DataFrame, state_path: str, now_ms: int, **kw) -> dict[int, int]:
    """T5: replays all ``records`` of a topic (batch) into a state in one job and returns
    the offsets where a stream with ``bootstrap=state_path`` goes on."""
    ends = end_offsets(records)
    bootstrap_state(decoded_topic(records_upto(records, ends)), state_path, now_ms, **kw)
    return ends


def records_upto(records: DataFrame, ends: dict[int, int]) -> DataFrame:
    """The records before ``ends``: what was there when the offsets were taken, though the topic grows."""
    stop = F.create_map(*[x for p, o in ends.items() for x in (F.lit(p), F.lit(o))])[F.col("partition")] if ends else F.lit(0)
    return records.where(F.col("offset") < stop)


def start_merge(records: DataFrame, state_path: str, checkpoint_location: str, **kw):
    """Run the merge half on a topic stream; ``kw`` as ``start_latest_state``
    (``ttl_ms``, ``emitter``, ``trigger``, ``clock``, ``stats_fn``, ...). Flush, error
    and skip counts arrive as observed metric ``route_counts`` (``stats.MetricsCollector``)."""
    return start_latest_state(decoded_topic(records, observe="route_counts"), state_path, checkpoint_location, **kw)
