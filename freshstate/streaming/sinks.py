"""S7/S8/S10 — keyed topic source/sink options and the drop sink.

No Kafka connector jar ships with this environment, so the Kafka paths build
the option dictionaries (unit-tested) and the same ``(key, value, topic,
partition, offset, timestamp)`` rows travel through files in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_source_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                         group_id: str | None = None, **extra) -> dict:
    """Read a keyed topic from earliest (replay rebuilds state). Lost offsets
    fail the read, Spark's default, unless ``failOnDataLoss`` is passed."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_sink_options(bootstrap_servers: str, topic: str, **extra) -> dict:
    """Write ``(key, value)`` rows; key = vin on a compacted topic."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def topic_rows(df: DataFrame) -> DataFrame:
    """A keyed topic's records as ``(key, value, topic, partition, offset, timestamp)`` with text keys and values."""
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"),
                     "topic", "partition", "offset", "timestamp")


def to_topic_rows(df: DataFrame, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Shape output for a keyed-topic sink: string ``key`` and ``value``."""
    return df.select(F.col(key_col).cast("string").alias("key"), F.col(value_col).cast("string").alias("value"))


def read_topic_stream(spark, bootstrap_servers: str, topic: str, **kw) -> DataFrame:
    """A keyed topic as a stream of ``topic_rows``."""
    return topic_rows(spark.readStream.format("kafka").options(**kafka_source_options(bootstrap_servers, topic, **kw)).load())


def write_topic(df: DataFrame, bootstrap_servers: str, topic: str, fmt: str = "kafka", **extra) -> None:
    """Batch write of ``(key, value)`` rows to a keyed topic (``fmt``: the connector)."""
    to_topic_rows(df).write.format(fmt).options(**kafka_sink_options(bootstrap_servers, topic, **extra)).save()


def write_noop(df: DataFrame) -> None:
    """Evaluate and drop (the state-store flow emits nothing downstream)."""
    df.write.format("noop").mode("overwrite").save()
