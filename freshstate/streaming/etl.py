"""The ETL half as a stream: reading lines (S1) -> dictionary (J1) -> last value per batch
(A1) -> one keyed payload per device (P3/P4) -> topic (S8).

A micro-batch is a batch: its last value of every (device, sensor) in line order wins,
and its payloads are stamped with one ``now``. Lines are ordered by file, block and
place in the block; places are numbered inside the micro-batch, where every block
is read from its start by one task.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.etl import etl_messages
from ..sources.lines import located, parse_lines


def line_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of a folder of reading files: ``value, file, block``. ``max_files`` bounds a micro-batch."""
    source = spark.readStream
    if max_files is not None:
        source = source.option("maxFilesPerTrigger", max_files)
    return source.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


class EtlBatch:
    """The ``foreachBatch`` function of the ETL half. ``publish(messages, batch_id)`` gets
    ``(key, value, n_sensors, max_received_at)`` rows, keyed by device; it must take a repeated
    ``batch_id`` as a retry."""

    def __init__(self, dictionary: DataFrame, publish: Callable[[DataFrame, int], None],
                 clock: Callable[[], int] | None = None, strict_line_length: bool = False):
        self.dictionary, self.publish, self.strict = dictionary, publish, strict_line_length
        self.clock = clock or (lambda: int(time.time() * 1000))

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        readings = parse_lines(located(lines, "file", "block"), keep=("line_pos",), strict_line_length=self.strict)
        self.publish(etl_messages(readings, self.dictionary, self.clock()).drop("batch"), batch_id)


def start_etl(lines: DataFrame, dictionary: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint_location: str,
              trigger: dict | None = None, **kw):
    """Start the ETL half on a stream of lines (``line_stream``)."""
    return (lines.writeStream.foreachBatch(EtlBatch(dictionary, publish, **kw))
            .option("checkpointLocation", checkpoint_location).trigger(**(trigger or {"availableNow": True})).start())
