"""S8 — publishing keyed records once per epoch.

``keyed_topic`` is a Python data source for writing ``(key, value)`` records to a
broker behind an injected client. Each task stages its records and returns a token;
only when all tasks have succeeded does the driver publish the tokens of the
epoch, in one call. A task that fails after staging is run again, and its first
token is never published; a micro-batch that is retried as a whole publishes
under the same epoch, which the client takes once.

The client (option ``client``, ``module:function``; called with the options) has:

- ``stage(topic, records) -> str``: takes an iterator of Arrow batches (key, value) and
  returns a token for what it holds back,
- ``publish(topic, run, epoch, tokens)``: makes the staged records visible, at most once
  for each ``(run, epoch)``,
- ``discard(topic, tokens)``: forgets staged records.

``CompactedTopic`` is a keyed topic in the shared folder, written by Spark itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from ..operators.merge import log_compact
from ..sources.store import _resolve
from .tables import VersionedTable, bucket_of, current_run, outgrown

# Records of one epoch in one partition, as bits of the offset.
_EPOCH_BITS = 40


@dataclass
class Staged(WriterCommitMessage):
    token: str


class _Writer:
    def __init__(self, options: dict):
        self.options = dict(options)
        for name in ("client", "topic"):
            if name not in self.options:
                raise ValueError(f"option {name} is missing")
        self.topic = self.options["topic"]

    def client(self):
        return _resolve(self.options["client"])(self.options)

    def write(self, iterator: Iterator) -> Staged:
        columns = ["key", "value"]
        return Staged(self.client().stage(self.topic, (b.select(columns) for b in iterator)))

    def publish(self, messages: list, run: str, epoch: str) -> None:
        self.client().publish(self.topic, run, epoch, [m.token for m in messages if m is not None])

    def discard(self, messages: list) -> None:
        self.client().discard(self.topic, [m.token for m in messages if m is not None])


class TopicStreamWriter(_Writer, DataSourceStreamArrowWriter):
    """Epochs are the micro-batches of the query named by option ``run`` (default: the topic)."""

    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, self.options.get("run", self.topic), str(batchId))

    def abort(self, messages: list, batchId: int) -> None:
        self.discard(messages)


class TopicBatchWriter(_Writer, DataSourceArrowWriter):
    """One epoch per write, unless option ``epoch`` names it: a write repeated under the
    same ``run`` and ``epoch`` (a retried ``foreachBatch``) is published once."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.epoch = self.options.get("epoch") or uuid.uuid4().hex

    def commit(self, messages: list) -> None:
        self.publish(messages, self.options.get("run", self.topic), self.epoch)

    def abort(self, messages: list) -> None:
        self.discard(messages)


class KeyedTopicDataSource(DataSource):
    @classmethod
    def name(cls):
        return "keyed_topic"

    def schema(self):
        return "key string, value string"

    def writer(self, schema, overwrite):
        return TopicBatchWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return TopicStreamWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KeyedTopicDataSource)


def publish(df: DataFrame, epoch: int, client: str, topic: str, **options) -> None:
    """The records of one flush, from inside ``foreachBatch``; a retry publishes nothing twice."""
    register(df.sparkSession)
    out = df.select(F.col("key").cast("string"), F.col("value").cast("string"))
    run = options.pop("run", None) or current_run(df.sparkSession)
    (out.write.format("keyed_topic").options(client=client, topic=topic, run=run, epoch=str(epoch), **options).mode("append").save())


class CompactedTopic:
    """A keyed, compacted topic in the shared folder: ``(key, value, partition, offset)``.

    An epoch appends its records to the partitions of their keys; it is committed as a
    version of a bucketed table, so a retried epoch replaces its first attempt and is read
    once. Offsets rise with the epoch and, within it, with the order of ``value``. A
    partition whose newer parts outweigh its base keeps the last record of each key (A6).
    """

    def __init__(self, path: str, partitions: int = 8):
        self.path, self.partitions = path.rstrip("/"), partitions

    def publish(self, records: DataFrame, epoch: int) -> None:
        table = VersionedTable(records.sparkSession, self.path, current_run(records.sparkSession))
        m = table.manifest(epoch) or {"parts": {}, "n": self.partitions}
        order = Window.partitionBy("bucket").orderBy("key", "value")
        rows = (records.select(F.col("key").cast("string"), F.col("value").cast("string"))
                .withColumn("bucket", bucket_of("key", m["n"])).repartition("bucket")
                .withColumn("partition", F.col("bucket"))
                .withColumn("offset", F.lit(epoch << _EPOCH_BITS).cast("long") + F.row_number().over(order)))
        fold = sorted(int(b) for b, p in m["parts"].items() if outgrown(p))
        if fold:
            rows = rows.persist()
            old = table.read(epoch, fold).withColumn("bucket", F.col("partition"))
            due = F.col("bucket").isin(fold)
            kept = log_compact(old.unionByName(rows.where(due))).select(*rows.columns)
            table.commit(rows.where(~due).unionByName(kept.repartition("bucket")), epoch, fold, {"n": m["n"]})
            rows.unpersist()
        else:
            table.commit(rows, epoch, facts={"n": m["n"]})

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All records still held, at least the last one of every key."""
        return VersionedTable(spark, self.path).read()

    def latest(self, spark: SparkSession) -> DataFrame | None:
        """The last record of every key."""
        rows = self.read(spark)
        return None if rows is None else log_compact(rows)
