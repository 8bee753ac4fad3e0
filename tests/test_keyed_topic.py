"""Publishing once per epoch: the data source with an injected client, the compacted topic, the streaming ETL half."""

import json
import os

import pytest
from pyspark.sql import functions as F
from topic_client import published

from freshstate.operators import messages
from freshstate.streaming import keyed_topic as K
from freshstate.streaming.etl import line_stream, start_etl

CLIENT = "topic_client:FileTopic"
ROWS = [(f"V{i}", f"value {i}") for i in range(40)]


def local(path):
    path = path.replace("file:", "")
    os.makedirs(path, exist_ok=True)
    return path


def records(spark, rows=ROWS):
    return spark.createDataFrame(rows, "key string, value string").repartition(4)


def test_a_write_is_published_whole(spark, scratch):
    folder = local(scratch("topic"))
    K.publish(records(spark), 7, CLIENT, "t", folder=folder)
    assert published(folder, "t") == sorted(ROWS)
    K.publish(records(spark), 7, CLIENT, "t", folder=folder)                # the same epoch again
    assert published(folder, "t") == sorted(ROWS)
    K.publish(records(spark, [("A", None)]), 8, CLIENT, "t", folder=folder)
    assert len(json.load(open(os.path.join(folder, "t", "published", "batch-8")))) >= 1


def test_a_failed_task_publishes_nothing(spark, scratch):
    folder = local(scratch("topic"))
    K.register(spark)

    def write(epoch):
        (records(spark).write.format("keyed_topic").options(client=CLIENT, topic="t", folder=folder, fail_once="V7", run="r", epoch=epoch)
         .mode("append").save())
    with pytest.raises(Exception, match="after it has staged"):
        write("1")
    assert published(folder, "t") == []
    write("1")
    write("1")
    assert published(folder, "t") == sorted(ROWS)


def test_a_retried_micro_batch_is_published_once(spark, scratch):
    """A task of the stream fails after staging; the restarted query runs the micro-batch again."""
    folder, src, ckpt = local(scratch("topic")), scratch("src"), scratch("ckpt")
    records(spark).write.parquet(src)
    K.register(spark)

    def run():
        stream = spark.readStream.schema("key string, value string").parquet(src)
        return (stream.writeStream.format("keyed_topic").options(client=CLIENT, topic="t", folder=folder, fail_once="V7")
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    with pytest.raises(Exception):
        run().awaitTermination()
    assert published(folder, "t") == []
    run().awaitTermination()
    records(spark, [("W", "later")]).write.mode("append").parquet(src)
    run().awaitTermination()
    assert published(folder, "t") == sorted([*ROWS, ("W", "later")])


def test_a_crash_between_publishing_and_the_commit_log(spark, scratch):
    """The epoch is published, but Spark's commit log lost it: the batch runs again under its number."""
    folder, src, ckpt = local(scratch("topic")), scratch("src"), scratch("ckpt")
    records(spark).write.parquet(src)
    K.register(spark)

    def run():
        stream = spark.readStream.schema("key string, value string").parquet(src)
        (stream.writeStream.format("keyed_topic").options(client=CLIENT, topic="t", folder=folder)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
    run()
    commits = os.path.join(ckpt.replace("file:", ""), "commits")
    for name in os.listdir(commits):
        if name in ("0", ".0.crc"):
            os.unlink(os.path.join(commits, name))
    run()
    assert published(folder, "t") == sorted(ROWS)


def test_options_are_checked(spark):
    K.register(spark)
    with pytest.raises(Exception, match="client"):
        records(spark).write.format("keyed_topic").option("topic", "t").mode("append").save()


def test_the_compacted_topic(spark, scratch):
    topic = K.CompactedTopic(scratch("topic"), partitions=3)
    assert topic.latest(spark) is None
    for epoch in range(25):
        rows = ROWS if epoch == 0 else [("V1", f"new {epoch}"), ("V2", f"new {epoch}")]
        topic.publish(records(spark, rows), epoch)
        if epoch % 5 == 0:
            topic.publish(records(spark, rows), epoch)                      # a retried epoch
    last = {r.key: (r.value, r.offset >> 40) for r in topic.latest(spark).collect()}
    assert len(last) == 40 and last["V1"] == ("new 24", 24) and last["V3"] == ("value 3", 0)
    held = topic.read(spark)
    assert held.count() < 40 + 2 * 24                                       # older records were compacted
    assert held.groupBy("partition", "offset").count().where("count > 1").count() == 0


def line(vin, resource, value, ts):
    return f"id,{vin},{resource},name,{value},5,{ts},csv,0"


def test_streaming_etl_in_line_order(spark, scratch):
    """Batches are micro-batches, the last line of a batch wins whatever its time, restarts go on."""
    path, ckpt = scratch("lines"), scratch("ckpt")
    os.makedirs(path.replace("file:", ""))
    dim = spark.createDataFrame([("r1", "speed", "R", "Active"), ("r2", "fuel", "R", "Active")], "resource_id string, resource_name string, operation string, state string")
    topic, clock = K.CompactedTopic(scratch("topic")), iter([1000, 2000, 3000])

    def run(name, lines):
        with open(os.path.join(path.replace("file:", ""), name), "w") as f:
            f.write("\n".join(lines) + "\n")
        start_etl(line_stream(spark, path), dim, topic.publish, ckpt, clock=lambda: next(clock)).awaitTermination()

    def seen():
        return {r.key: json.loads(r.value) for r in topic.latest(spark).collect()}
    many = [line("A", "r1", i, 100 + i) for i in range(5000)]
    run("1.csv", [*many, line("A", "r1", "last", 3), line("A", "r2", "x", 0), line("B", "r9", "unknown", 1), "short,line", ""])
    assert seen() == {"A": {"num_of_data": 1, "data": {"id": "A", "fuel": {"value": "x", "received_at": 1000}, "speed": {"value": "last", "received_at": 3}},
                            "produced_at": 1000}}
    run("2.csv", [line("C", "r1", "c", 9)])
    assert set(seen()) == {"A", "C"} and seen()["A"]["produced_at"] == 1000
    run("3.csv", [line("A", "r2", "y", 5)])
    assert seen()["A"]["data"] == {"id": "A", "fuel": {"value": "y", "received_at": 5}}      # a payload holds its own batch only
    decoded = messages.decode_payloads(topic.read(spark), keep=("key",))
    assert decoded.where(F.col("vin") != F.col("key")).count() == 0


def test_etl_publishes_through_the_data_source(spark, scratch):
    path, folder = scratch("lines"), local(scratch("topic"))
    os.makedirs(path.replace("file:", ""))
    with open(os.path.join(path.replace("file:", ""), "1.csv"), "w") as f:
        f.write("\n".join(line(f"V{i % 3}", "r1", i, i) for i in range(30)) + "\n")
    dim = spark.createDataFrame([("r1", "speed", "R", "Active")], "resource_id string, resource_name string, operation string, state string")
    start_etl(line_stream(spark, path, max_files=1), dim, lambda df, i: K.publish(df, i, CLIENT, "t", folder=folder), scratch("ckpt"),
              clock=lambda: 5).awaitTermination()
    assert {(k, json.loads(v)["data"]["speed"]["value"]) for k, v in published(folder, "t")} == {("V0", "27"), ("V1", "28"), ("V2", "29")}
