"""A store client for the connector's tests: parquet partitioned by pod."""

import pyarrow as pa
import pyarrow.dataset as ds


def parquet_fetch(pod, lo, hi, measurement, options):
    part = ds.partitioning(pa.schema([("pod", pa.string())]), flavor="hive")
    data = ds.dataset(options["store_path"], format="parquet", partitioning=part)
    t = ds.field("_time_ms")
    cols = ["_time_ms", "_value", "_field", "vincode", "vin", "resource_id"]
    yield from data.to_batches(columns=cols, filter=(ds.field("pod") == pod) & (t >= lo) & (t < hi))
