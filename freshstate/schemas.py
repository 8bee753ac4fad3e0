"""StructTypes of the data model."""

from pyspark.sql import types as T

# One reading as the CSV file / store rows carry it (positional columns).
READING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("vincode", T.StringType()),
    T.StructField("resource_id", T.StringType()),
    T.StructField("resource_name", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("captured_ts", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("ns_ts", T.LongType()),
])

READING_COLUMNS = [f.name for f in READING.fields]
