"""The telemetry view the registered queries run on.

The driver's ``events`` table is read as a stream of sensor readings:
device = user, sensor = event type, arrival order = ``event_id``, arrival time =
``ts``. ``received_at`` is derived so that it is out of arrival order *and*
tied (6-hour buckets of a skewed clock), which makes latest-by-received differ
from last-arrival. The same derivation is written once in Spark and once in SQL
(``TELEMETRY_SQL``) for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import epoch_millis, floor_div
from ..operators.lookup import lookup_inner

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
RECEIVED_BUCKET_MS = 6 * HOUR_MS
BATCH_ROWS = 500          # rows per ETL batch (batch_id = event_id // 500)
PODS = 4                  # pod = user_id % 4

# The sensor dictionary of the telemetry view
# (resource_id, resource_name, operation, state). "signup" is deliberately
# absent (unknown id), "error" is InActive (still passes the lookup).
SENSOR_DICTIONARY = [
    ("view", "page_view", "R", "Active"),
    ("click", "ui_click", "R", "Active"),
    ("purchase", "order_total", "RW", "Active"),
    ("error", "fault_code", "R", "InActive"),
]

DICTIONARY_SQL = "sensor_dict(resource_id, resource_name, operation, state) AS (VALUES " + ", ".join(
    "('{}', '{}', '{}', '{}')".format(*r) for r in SENSOR_DICTIONARY) + ")"

TELEMETRY_SQL = f"""tel AS (
  SELECT 'VIN' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS vin,
         event_id AS seq,
         epoch_us(ts) // 1000 AS arr,
         ((epoch_us(ts) // 1000) - ((event_id * 7919) % 97) * {HOUR_MS}) // {RECEIVED_BUCKET_MS} * {RECEIVED_BUCKET_MS} AS received_at,
         event_type AS resource_id,
         value,
         user_id % {PODS} AS pod,
         event_id // {BATCH_ROWS} AS batch_id
  FROM events)"""

# tel joined with the dictionary (J1) — the readings the aggregator passes on.
READINGS_SQL = """readings AS (
  SELECT t.vin, t.seq, t.arr, t.received_at, t.resource_id, d.resource_name AS sensor, t.value,
         t.pod, t.batch_id
  FROM tel t JOIN sensor_dict d ON t.resource_id = d.resource_id)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_SQL = with_ctes(DICTIONARY_SQL, TELEMETRY_SQL, READINGS_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sensor_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SENSOR_DICTIONARY,
                                 "resource_id string, resource_name string, operation string, state string")


def telemetry_from_events(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """events -> (vin, seq, arr, received_at, resource_id, value, pod, batch_id, *extra)."""
    arr = epoch_millis("ts")
    skew = F.pmod(F.col("event_id") * 7919, F.lit(97)) * HOUR_MS
    return events.select(
        F.concat(F.lit("VIN"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("vin"),
        F.col("event_id").alias("seq"),
        arr.alias("arr"),
        (floor_div(arr - skew, RECEIVED_BUCKET_MS) * RECEIVED_BUCKET_MS).alias("received_at"),
        F.col("event_type").alias("resource_id"),
        F.col("value"),
        F.pmod(F.col("user_id"), F.lit(PODS)).alias("pod"),
        floor_div(F.col("event_id"), BATCH_ROWS).alias("batch_id"),
        *extra,
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(table(spark, sf_dir, "events"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """telemetry ⋈ dictionary (J1): long-form readings with ``sensor``."""
    return lookup_inner(telemetry(spark, sf_dir), sensor_dictionary(spark))
