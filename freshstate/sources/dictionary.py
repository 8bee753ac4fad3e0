"""S6 — sensor dictionary loading.

File shape: ``{"resource_matrix": [{resource_id, resource_name, operation,
state, description}, ...]}`` (one JSON document), or a bare array for the
last-wins variant. Entries get their position with ``posexplode``; the
de-duplication is a distributed ``min_by`` / ``max_by`` on that position.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.messages import with_body

_FIELDS = ["resource_id", "resource_name", "operation", "state"]


def read_resource_entries(spark: SparkSession, path: str, wrapped: bool = True) -> DataFrame:
    """(pos, resource_id, resource_name, operation, state) in file order; ``pos`` is
    (file, index), so entries of several files never share one.

    Fails on a file that is not one JSON document of this shape, on a field that
    is not text, and on a document without entries: an empty dictionary would
    drop every reading. A single JSON document is read by one task; dictionaries
    are a few hundred entries.
    """
    text = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    entry = "struct<" + ",".join(f"{f}:variant" for f in [*_FIELDS, "description"]) + ">"
    arr = F.try_variant_get("_v", "$.resource_matrix" if wrapped else "$", f"array<{entry}>")
    texts = F.forall(arr, lambda e: e.isNotNull() & reduce(
        lambda a, b: a & b, [e[f].isNull() | F.schema_of_variant(e[f]).isin("STRING", "VOID") for f in _FIELDS]))
    bad = arr.isNull() | (F.size(arr) == 0) | ~F.coalesce(texts, F.lit(False))
    checked = with_body(text).select("file", F.when(bad, F.raise_error(F.concat(F.lit("not a resource dictionary: "), F.col("file"))))
                          .otherwise(arr).alias("_arr"))
    ex = checked.select("file", F.posexplode("_arr").alias("_i", "e"))
    return ex.select(F.struct("file", F.col("_i").alias("index")).alias("pos"),
                     *[F.coalesce(F.try_variant_get(F.col(f"e.{f}"), "$", "string"), F.lit("")).alias(f) for f in _FIELDS])


def dedupe_first(entries: DataFrame) -> DataFrame:
    """Blank ids skipped; the first occurrence of an id wins."""
    e = entries.where(F.col("resource_id") != "")
    w = F.min_by(F.struct(*_FIELDS[1:], "pos"), F.col("pos"))
    return e.groupBy("resource_id").agg(w.alias("_w")).select("resource_id", "_w.*")


def dedupe_last(entries: DataFrame) -> DataFrame:
    """Variant loader: the last occurrence of an id wins; blank ids kept."""
    w = F.max_by(F.struct(*_FIELDS[1:], "pos"), F.col("pos"))
    return entries.groupBy("resource_id").agg(w.alias("_w")).select("resource_id", "_w.*")


def load_resource_matrix(spark: SparkSession, path: str) -> DataFrame:
    return dedupe_first(read_resource_entries(spark, path, wrapped=True)).drop("pos")


def load_resource_list(spark: SparkSession, path: str) -> DataFrame:
    return dedupe_last(read_resource_entries(spark, path, wrapped=False)).drop("pos")
