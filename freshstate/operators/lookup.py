"""J1 / J2 — sensor-dictionary lookups.

The dictionary is a dimension of a few hundred rows. It is broadcast only
after its size is measured against ``max_bytes``; beyond that the join stays a
shuffle join and AQE may still convert it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 32   # of a row besides its text


def bounded_broadcast(dim: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(dim)`` if its rows hold at most ``max_bytes`` bytes, else ``dim``.

    Measured at every call, over at most as many rows as ``max_bytes`` could
    hold, so it stays cheap even when the side turns out to be large, and a
    dictionary that has grown since the last call is seen to have grown.
    """
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.simpleString() in ("string", "binary") else F.lit(16)
             for f in dim.schema.fields]
    width = reduce(lambda a, b: a + b, texts, F.lit(_ROW_BYTES))
    size = dim.limit(max_bytes // _ROW_BYTES + 1).agg(F.sum(width.cast("long"))).first()[0]
    return F.broadcast(dim) if (size or 0) <= max_bytes else dim


def _names(dim: DataFrame, active_only: bool) -> DataFrame:
    d = dim
    if active_only:
        d = d.where(F.col("state") == F.lit("Active"))
    return d.select("resource_id", F.col("resource_name").alias("_dict_name"))


def lookup_inner(rows: DataFrame, dim: DataFrame, active_only: bool = False,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Keep rows whose ``resource_id`` is in the dictionary; ``sensor`` = dictionary name.

    The reference's comment says inactive resources are dropped but its code
    never reads ``state``: inactive resources pass unless ``active_only``.
    """
    names = bounded_broadcast(_names(dim, active_only), max_bytes)
    return (rows.join(names, "resource_id", "inner")
            .withColumn("sensor", F.col("_dict_name")).drop("_dict_name"))


def lookup_left(rows: DataFrame, dim: DataFrame, active_only: bool = False,
                max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Keep every row; ``sensor`` = dictionary name, falling back to the id."""
    names = bounded_broadcast(_names(dim, active_only), max_bytes)
    return (rows.join(names, "resource_id", "left")
            .withColumn("sensor", F.coalesce(F.col("_dict_name"), F.col("resource_id")))
            .drop("_dict_name"))
