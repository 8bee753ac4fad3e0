"""Exact dedup by progressive refinement (native DataFrame code only).

1. Rows are grouped by byte length; a length that occurs once is settled.
2. The remaining rows are grouped by (length, hash of the first characters).
3. Only rows whose (length, prefix hash) repeats get their full content hashed.

Steps 1 and 2 work on a narrow table of 24 bytes a row. The repeated
(length, prefix hash) keys become a bitmap of a fixed size, which the last
scan tests row by row, so no text is ever shuffled: a row that the bitmap
rules out has no partner, and a row it lets through by chance is settled by
its full hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import FILTER_BITS, cut, maybe_in, whole_text


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep_cols: tuple[str, ...] = (), prefix_chars: int = 64,
                filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept`` and ``keep_cols``.

    Texts are equal when identical. Of equal texts, the row with the largest
    id stays. Null text counts as empty. A null id is smaller than any other.
    Of rows repeated with the same text and id, one stays. Ids may be of any type that has an order. An empty table
    gives no rows. Other columns are ignored unless named in ``keep_cols``
    (which must not be named keep_id, group_size or kept).
    """
    text = whole_text(text_col)
    keyed = docs.select(F.col(id_col).alias("_id"), text.alias("_text"),
                        F.octet_length(text).alias("_len"),
                        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("_prefix"),
                        *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep_cols)])
    # levels 1 and 2, on narrow rows; aggregated before they are shuffled
    narrow = cut(keyed.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n")))
    lengths = narrow.groupBy("_len").agg(F.sum("_n").alias("_all")).where("_all > 1").select("_len")
    survivors = narrow.join(lengths, "_len", "left_semi").where("_n > 1")
    # level 3: full content only for what the bitmap lets through
    key = F.xxhash64("_len", "_prefix")
    hashed = cut(maybe_in(keyed, key, survivors, key, filter_bits).select(
        "_id", F.monotonically_increasing_id().alias("_row"), "_len", "_prefix",
        F.when(F.col("_maybe"), F.sha2(F.col("_text"), 256)).alias("_full"),
        *[f"_keep_{i}" for i in range(len(keep_cols))]))
    group = ["_len", "_prefix", "_full"]
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)  # numbers stay in a hash aggregate
    by_id = F.coalesce(F.col("_id").cast("long"), F.lit(-(1 << 63))) if whole else F.struct(F.col("_id").isNotNull().alias("some"), "_id")
    # materialised, so that the join below may split a group that a third of the rows share
    groups = cut(hashed.where("_full IS NOT NULL").groupBy(*group)
                 .agg(F.count(F.lit(1)).alias("_size"), F.max("_id").alias("_max"),
                      F.max_by("_row", by_id).alias("_stays"))
                 .where("_size > 1"))
    kept = [F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep_cols)]
    return hashed.join(groups, group, "left").select(
        F.col("_id").alias(id_col),
        F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_max")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_row") == F.col("_stays"), F.lit(True)).alias("kept"), *kept)
