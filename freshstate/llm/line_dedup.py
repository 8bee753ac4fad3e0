"""Line dedup by overlapping three-line windows (DataFrame code).

Every three consecutive lines of a text are hashed; windows that occur more
than once anywhere are found globally; every occurrence but the first is a
duplicate, and the lines covered by duplicate windows, merged, are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import cut, whole_text

LINES = 3


def _windows(docs: DataFrame, id_col: str, text_col: str, lines: int) -> DataFrame:
    """One row per window of lines that are not all blank: (id, text hash, position, two hashes)."""
    text = whole_text(text_col)
    one = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"), F.split(text, "\n").alias("_l"))
    cols = [f"_w{i}" for i in range(lines)]
    shifted = [F.slice("_l", i + 1, F.greatest(F.size("_l") - lines + 1, F.lit(0))).alias(c) for i, c in enumerate(cols)]
    rows = (one.where(F.size("_l") >= lines).select("_id", "_th", *shifted)
            .select("_id", "_th", F.posexplode(F.arrays_zip(*cols)).alias("_pos", "_w")))
    parts = [F.col(f"_w.{c}") for c in cols]
    return (rows.where(F.trim(F.concat(*parts)) != "")
            .select("_id", "_th", "_pos", F.xxhash64(*parts).alias("_h1"),
                    F.xxhash64(F.lit(1), *reversed(parts)).alias("_h2")))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES) -> DataFrame:
    """``id_col, text, n_lines, n_removed, spans`` for every row: the text without its duplicate lines.

    Lines end at a line feed and are compared as they are. The first occurrence
    of a window is the one with the smallest id (null ids last) and then the
    smallest position; ``spans`` lists the removed lines as (start, end), from 0,
    the end exclusive. Texts of fewer than ``lines`` lines, windows of blank
    lines, null and empty texts lose nothing (a null text comes back as empty).
    Rows repeated with the same id and text are one document and keep their
    lines together. Ids may be of any type that has an order. An empty table gives no rows; other columns are ignored.
    """
    windows = cut(_windows(docs, id_col, text_col, lines))
    if isinstance(docs.schema[id_col].dataType, IntegralType):
        # (id, position) as one number, so that the minimum is combined before the shuffle
        last = F.lit("9223372036854775808").cast("decimal(20,0)")
        order = (F.coalesce(F.col("_id").cast("decimal(20,0)"), last) * F.lit(1 << 32).cast("decimal(11,0)")
                 + F.col("_pos")).cast("decimal(38,0)")
    else:
        order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_pos")
    key = ["_h1", "_h2"]
    placed = windows.withColumn("_at", order)
    # materialised, so that the join below may split a window that a third of the rows share
    repeated = cut(placed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
                   .where("_n > 1").select(*key, "_first"))
    later = placed.join(repeated, key).where(F.col("_at") > F.col("_first"))
    # merge the covered positions of a document: a window starts a new span unless
    # it begins inside or right after the one before it
    starts = later.groupBy("_id", "_th").agg(F.sort_array(F.collect_set("_pos")).alias("_p"))
    merged = F.expr(f"""zip_with(
        filter(_p, (x, i) -> i = 0 or x > _p[i - 1] + {lines}),
        filter(_p, (x, i) -> i = size(_p) - 1 or _p[i + 1] > x + {lines}),
        (x, y) -> struct(x AS s, y + {lines} AS e))""")
    spans = starts.select("_id", "_th", merged.alias("_spans"))
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_t"), F.xxhash64(text).alias("_th"))
    joined = (rows.join(spans.withColumnsRenamed({"_id": "_sid", "_th": "_sth"}),
                        F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_th") == F.col("_sth")), "left"))
    none = F.expr("cast(array() AS array<struct<s:int,e:int>>)")
    out = joined.select("_id", "_t", F.coalesce("_spans", none).alias("_spans"))
    kept = F.expr("""array_join(flatten(transform(sequence(0, size(_spans)), i -> slice(_l,
        if(i = 0, 0, _spans[i - 1].e) + 1,
        greatest(0, if(i = size(_spans), size(_l), _spans[i].s) - if(i = 0, 0, _spans[i - 1].e))))), '\\n')""")
    hit = F.size("_spans") > 0
    return (out.withColumn("_l", F.split("_t", "\n"))
            .select(F.col("_id").alias(id_col), F.when(hit, kept).otherwise(F.col("_t")).alias("text"),
                    F.size("_l").alias("n_lines"),
                    F.aggregate("_spans", F.lit(0), lambda a, x: a + x["e"] - x["s"]).alias("n_removed"),
                    F.transform("_spans", lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"))).alias("spans")))
