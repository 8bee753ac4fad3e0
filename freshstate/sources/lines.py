"""S1 + P7 — comma-separated reading lines.

No header, no quoting: a line is split on ',' and needs at least 9 fields
(extra fields are ignored, shorter and blank lines are skipped). Columns 5, 6
and 8 parse as int64 with a strict grammar (else 0, clamped on overflow).
Every row carries ``line_pos``, its place in the input: (file, block, ordinal).
``max_lines``, if given, caps the number of *valid* rows in that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import parse_int64
from ..schemas import READING_COLUMNS

MAX_LINE_BYTES = 1024 * 1024     # with strict_line_length a longer line fails the read

_INT_COLS = {"captured_ts", "ts", "ns_ts"}


def parse_lines(lines: DataFrame, line_col: str = "value", keep: tuple[str, ...] = (),
                strict_line_length: bool = False) -> DataFrame:
    """Lines -> READING rows (plus ``keep`` columns). Lines with < 9 fields are
    dropped. ``strict_line_length`` makes a line over 1 MiB an error; otherwise it is parsed like any other."""
    parts = F.split(F.col(line_col), ",", -1)
    df = lines.select(*keep, F.col(line_col).alias("_line"), parts.alias("_p"))
    keep_row = F.size("_p") >= 9
    if strict_line_length:
        # part of the row filter (evaluated for every line), so it cannot be pruned away
        keep_row = F.when(F.octet_length("_line") > MAX_LINE_BYTES,
                          F.raise_error(F.lit("reading line longer than 1 MiB"))).otherwise(keep_row)
    df = df.where(keep_row)
    out = []
    for i, name in enumerate(READING_COLUMNS):
        c = F.col("_p")[i]
        out.append((parse_int64(c) if name in _INT_COLS else c).alias(name))
    return df.select(*keep, *out)


def located(raw: DataFrame, file: str = "_metadata.file_path", block: str = "_metadata.file_block_start") -> DataFrame:
    """Lines with ``line_pos``: file path, block start and ordinal order them as the
    files do (an ordinal rises within a block, which one task reads from its start)."""
    return raw.select(F.col("value"), F.struct(
        F.col(file).alias("file"), F.col(block).alias("block"),
        F.monotonically_increasing_id().alias("ordinal")).alias("line_pos"))


def _files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The input's files in path order (a listing, no data is read)."""
    return sorted(spark.read.text(paths).inputFiles())


def read_reading_lines(spark: SparkSession, paths: str | list[str], max_lines: int | None = None,
                       strict_line_length: bool = False) -> DataFrame:
    """READING rows and ``line_pos`` of comma-separated reading files.

    With ``max_lines`` only the first valid rows in file order are returned. Files
    are then read in path order, twice as many each time, until they hold enough
    rows; later files are never opened. Within those, one count per block and a
    window over the blocks (one row per file block of the files needed) tell
    which blocks are needed, and only their rows are numbered.
    """
    def rows(files) -> DataFrame:
        return parse_lines(located(spark.read.text(files)), keep=("line_pos",), strict_line_length=strict_line_length)

    if max_lines is None:
        return rows(paths)
    from ..operators.rollup import global_index
    files, taken, found, step = _files(spark, paths), 0, 0, 1
    while taken < len(files) and found < max_lines:
        found += rows(files[taken:taken + step]).limit(max_lines - found).count()
        taken, step = taken + step, step * 2
    parsed = rows(files[:taken] or paths)
    counts = parsed.groupBy("line_pos.file", "line_pos.block").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    needed = counts.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < max_lines)
    candidates = parsed.join(needed.select("file", "block"), (F.col("line_pos.file") == F.col("file"))
                             & (F.col("line_pos.block") == F.col("block")), "left_semi")
    idx = global_index(candidates, ["line_pos"], index_col="_line_no")
    return idx.where(F.col("_line_no") < max_lines).drop("_line_no")
