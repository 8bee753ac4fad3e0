"""Benchmark decontamination by a prefix-filtered set join (native DataFrame code only).

Every benchmark item is cut into windows of ten consecutive words. A window is a
set of positioned shingles (three words in a row); it occurs in a document only
if all of them do, so for full containment the necessary prefix of a window,
in any order of its shingles, is its first one. Shingles are ordered by rarity,
counted over all documents, so the one to be joined is the rarest; windows that
overlap mostly share it.

1. Count the benchmark's shingles over all documents.
2. Choose each window's rarest shingle (its anchor) and where in the window it lies.
3. Join the documents' shingles with the anchors. Place and length bound what can
   match: the window must begin at the shingle's place less its offset and fit into the
   document there. What is left is verified word by word.
4. Unite the matched word ranges of each text.

A joined shingle is verified by the few words round it, without a second look at the
text, and results belong to texts (by a content hash), so that repeated texts
share them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import DEFAULT_MAX_BROADCAST_BYTES, bounded_broadcast
from .common import cut, maybe_in, whole_text

WINDOW = 10
SHINGLE = 3
#: Words of a text handled together.
STRETCH = 64
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: ASCII other than digits and small letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z as a-z: runs of digits, letters and characters beyond ASCII."""
    return F.filter(F.split(F.translate(text, _UPPER, _SMALL), _BETWEEN), lambda w: w != "")


def _shingle(word_list: Column, width: int) -> Column:
    """Hash of ``width`` words and their number."""
    return F.xxhash64(*[F.get(word_list, F.lit(i)) for i in range(width)], F.lit(width))


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``item`` (the id as text), ``win`` (the window's words), one row per window."""
    cols = items.select(F.col(item_col).cast("string").alias("item"), words(whole_text(text_col)).alias("_w"))
    last = F.greatest(F.size("_w") - window, F.lit(0))
    return (cols.where(F.size("_w") > 0).select("item", "_w", F.explode(F.sequence(F.lit(0), last)).alias("_at"))
            .select("item", F.slice("_w", F.col("_at") + 1, F.lit(window)).alias("win")).distinct())


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Each distinct window's shingles: ``win, width, offset, token``. A window of fewer
    words than a shingle is one shingle."""
    distinct = windows.select("win").distinct().withColumn("width", F.least(F.size("win"), F.lit(shingle)))
    each = distinct.select("win", "width", F.explode(F.sequence(F.lit(0), F.size("win") - F.col("width"))).alias("offset"))
    token = reduce(lambda rest, w: F.when(F.col("width") == w, _shingle(F.slice("win", F.col("offset") + 1, F.lit(w)), w)).otherwise(rest),
                   range(1, shingle + 1), F.lit(None).cast("long"))
    return each.withColumn("token", token)


def _positioned(texts: DataFrame, widths: list[int], window: int) -> DataFrame:
    """``_h1, _h2, n, at, token, first, near`` of every shingle of the given widths;
    ``near`` are words of the text from place ``first`` on: all that a window with this
    shingle may hold. Texts are cut into stretches of ``STRETCH`` words first, so that
    what a row carries does not grow with the text."""
    def stretch(base: Column) -> Column:
        first = F.greatest(base - (window - 1), F.lit(0))
        return F.struct(base.alias("base"), first.alias("first"),
                        F.slice("_w", first + 1, base - first + (STRETCH + window - 1)).alias("near"))

    cut_up = (texts.where(F.size("_w") > 0)
              .select("_h1", "_h2", F.size("_w").alias("n"), F.explode(F.transform(
                  F.sequence(F.lit(0), F.size("_w") - 1, F.lit(STRETCH)), stretch)).alias("_s"))
              .select("_h1", "_h2", "n", "_s.base", "_s.first", "_s.near"))

    def one(width: int) -> DataFrame:
        last = F.least(F.col("base") + (STRETCH - 1), F.col("n") - width)
        each = cut_up.select("*", F.explode(F.when(last >= F.col("base"), F.sequence("base", last))).alias("at"))
        token = F.xxhash64(*[F.get(F.col("near"), F.col("at") - F.col("first") + i) for i in range(width)], F.lit(width))
        return each.select("_h1", "_h2", "n", "at", token.alias("token"), "first", "near")
    return reduce(DataFrame.unionByName, [one(w) for w in widths])


def contaminated_ranges(texts: DataFrame, windows: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                        max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``_h1, _h2, win, start``: where a window occurs in a text.

    ``texts``: ``_h1, _h2`` (content hash) and ``_w`` (words). The anchors are
    broadcast if they measure at most ``max_bytes``; else the shingles that a bitmap
    of fixed size lets through are shuffled to them.
    """
    shingles = cut(window_shingles(windows, min(shingle, window)))
    widths = [r[0] for r in shingles.select("width").distinct().orderBy("width").collect()]  # at most SHINGLE numbers
    if not widths:
        return (texts.select("_h1", "_h2").limit(0)
                .select("*", F.lit(None).cast("array<string>").alias("win"), F.lit(None).cast("int").alias("start")))
    places = _positioned(texts, widths, window)

    def joined(tokens: DataFrame, *cols: Column) -> DataFrame:
        side, rows = bounded_broadcast(tokens, max_bytes), places
        if side is tokens:
            rows = maybe_in(rows, F.col("token"), tokens, F.col("token")).where("_maybe")
            # what is shuffled carries the words round the shingle only
            begin = F.greatest(F.col("at") - (window - 1), F.lit(0))
            rows = rows.withColumn("near", F.slice("near", begin - F.col("first") + 1, F.lit(2 * window - 1))).withColumn("first", begin)
        return rows.join(side, "token").select(*cols)

    tokens = shingles.select("token").distinct()
    counts = joined(tokens, F.col("token")).groupBy("token").agg(F.count(F.lit(1)).alias("found"))
    # a window with a shingle that occurs nowhere occurs nowhere
    ranked = shingles.join(counts, "token", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "token", "offset")).alias("_a"))
    anchors = cut(ranked.where("_a.found > 0").select(F.col("_a.token").alias("token"), F.col("_a.offset").alias("offset"), "win"))
    start = F.col("at") - F.col("offset")
    here = F.slice("near", start - F.col("first") + 1, F.size("win"))
    hits = joined(anchors, "_h1", "_h2", "win", start.alias("start"), "n",
                  F.when((start >= 0) & (start + F.size("win") <= F.col("n")), here).alias("_here"))
    return hits.where(F.col("_here") == F.col("win")).select("_h1", "_h2", "win", "start")


def _united(ranges: DataFrame) -> DataFrame:
    """``_h1, _h2, spans``: the ranges ``start, end`` of every text, those that overlap or touch as one."""
    by_text = Window.partitionBy("_h1", "_h2").orderBy("start", "end")
    before = F.max("end").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    opens = ranges.withColumn("_opens", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    runs = (opens.withColumn("_run", F.sum("_opens").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("_h1", "_h2", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    return runs.groupBy("_h1", "_h2").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per document: ``id_col, n_words, n_hit`` (words inside an occurrence
    of a window), ``items`` (ids, as text, of the items with occurring windows,
    sorted), ``spans`` (hit word ranges ``start, end``, end exclusive, merged).

    An item of fewer than ``window`` words, but not none, is one window. Null texts
    have no words. Rows that share an item id are one item; an item without an id
    hits words and is not listed. Repeated documents and ids are judged each. Empty
    tables give no rows, or no hits. Other columns are ignored.
    """
    text = whole_text(text_col)
    hashed = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2"))
    split = hashed.select("_id", "_h1", "_h2", words(F.col("_text")).alias("_w"))
    windows = cut(item_windows(items, item_col, item_text_col, window))
    # a text's ranges, once however often the text is repeated
    ranges = cut(contaminated_ranges(split.select("_h1", "_h2", "_w"), windows, window, shingle, max_bytes).distinct())
    names = (ranges.select("_h1", "_h2", "win").join(bounded_broadcast(windows, max_bytes), "win")
             .groupBy("_h1", "_h2").agg(F.array_sort(F.collect_set("item")).alias("items")))
    spans = _united(ranges.select("_h1", "_h2", "start", (F.col("start") + F.size("win")).alias("end")).distinct())
    found = cut(spans.join(names, ["_h1", "_h2"]))
    return (split.select("_id", "_h1", "_h2", F.size("_w").alias("n")).join(found, ["_h1", "_h2"], "left").select(
        F.col("_id").alias(id_col), F.col("n").cast("long").alias("n_words"),
        F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]), F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans")))
