"""Document fingerprints by SimHash (native DataFrame code only).

Terms (three words in a row) are hashed to 128 bits; every occurrence votes for
or against each bit with its weight, and the signs of the sums are the
fingerprint. Several votes share a 64-bit sum in Spark's own aggregation.

Searching: a fingerprint is cut into blocks; two fingerprints within the chosen
radius agree on all but at most that many blocks, so a table for every choice
of the agreeing blocks, keyed by them, holds each such pair in one bucket.
A stated query set is looked up in the tables of all fingerprints.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, whole_text

BITS = 128
WORDS = 3
_HALF = 32
#: Documents per bucket of the document order, and keys sampled for each to place its bounds.
BUCKET = 2_000
MAX_BUCKETS = 1 << 16
_PER_BUCKET = 16
#: Radius and blocks of the search; each bucket of its tables is dealt over ``SALTS`` parts.
RADIUS, BLOCKS = 6, 8
SALTS = 8
_TABLE_BITS = 16


def fingerprints(rows: DataFrame, keys: list[str], text_col: str, words: int = WORDS,
                 weight: Callable[[Column], Column] | None = None, max_weight: int = 1) -> DataFrame:
    """``keys`` and ``fingerprint`` (32 hex digits), one row per distinct key.

    A term is each word and the ``words - 1`` after it (fewer at the end). Every
    occurrence votes with the ``weight`` of its first word, an integer from 0 to
    ``max_weight``; default 1, so that a term weighs as often as it occurs. Bits
    without a majority are 0; a null or empty text has fingerprint zero. ``keys``
    must identify a text.

    Words are hashed before they are combined, so that what is exploded are
    numbers. Votes are counted in two steps, so that the step that sees every term
    keeps few sums: over runs of at most 127 votes eight bits share a 64-bit sum, a
    byte each; then the runs' bytes are added, two bits to a 64-bit sum.
    """
    cols = [f"_w{i}" for i in range(words)]
    split = rows.select(*keys, F.split(F.trim(F.regexp_replace(whole_text(text_col), r"\s+", " ")), " ").alias("_s"))
    own = (lambda w: F.lit(1)) if weight is None else (lambda w: F.least(F.greatest(weight(w), F.lit(0)), F.lit(max_weight)))
    base = split.select(*keys, F.transform("_s", lambda w: F.when(w != "", F.xxhash64(w))).alias("_w0"),
                        *([] if weight is None else [F.transform("_s", lambda w: own(w).cast("long")).alias("_own")]))
    zipped = base.select(*keys, F.arrays_zip("_w0", *[
        F.slice("_w0", i + 1, F.size("_w0")).alias(c) for i, c in enumerate(cols) if i], *([] if weight is None else ["_own"])).alias("_z"))
    terms = zipped.select(*keys, F.posexplode("_z").alias("_pos", "_term"))
    parts = [F.col(f"_term.{c}") for c in cols]
    vote = F.when(parts[0].isNull(), F.lit(0)).otherwise(F.lit(1) if weight is None else F.col("_term._own")).cast("long")
    run = F.call_function("div", F.col("_pos"), F.lit(127 // max_weight))
    hashed = terms.select(*keys, run.alias("_run"), F.xxhash64(*parts).alias("_a"),
                          F.xxhash64(F.lit(77), *parts).alias("_b"), vote.alias("_v"))
    bytes_of_ones = F.lit(0x0101010101010101)
    first = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(bytes_of_ones) * F.col("_v")).alias(f"{h}{i}")
             for h in ("_a", "_b") for i in range(8)]
    runs = hashed.groupBy(*keys, "_run").agg(F.sum("_v").alias("_all"), *first)
    pair = F.lit((0xFF << 32) + 0xFF)  # bits n and n + 32: byte j and byte j + 4 of the sum over n's shift
    second = [F.sum(F.shiftrightunsigned(f"{h}{i}", 8 * j).bitwiseAND(pair)).alias(f"{h}_{i + 8 * j}")
              for h in ("_a", "_b") for i in range(8) for j in range(4)]
    votes = runs.groupBy(*keys).agg(F.sum("_all").alias("_all"), *second)

    def word(h: str, shift: int) -> Column:
        bits = [F.when(F.shiftrightunsigned(f"{h}_{n}", shift).bitwiseAND(F.lit((1 << _HALF) - 1)) * 2 > F.col("_all"),
                       F.lit(1 << n)).otherwise(F.lit(0)) for n in range(_HALF)]
        total = bits[0]
        for b in bits[1:]:
            total = total.bitwiseOR(b)
        return F.lpad(F.lower(F.hex(total)), 8, "0")
    return votes.select(*keys, F.concat(word("_a", _HALF), word("_a", 0), word("_b", _HALF), word("_b", 0)).alias("fingerprint"))


def _longs(fp: Column) -> tuple[Column, Column]:
    """The upper and lower 64 bits."""
    return tuple(F.conv(F.substring(fp, 1 + 16 * i, 16), 16, -10).cast("long") for i in range(2))


def _differing(high: Column, low: Column) -> Column:
    return F.bit_count(high) + F.bit_count(low)


def distance(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return _differing(*[x.bitwiseXOR(y) for x, y in zip(_longs(a), _longs(b))])


def likeness(a: Column, b: Column) -> Column:
    return (F.lit(1.0) - distance(a, b) / F.lit(float(BITS))).cast("double")


def _block_masks(blocks: int) -> list[tuple[int, int]]:
    """Of every block its bits in the upper and the lower long, as signed numbers."""
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    whole = [(1 << BITS - lo) - (1 << BITS - hi) for lo, hi in zip(bounds, bounds[1:])]
    return [(m >> 64, m & ((1 << 64) - 1)) for m in whole]


def _signed(n: int) -> Column:
    return F.lit(n - (1 << 64) if n >> 63 else n).cast("long")


def near_fingerprints(queries: DataFrame, fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                      col: str = "fingerprint", salts: int = SALTS) -> DataFrame:
    """``query, near, n_rows, distance``: for every distinct fingerprint of ``queries`` all
    distinct fingerprints of ``fps`` within ``radius`` bits, an equal one included, with the
    number of their rows in ``fps``.

    ``blocks`` over ``radius`` give one permuted table per choice of ``blocks - radius``
    agreeing blocks; more blocks make keys longer and buckets smaller. A pair counts
    in the first table in which it agrees, so it comes once. Every bucket is dealt
    over ``salts`` parts, to each of which its queries are sent, so that a bucket
    with a large share of all fingerprints is split; no two rows are paired
    unless one is a query. Nulls are left out; an empty side gives no rows.
    """
    chosen = list(combinations(range(blocks), blocks - radius))
    if not 0 <= radius < blocks <= 32 or len(chosen) > 1 << _TABLE_BITS:
        raise ValueError("blocks must be over the radius, at most 32, with at most 65,536 tables")
    masks = _block_masks(blocks)

    def classes(df: DataFrame) -> DataFrame:
        high, low = _longs(F.col("_f"))
        return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_f")).agg(F.count(F.lit(1)).alias("n_rows"))
                .select(high.alias("_h"), low.alias("_l"), "n_rows"))

    def key(t: int, salt: Column) -> Column:
        high, low = (sum(masks[i][side] for i in chosen[t]) for side in (0, 1))
        hashed = F.xxhash64(F.lit(t), salt, F.col("_h").bitwiseAND(_signed(high)), F.col("_l").bitwiseAND(_signed(low)))
        return hashed.bitwiseAND(F.lit(-1 << _TABLE_BITS)).bitwiseOR(F.lit(t).cast("long"))

    def keyed(df: DataFrame) -> DataFrame:
        keys = F.explode(F.array(*[key(t, F.col("_salt")) for t in range(len(chosen))])).alias("_key")
        return df.select(*[c for c in df.columns if c != "_salt"], keys)

    asked = classes(queries).drop("n_rows").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    every = classes(fps).withColumn(
        "_salt", F.pmod(F.xxhash64(F.lit(5), "_h", "_l"), F.lit(salts)).cast("int"))
    # merged, never broadcast: the queries' keys grow with the data
    pairs = keyed(asked).withColumnsRenamed({"_h": "_qh", "_l": "_ql"}).join(keyed(every).hint("merge"), "_key")
    high, low = F.col("_qh").bitwiseXOR(F.col("_h")), F.col("_ql").bitwiseXOR(F.col("_l"))
    near = pairs.select("*", _differing(high, low).alias("distance")).where(F.col("distance") <= radius)
    # a table's blocks agree, and no other one before the last of them does
    agree = sum((F.when(high.bitwiseAND(_signed(h)).bitwiseOR(low.bitwiseAND(_signed(m))) == 0, F.lit(1 << i)).otherwise(F.lit(0))
                 for i, (h, m) in enumerate(masks)), F.lit(0))
    table = F.col("_key").bitwiseAND(F.lit((1 << _TABLE_BITS) - 1)).cast("int") + 1
    upto = F.element_at(F.array(*[F.lit((1 << c[-1] + 1) - 1) for c in chosen]), table)
    own = F.element_at(F.array(*[F.lit(sum(1 << i for i in c)) for c in chosen]), table)

    def text(h: str, m: str) -> Column:
        return F.concat(*[F.lpad(F.lower(F.hex(c)), 16, "0") for c in (h, m)])
    return near.where(agree.bitwiseAND(upto) == own).select(
        text("_qh", "_ql").alias("query"), text("_h", "_l").alias("near"), "n_rows", "distance")


def count_near(fps: DataFrame, asked: Column, radius: int = RADIUS, blocks: int = BLOCKS, col: str = "fingerprint",
               name: str = "n_near") -> DataFrame:
    """``fps`` with ``name`` (long): for the rows ``asked`` selects, how many other rows of
    ``fps`` have a fingerprint within ``radius`` bits; null for the others and where
    there is no fingerprint. Rows are kept as they are, repeated ones each; an
    empty table gives no rows. The table is materialised, as it is read several times.
    """
    fps = cut(fps)
    asked = F.coalesce(asked, F.lit(False))
    found = near_fingerprints(fps.where(asked), fps, radius, blocks, col)
    counts = found.groupBy(F.col("query").alias(col)).agg((F.sum("n_rows") - 1).alias(name))
    # only the rows asked about are joined, so a fingerprint of very many rows stays where it is
    return (fps.where(asked).join(counts, col, "left").select(*fps.columns, name)
            .unionByName(fps.where(~asked).withColumn(name, F.lit(None).cast("long"))))


# ---- the order of documents ----------------------------------------------------------

_KEY = "array<struct<n:int,v:bigint,h:bigint>>"


def _order_key(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """Ascending in descending id: whether it is null, its complement, the hash of the text.
    Ids that are no whole numbers go by their hash."""
    whole = docs.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    number = F.col(id_col).cast("long") if whole else F.xxhash64(id_col)
    null = F.col(id_col).isNull()
    return (null.cast("int").alias("n"), F.when(null, F.lit(0)).otherwise(F.bitwise_not(number)).cast("long").alias("v"),
            F.xxhash64(whole_text(text_col)).alias("h"))


def _bounds(docs: DataFrame, key: tuple[Column, ...], n: int, least: tuple) -> list[tuple]:
    """Keys at which buckets of about ``BUCKET`` of the ``n`` rows begin, the first left out.

    Taken at every ``_PER_BUCKET``-th key of a sample of rows, at most
    ``MAX_BUCKETS * _PER_BUCKET`` keys; it only says how rows are dealt.
    """
    buckets = min(MAX_BUCKETS, -(-n // BUCKET))
    if buckets < 2:
        return []
    share = min(1.0, buckets * _PER_BUCKET / n)
    every = max(1, int(n * share) // buckets)
    rank = F.row_number().over(Window.orderBy("n", "v", "h"))
    picked = docs.sample(share, seed=1).select(*key).withColumn("_r", rank).where(F.col("_r") % every == 0)
    return sorted({k for k in map(tuple, picked.select("n", "v", "h").collect()) if k > least})


def _bucket(bounds: list[tuple], key: tuple[Column, ...]) -> Column:
    """How many of the sorted ``bounds`` are at or before the key, by binary search."""
    if not bounds:
        return F.lit(0)
    listed = F.from_json(F.lit(json.dumps([dict(zip("nvh", b)) for b in bounds])), _KEY)
    at = F.struct(*key)

    def halve(s: Column, _: Column) -> Column:
        lo, hi = s["lo"], s["hi"]
        mid = F.shiftright(lo + hi, 1)
        after = (lo < hi) & (F.get(listed, mid) <= at)
        return F.struct(F.when(after, mid + 1).otherwise(lo).alias("lo"), F.when(after | (lo >= hi), hi).otherwise(mid).alias("hi"))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length())), start, halve)["lo"]


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_bucket, _place, _guest, _id, _text, _next``: every text and that of the next row in
    descending id (null ids last, equal ids by text hash), the first after the last.

    Rows are dealt over buckets that begin at sampled keys of id and text hash, so
    bunched up ids, and null or repeated ids of many rows, make buckets of like
    size too; only rows equal in id and text share one. The order is made by one
    shuffle and a window per bucket; each bucket also gets the first row of the
    next one as its last (``_guest``), to close the gap. Ids that are no whole numbers
    are ordered by their hash. Null text counts as empty; an empty table gives no rows.
    """
    key = _order_key(docs, id_col, text_col)
    n, least = docs.select(F.struct(*key).alias("k")).agg(F.count(F.lit(1)), F.min("k")).first()
    least = tuple(least) if least is not None else (0, 0, 0)
    bounds = _bounds(docs, key, n, least)
    rows = docs.select(*key, F.col(id_col).alias("_id"), whole_text(text_col).alias("_text")).select(
        _bucket(bounds, (F.col("n"), F.col("v"), F.col("h"))).alias("_bucket"), "n", "v", "h", "_id", "_text", F.lit(False).alias("_guest"))
    # a bucket's first row has the key at which it begins
    heads = docs.sparkSession.createDataFrame(
        [(*k, i) for i, k in enumerate([*bounds, least])], "n int, v long, h long, _bucket int")
    kind = docs.schema[id_col].dataType.simpleString()
    guests = (docs.select(*key, whole_text(text_col).alias("_text")).join(F.broadcast(heads), ["n", "v", "h"])
              .groupBy("_bucket").agg(F.min("_text").alias("_text")).select(
        "_bucket", F.lit(0).alias("n"), F.lit(0).cast("long").alias("v"), F.lit(0).cast("long").alias("h"),
        F.lit(None).cast(kind).alias("_id"), "_text", F.lit(True).alias("_guest")))
    w = Window.partitionBy("_bucket").orderBy("_guest", "n", "v", "h")
    return rows.unionByName(guests).select("_bucket", F.row_number().over(w).alias("_place"), "_guest", "_id", "_text",
                                           F.lead("_text").over(w).alias("_next"))


def replace_tail(text: Column, other: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(F.coalesce(other, F.lit("")), half))


def edit_comparison(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's text against an edited text, its tail replaced by the start of the
    next row's text: ``id_col, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    Likeness is 1 less the share of bits that differ. Null text counts as empty;
    null ids come last; a single row is its own next; repeated rows are compared
    each; other columns are ignored, whatever their names; an empty table gives
    no rows. Ids keep their type (see ``with_next_text`` for their order). One shuffle of the texts serves the order, the edit and
    the votes.
    """
    rows = with_next_text(docs, id_col, text_col)
    edited = replace_tail(F.col("_text"), F.col("_next"))
    both = rows.withColumn("_edited", F.when(~F.col("_guest"), edited)).select(
        "_bucket", "_place", "_guest", "_id", F.char_length("_text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        F.posexplode(F.when(F.col("_guest"), F.array("_text")).otherwise(F.array("_text", "_edited"))).alias("_kind", "_t"))
    keys = ["_bucket", "_place", "_kind", "_guest", "_id", "n_chars", "edited_sha256"]
    fps = fingerprints(both, keys, "_t")
    # per place: the text's fingerprint, then the edited text's, then the next place's
    w = Window.partitionBy("_bucket").orderBy("_place", "_kind")
    ahead = fps.withColumn("_e", F.lead("fingerprint", 1).over(w)).withColumn("_n", F.lead("fingerprint", 2).over(w))
    return ahead.where((F.col("_kind") == 0) & ~F.col("_guest")).select(
        F.col("_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", F.col("_e").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("_e")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_n")).alias("near_next"))
