"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text_col: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text_col), F.lit(""))


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and cut the lineage.

    Spark deletes the files once the data is no longer referenced when
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of an Arrow batch that holds texts: bounds what a Python worker and the
#: buffers before it hold at once.
TEXT_ROWS = 1000


def map_texts(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over rows with whole texts, in batches of at most ``TEXT_ROWS`` rows.

    Spark takes the size of batches from the session when the result is computed, so
    a larger setting of the session is lowered for good."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= TEXT_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return df.mapInArrow(fn, schema)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the n + 1 offsets of its values (nulls are empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    a = texts.fill_null("").cast(pa.large_string())
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges of about ``most`` bytes each, so the arrays
    derived from a range stay in cache; a longer document is a range of its own."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


# ---- a fixed-size filter ---------------------------------------------------

#: Bits of a bitmap filter (2 MB): a fixed size, whatever the input.
FILTER_BITS = 1 << 24
_SLICE = 1 << 15  # bits of one bitmap row


def maybe_in(rows: DataFrame, hashed: Column, keys: DataFrame, key_hash: Column, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` with ``_maybe``: false only where ``hashed`` is none of the hashes in ``keys``.

    The keys' hashes become a bitmap of ``bits`` bits, so what is broadcast has a
    fixed size; more keys only let more other rows through.
    """
    bitmap = (keys.select(F.pmod(key_hash, F.lit(bits)).alias("_slot"))
              .groupBy(F.floor(F.col("_slot") / _SLICE).alias("_slice"))
              .agg(F.bitmap_construct_agg(F.col("_slot") % _SLICE).alias("_bits")))
    probe = (rows.withColumn("_slot", F.pmod(hashed, F.lit(bits)))
             .withColumn("_slice", F.floor(F.col("_slot") / _SLICE)).join(F.broadcast(bitmap), "_slice", "left"))
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_slot") % _SLICE / 8).cast("int") + 1, F.lit(1))), 16, 10)
    hit = F.expr("shiftright(_byte, cast(_slot % 8 AS int)) & 1 = 1")
    return (probe.withColumn("_byte", byte.cast("int")).withColumn("_maybe", F.coalesce(hit, F.lit(False)))
            .drop("_slot", "_slice", "_bits", "_byte"))


# ---- word hashes ---------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_OTHER = np.ones(256, bool)  # what is no letter; bytes of other scripts count as letters
_OTHER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_NO_TERM = _OTHER.copy()  # as before, but digits count too
_NO_TERM[48:58] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GOLDEN = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(11).integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(4096, _GOLDEN, np.uint64), dtype=np.uint64)


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(buf: np.ndarray, off: np.ndarray, letters: bool = False, digits: bool = False,
                prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """64-bit hashes of the words of every document, in order, and the words per document.

    A word is a run of bytes other than 0x20 and 0x09-0x0D, or with ``letters`` a
    run of letters, with ``digits`` of letters and digits; A-Z count as a-z. For each length in ``prefixes`` a further
    array follows: the hash of every word's first bytes.
    """
    n = len(off) - 1
    if not len(buf):
        return (np.zeros(0, np.uint64), np.zeros(n, np.int64), *[np.zeros(0, np.uint64) for _ in prefixes])
    word = ~(_NO_TERM if digits else _OTHER if letters else _SPACE)[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cuts = off[:-1][off[:-1] < len(buf)]
    first[cuts] = word[cuts]
    starts = np.flatnonzero(first)
    idx = np.flatnonzero(word)
    if not len(idx):
        return (np.zeros(0, np.uint64), np.zeros(n, np.int64), *[np.zeros(0, np.uint64) for _ in prefixes])
    heads = np.flatnonzero(first[idx])
    lengths = np.diff(np.append(heads, len(idx)))
    place = np.arange(len(idx)) - np.repeat(heads, lengths)
    value = _BYTE[_LOWER[buf[idx]]]
    value *= _POWER[place & 4095]
    if len(idx) and int(lengths.max()) > 4096:
        value += place.astype(np.uint64) >> np.uint64(12)
    h = mix64(np.add.reduceat(value, heads))
    at = np.searchsorted(starts, off)
    return (h, np.diff(at), *[mix64(np.add.reduceat(np.where(place < k, value, np.uint64(0)), heads) + np.uint64(k))
                              for k in prefixes])


# ---- sums of fixed-size vectors over all partitions -----------------------

#: Partitions whose vectors are added together first.
_FAN_IN = 64


def vector_sum(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
               length: int, chunk: int = 8192, dtype=np.float64) -> np.ndarray:
    """Sum over all partitions of ``fn(batches)``, a vector of ``length`` numbers of ``dtype``.

    Each partition sends its vector as chunks. Chunks are added in two levels: those
    of ``_FAN_IN`` partitions first, then the sums; both read their chunks as a
    sorted stream and hold one of them. Only the one summed vector (a size fixed
    by ``length``) reaches the driver.
    """
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.asarray(fn(batches), dtype)
        if v.any():
            ks = [k for k in range(0, length, chunk) if v[k:k + chunk].any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() // _FAN_IN] * len(ks), pa.int32()), pa.array([k // chunk for k in ks], pa.int32()),
                 pa.array([v[k:k + chunk].tobytes() for k in ks], pa.binary())], ["g", "k", "v"])

    out = np.zeros(length, dtype)
    once = add_chunks(df.mapInArrow(part, "g int, k int, v binary"), dtype)
    for r in add_chunks(once.withColumn("g", F.lit(0)), dtype).collect():
        out[r.k * chunk:r.k * chunk + chunk] = np.frombuffer(r.v, dtype)
    return out


def add_chunks(rows: DataFrame, dtype=np.float64) -> DataFrame:
    """``(g, k, v)`` with one row per ``(g, k)``, its vectors ``v`` (bytes) added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            done = []
            for g, k, v in zip(*(c.to_pylist() for c in batch.columns)):
                if (g, k) != key:
                    if key is not None:
                        done.append((*key, total.tobytes()))
                    key, total = (g, k), np.frombuffer(v, dtype).copy()
                else:
                    total += np.frombuffer(v, dtype)
            if done:
                yield _chunk_rows(done)
        if key is not None:
            yield _chunk_rows([(*key, total.tobytes())])
    return rows.repartition("g", "k").sortWithinPartitions("g", "k").mapInArrow(run, "g int, k int, v binary")


def _chunk_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    g, k, v = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(k, pa.int32()), pa.array(v, pa.binary())], ["g", "k", "v"])


# ---- connected components --------------------------------------------------

class Forest:
    """Union-find over 0..n-1 for the rows of one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a < b:
            self.up[b] = a
        else:
            self.up[a] = b
        return True

    def roots(self) -> np.ndarray:
        return np.fromiter((self.find(i) for i in range(len(self.up))), np.int64, len(self.up))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of ``edges (a, b)`` by alternating star contraction.

    Returns ``(node, comp)`` with ``comp`` the smallest node of the component,
    for every node of an edge. Each round is two shuffles with map-side
    combined minima; stars of any size are split by the aggregation, and the
    number of rounds grows with the logarithm of the longest path.
    """
    cur = cut(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct())
    for _ in range(rounds):
        # large star: every neighbour above u points to the least of u's neighbourhood
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: every neighbour below u, and u, point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        nxt = cut(small.where("u <> v").distinct())
        done = _same(cur, nxt)
        cur = nxt
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Equal edge sets, told by count and two order-free hash sums."""
    def sign(df: DataFrame):
        h = F.xxhash64("u", "v")
        return df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum((h.bitwiseAND(F.lit(0xFFFFFFFF))).cast("long"))).first()
    return tuple(sign(a)) == tuple(sign(b))
