"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

Every text is tokenised in Arrow batches; only pieces (ids and lengths) travel
from there on. Pieces are dealt over groups of a bounded number of tokens and
each group is packed best-fit decreasing. Dual feasible functions give each
group a lower bound on its number of sequences: a group that meets its bound is
certified, and only its emptiest sequence, the one the bound rounds up, goes on.
Groups with a gap hand the pieces of further sequences, their emptiest, over to
the exchange. There the pieces are dealt anew over fewer groups and packed
again; this repeats until one group is left, so the gaps of many groups end up in
at most one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_texts, whole_text

#: Entries of the per-process word cache (about 150 bytes each).
CACHE_ENTRIES = 600_000
#: Pieces dealt to one packing group: bounds the memory of its task.
GROUP_PIECES = 20_000

#: Words told to the library as one text.
_JOINED = 2000

_LOADED: dict = {}
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")


class WordIds:
    """Ids of a text, as ``tokenizers`` gives them, by way of a cache of its words.

    The tokenizer drops white space and never merges across it, so the ids of a
    text are those of its parts between spaces and line ends, one after another.
    A Latin word followed by punctuation is looked up as the lower-cased word
    and the punctuation, which the tokenizer also separates.
    """

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {"": b""}

    def _library(self, parts: list[str]) -> None:
        for part, e in zip(parts, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)):
            self.cache[part] = np.asarray(e.ids, "<u4").tobytes()

    def _library_words(self, words: list[str]) -> None:
        """Plain words and plain punctuation, many to a call: as one text, told apart by where their tokens begin."""
        for at in range(0, len(words), _JOINED):
            some = words[at:at + _JOINED]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.asarray([a for a, _ in e.offsets], np.int64)
            cuts = (4 * np.searchsorted(begins, np.cumsum([0] + [len(w) + 1 for w in some]))).tolist()
            ids = np.asarray(e.ids, "<u4").tobytes()
            self.cache.update(zip(some, [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]))

    def _learn(self, missing: set[str]) -> None:
        cache = self.cache
        pairs, needed, other = [], set(), []
        for part in missing:
            m = _SIMPLE.fullmatch(part)
            if m:
                word, tail = m[1].lower(), m[2]
                pairs.append((part, word, tail))
                needed.add(word)
                needed.add(tail)
            else:
                other.append(part)
        self._library_words([x for x in needed if x not in cache])
        self._library(other)
        for part, word, tail in pairs:
            cache[part] = cache[word] + cache[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        cache, out = self.cache, []
        for text in texts:
            parts = text.replace("\n", " ").split(" ")
            found = list(map(cache.get, parts))
            if None in found:
                new = [i for i, x in enumerate(found) if x is None]
                if len(cache) > CACHE_ENTRIES:
                    cache.clear()
                    cache[""] = b""
                self._learn({parts[i] for i in new})
                for i in new:
                    found[i] = cache[parts[i]]
            out.append(b"".join(found))
        return out


def word_ids(path: str) -> WordIds:
    """One encoder for each process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and the ids, little-endian
    unsigned 32-bit, with ``with_ids``): every document's ids and ``end_id``,
    cut into pieces of at most ``capacity`` ids.

    Null and empty texts are ``end_id`` alone; very long texts are tokenised whole and
    cut; repeated rows and ids (null too) are cut each, in the order of their rows; an
    empty table gives no rows; other columns are ignored."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, step = word_ids(path), np.asarray([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            doc, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                data = enc.encode([text.as_py()])[0] + end
                for k, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    doc.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            cols = [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.binary())] if with_ids else []),
                                             names + (["ids"] if with_ids else []))

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return map_texts(docs.select(F.col(id_col), whole_text(text_col).alias("_text")), run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece. Longest first, each into the fullest open bin it fits."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a bin with r places left is open
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room, made = made, capacity, made + 1
        bins[i], offsets[i] = b, capacity - room
        room -= need
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The least number of bins that dual feasible functions prove: the identity,
    the threshold functions that drop pieces up to e and count those over
    capacity - e as whole bins, and the rounding functions u^(k)."""
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    for e in {*sizes[sizes <= capacity // 2].tolist(), capacity // 2} - {0}:
        big, kept = sizes > capacity - e, (sizes >= e) & (sizes <= capacity - e)
        best = max(best, int(counts[big].sum()) + -(-int((sizes[kept] * counts[kept]).sum()) // capacity))
    for k in range(2, 21):  # u^(k)(x) = x if (k + 1) x is whole, else floor((k + 1) x) / k, in units of 1 / (k capacity)
        whole = (k + 1) * sizes % capacity == 0
        value = np.where(whole, sizes * k, (k + 1) * sizes // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


_PACKED = "_key long, length long, _group long, _bin long, _offset long, _given boolean"


def _pack_group(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        gap = len(fill) - lower_bound(lengths, capacity)
        # what a group hands over: its emptiest sequence, whose room the bound's rounding
        # hides, and with a gap those too many and as many again to refill
        given = np.zeros(len(fill), bool)
        given[np.argsort(fill, kind="stable")[:2 * gap + 1]] = True
        given &= fill < capacity
        return pd.DataFrame({"_key": rows["_key"], "length": lengths, "_group": rows["_group"], "_bin": bins,
                             "_offset": offsets, "_given": given[bins]})
    return run


def best_fit_pack(parts: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES,
                  rounds: int | None = None) -> DataFrame:
    """``parts`` with ``sequence_id long`` and ``offset long``: places in sequences of
    ``capacity``, gapless from 0, no sequence over ``capacity``.

    ``parts`` needs ``length`` (1 to ``capacity``; a null or smaller length takes no
    place and gets a null sequence, a larger one fails). Equal lengths are
    interchangeable. Pieces are exchanged until one group is left, fewer than two have
    a gap, or an exchange no longer lessens what is handed over (or ``rounds`` are over). An empty table gives no rows. Columns of ``parts`` named
    sequence_id or offset are replaced; names starting with ``_`` are reserved.
    """
    parts = cut(parts.drop("sequence_id", "offset").withColumn("_key", F.monotonically_increasing_id()))
    sized = parts.select("_key", F.col("length").cast("long").alias("length"))
    total, most = sized.where("length between 1 and %d" % (capacity - 1)).agg(
        F.count(F.lit(1)), F.max("length")).first()
    if sized.where(F.col("length") > capacity).limit(1).count():
        raise ValueError(f"a piece is longer than {capacity}; cut it first")
    full = sized.where(F.col("length") == capacity).select(
        "_key", (-F.col("_key") - 1).alias("_sequence"), F.lit(0).cast("long").alias("_offset"))
    done, todo, left, numbered, last, r = [full], sized.where(f"length between 1 and {capacity - 1}"), total, 0, False, 0
    while not last:
        groups = max(1, -(-left // group_pieces))
        dealt = todo.withColumn("_group", F.pmod(F.xxhash64("_key", F.lit(r)), F.lit(groups)))
        packed = cut(dealt.groupBy("_group").applyInPandas(_pack_group(capacity), _PACKED))
        # an exchange needs a second group to exchange with
        ex = packed.where("_given")
        stats = ex.agg(F.count(F.lit(1)), F.count_distinct("_group")).first()
        last = groups == 1 or stats[1] < 2 or (r > 0 and stats[0] >= left) or r + 1 == rounds
        stay = packed if last else packed.where("NOT _given")
        done.append(stay.select("_key", ((F.col("_group") + numbered) * F.lit(1 << 26) + F.col("_bin")).alias("_sequence"), "_offset"))
        todo, left, numbered, r = ex.select("_key", "length"), stats[0], numbered + groups, r + 1
    places = done[0]
    for d in done[1:]:
        places = places.unionByName(d)
    return parts.join(places, "_key", "left").withColumnsRenamed(
        {"_sequence": "sequence_id", "_offset": "offset"}).drop("_key")
