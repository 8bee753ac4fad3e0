"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a byte string exactly one token can end its encoding: the
one whose pairing with the last token of the shorter prefix BPE itself would
leave alone. Storing that token for each prefix gives the encoding of any
prefix by walking back, makes appending exact (old entries never change), and
lets an edit be re-encoded from its start until the table agrees with the old
one again.
"""

from __future__ import annotations

import base64
import bisect
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, whole_text

#: Entries of the per-process cache of encoded words (about 300 bytes each).
CACHE_ENTRIES = 400_000
_PAIRS = 1_000_000
_DOCS = 256  # documents of one output batch

#: The pattern whose letters and punctuation ``_Cached`` splits without it.
GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The Unicode white space of the tokenizer library.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LOADED: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class MergeTable:
    """Ranks, and for every token the pair it is merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.size_of = {i: len(t) for t, i in ranks.items()}
        self.parts = {i: (i, i) for i in self.bytes_of}
        self.merged: dict[tuple[int, int], int] = {}
        self.memo: dict[tuple[int, int], bool] = {}
        self.tokens: dict[bytes, int] = {}
        self.tails: set[bytes] = set()
        self.longest = 1
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                for k in range(1, len(token)):
                    a, b = ranks.get(token[:k], rank), ranks.get(token[k:], rank)
                    if a < rank and b < rank and self._neighbours(a, b):
                        self.parts[rank] = (a, b)
                        self.merged[a, b] = rank
                        break
                else:
                    continue  # no sequence of merges makes it
            self.tokens[token] = rank
            self.longest = max(self.longest, len(token))
            self.tails.update(token[k:] for k in range(len(token)))
        self.memo.clear()

    def neighbours(self, a: int, b: int) -> bool:
        """Whether BPE would leave token ``a`` followed by token ``b`` as they are."""
        known = self.memo.get((a, b))
        if known is None:
            if len(self.memo) > _PAIRS:
                self.memo.clear()
            known = self.memo[a, b] = self._neighbours(a, b)
        return known

    def _neighbours(self, a: int, b: int) -> bool:
        # Undo merges at the seam, the latest first. If a merge across the seam
        # was open before the merge just undone, BPE would have taken it.
        undone = 1 << 62
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < undone:
                return False
            inner, outer = self.parts[a][1], self.parts[b][0]
            if a > b and inner != a or outer == b and inner != a:
                undone, a = a, inner
            elif outer != b:
                undone, b = b + 1, outer
            else:
                return True


class PrefixTable:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, table: MergeTable, data: bytes = b""):
        self.table, self.data, self.last = table, b"", []
        self.append(data)

    def _extend(self, old: int, stop: int) -> None:
        """Appends the last tokens of the prefixes ``old + 1 .. stop``: for each, the
        token that ends there and may follow the last token of the prefix before it."""
        table, data, last = self.table, self.data, self.last
        get, tails, memo, ok = table.tokens.get, table.tails, table.memo, table.neighbours
        for end in range(old + 1, stop + 1):
            start = end - 1
            while True:
                tail = data[start:end]
                token = get(tail)
                if token is not None:
                    if not start:
                        break
                    pair = (last[start - 1], token)
                    if memo[pair] if pair in memo else ok(*pair):
                        break
                elif tail not in tails:
                    raise ValueError(f"no token ends at byte {end - 1}")
                start -= 1
            last.append(token)

    def append(self, data: bytes) -> None:
        """Extends the string; entries of the old prefixes stay as they are."""
        old = len(self.data)
        self.data += data
        self._extend(old, len(self.data))

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Replaces bytes ``start:stop``; returns how many prefixes were computed anew.

        After as many agreeing entries as the longest token has bytes, every
        later entry is the old one.
        """
        shift, before, size = start + len(data) - stop, self.last, len(self.data)
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = before[:start]
        agree = 0
        for end in range(start + 1, len(self.data) + 1):
            self._extend(end - 1, end)
            token = self.last[-1]
            was = end - 1 - shift
            agree = agree + 1 if stop <= was < size and before[was] == token else 0
            if agree >= self.table.longest:
                self.last.extend(before[was + 1:])
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        out, end, last, size = [], len(self.data), self.last, self.table.size_of
        while end:
            token = last[end - 1]
            out.append(token)
            end -= size[token]
        out.reverse()
        return out


def encode_piece(table: MergeTable, piece: bytes) -> list[int]:
    """Ids of one match of the splitting pattern."""
    whole = table.ranks.get(piece)
    return [whole] if whole is not None else PrefixTable(table, piece).ids()


def decode(table: MergeTable, ids) -> bytes:
    return b"".join(map(table.bytes_of.__getitem__, ids))


def splitter(pattern: str):
    """The pattern with the tokenizer library's white space spelled out."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{_WS}").replace(r"\s", f"[{_WS}]").replace(r"\S", f"[^{_WS}]"))


class TextEncoder:
    """A text with the ids of each match, kept exact under appends and edits."""

    REACH = 3  # a match depends on at most so many characters after its end

    def __init__(self, table: MergeTable, pattern: str, text: str = ""):
        self.table, self.split = table, splitter(pattern)
        self.text, self.starts, self.pieces = "", [], []
        self.replace(0, 0, text)

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, stop: int, text: str) -> int:
        """Replaces characters ``start:stop``; returns how many matches were encoded anew."""
        old_starts, old_pieces, shift = self.starts, self.pieces, start + len(text) - stop
        ends = old_starts[1:] + [len(self.text)]
        keep = bisect.bisect_right(ends, start - self.REACH) if old_starts else 0
        self.text = self.text[:start] + text + self.text[stop:]
        at = old_starts[keep] if keep < len(old_starts) else (0 if not old_starts else len(self.text) - len(text))
        where = {s + shift: i for i, s in enumerate(old_starts) if s >= stop}
        self.starts, self.pieces, made = old_starts[:keep], old_pieces[:keep], 0
        for m in self.split.finditer(self.text, at):
            i = where.get(m.start())
            if i is not None and m.start() >= start + len(text):
                self.starts += [s + shift for s in old_starts[i:]]
                self.pieces += old_pieces[i:]
                break
            self.starts.append(m.start())
            self.pieces.append(encode_piece(self.table, m.group().encode()))
            made += 1
        return made

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p]


class _Cached:
    """Whole texts by way of a cache of their words. A word takes one space
    before it, as the pattern does, and no match reaches past it."""

    #: Words that split into letters and punctuation, whatever follows.
    SIMPLE = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")

    def __init__(self, path: str, pattern: str):
        self.table, self.split, self.cache = MergeTable(read_ranks(path)), splitter(pattern), {"": b""}
        self.words = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
        self.plain = pattern == GPT_PATTERN

    def _piece(self, piece: str) -> bytes:
        known = self.cache.get(piece)
        if known is None:
            ids = encode_piece(self.table, piece.encode())
            known = self.cache[piece] = struct.pack(f"<{len(ids)}i", *ids)
        return known

    def _word(self, word: str) -> bytes:
        m = self.SIMPLE.fullmatch(word) if self.plain else None
        if m:
            return self._piece(m[1]) + self._piece(m[2])
        return b"".join([self._piece(p) for p in self.split.findall(word)])

    def encode(self, text: str) -> bytes:
        cache, words = self.cache, self.words.findall(text)
        try:
            return b"".join([cache[w] for w in words])
        except KeyError:
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
                cache[""] = b""
            for w in words:
                if w not in cache:
                    cache[w] = self._word(w)
            return b"".join([cache[w] for w in words])


def _cached(path: str, pattern: str) -> _Cached:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = _Cached(path, pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     with_decoded: bool = False) -> DataFrame:
    """``id_col, ids array<int>`` for every row, and with ``with_decoded`` also
    ``decoded binary``, the bytes decoded from those ids.

    Every match of ``pattern`` is encoded separately; no special tokens. Null
    text counts as empty and has no ids. Whole texts, however long; repeated
    rows are encoded each; null ids pass. An empty table gives no rows. Other
    columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _cached(path, pattern)
        bytes_of = enc.table.bytes_of.__getitem__
        for whole in batches:
            for at in range(0, whole.num_rows, _DOCS):
                batch = whole.slice(at, _DOCS)
                ids = [enc.encode(t) for t in batch.column(1).to_pylist()]
                off = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
                values = np.frombuffer(b"".join(ids), "<i4")
                cols = [batch.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(values, pa.int32()))]
                if with_decoded:
                    cols.append(pa.array([b"".join(map(bytes_of, values[a:b].tolist())) for a, b in zip(off[:-1], off[1:])], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["id", "ids"] + (["decoded"] if with_decoded else [])
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, ids array<int>" + (", decoded binary" if with_decoded else "")
    return (map_texts(docs.select(F.col(id_col), whole_text(text_col).alias("_text")), run, schema)
            .withColumnRenamed("id", id_col))


def decode_documents(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, decoded binary``: the bytes of each row's ids.

    Null or no ids decode to no bytes, an id outside the vocabulary (or null) fails;
    lists of any length are decoded whole; repeated rows are decoded each, null row ids
    pass; an empty table gives no rows; other columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = {i: t for t, i in read_ranks(path).items()}
        for batch in batches:
            out = [b"".join(map(vocabulary.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "decoded"])

    id_type = coded.schema[id_col].dataType.simpleString()
    return (coded.select(id_col, ids_col).mapInArrow(run, f"id {id_type}, decoded binary")
            .withColumnRenamed("id", id_col))
