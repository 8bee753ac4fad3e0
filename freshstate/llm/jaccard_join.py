"""N-gram Jaccard join by signature trees.

A document's set holds its distinct five-word shingles. Two documents link when
the Jaccard similarity of their sets reaches the threshold; the result is the
connected components of the links. Nothing is sampled or capped: every stage
keeps a superset of the links, and the last one checks full sets.

1. Equal sets become one class, which one document represents.
2. Two sets that link share a shingle among the first n - ceil(t n) + 1 of each,
   in any fixed order. Shingles found often come last in that order, so these
   prefixes hold few common shingles. Documents that share a prefix shingle
   form a group.
3. In a group, a signature tree is built: each node has the OR of its documents'
   token bitmaps, the range of their set sizes and their largest excess (tokens
   beyond the set bits). Traversing the tree against itself, a pair of nodes is
   dropped when its largest possible overlap is below what the threshold needs.
   What is left joins documents into blocks, a superset of the components.
4. Within a block, full sets are joined by the same traversal, which skips pairs
   of nodes that are known to be in one component, and pairs of documents are
   verified. A block is cut into units of a bounded size; after the units, one
   representative of each of their components is joined across units, and then
   whatever is not in the block's largest component against the whole block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (Forest, components, cut, maybe_in, mix64, map_texts, slices, tasks, text_buffer,
                     whole_text, word_hashes)

SHINGLE = 5
THRESHOLD = 75  # per cent
#: Shingles known as common, at most; they only shape the order of the prefixes.
COMMON = 1 << 16
_LOCAL = 1 << 21      # shingles counted together in a task
_LOCAL_LEAST = 4
#: Ids of one group handled together; a larger group is handed to the exact join whole.
GROUP = 4096
#: Tokens of one unit of the exact join (8 bytes each).
UNIT_TOKENS = 4_000_000
_LEAF, _FAN = 8, 8


# ---- sets -------------------------------------------------------------------

def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text. With fewer than
    ``width`` words the whole sequence is one shingle; without words, none."""
    buf, off = text_buffer(texts)
    step = np.uint64(0x9E3779B97F4A7C15)
    for a, b in slices(off):
        h, count = word_hashes(buf[off[a]:off[b]], off[a:b + 1] - off[a])
        run = np.zeros(max(0, len(h) - width + 1), np.uint64)
        for k in range(width):
            run = run * step + h[k:len(h) - width + 1 + k]
        run = mix64(run)
        at = 0
        for n in count.tolist():
            if n >= width:
                yield np.unique(run[at:at + n - width + 1])
            elif n:
                one = np.full(1, n, np.uint64)
                for k in range(n):
                    one = one * step + h[at + k]
                yield mix64(one)
            else:
                yield np.zeros(0, np.uint64)
            at += n


def needed(n, m, threshold: int):
    """The least intersection with which sets of n and m tokens link."""
    return -(-threshold * (n + m) // (100 + threshold))


def _common_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that some task saw often, with a class by count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= _LOCAL_LEAST
            return pa.RecordBatch.from_arrays([pa.array(token[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["t", "n"])
        for batch in batches:
            for s in shingle_sets(batch.column(0), width):
                held.append(s)
                size += len(s)
                if size > _LOCAL:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    top = (map_texts(texts, run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "t").limit(COMMON).collect())
    token = np.array([r.t for r in top], np.int64).view(np.uint64)
    cls = np.array([r.n for r in top], np.int64)
    order = np.argsort(token)
    return token[order], np.log2(np.maximum(cls[order], 1)).astype(np.int64) + 1


def _bitmap(tokens: np.ndarray) -> bytes:
    """One bit for each token, in the power of two of bits from len(tokens) up (64 at least)."""
    bits = max(64, 1 << int(len(tokens) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _describe(width: int, threshold: int, common: np.ndarray, cls: np.ndarray):
    """Of every (id, text, text hashes): id, n, set key and the hashes, with prefix and
    bitmap at the first text with an id of a task that has this set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ns, k1, k2, prefix, sig = [], [], [], [], []
            for own, s in zip(batch.column(0).is_valid().to_pylist(), shingle_sets(batch.column(1), width)):
                n = len(s)
                with np.errstate(over="ignore"):
                    key = mix64(np.array([np.bitwise_xor.reduce(s) + np.uint64(n) if n else 0, mix64(s).sum() if n else 0], np.uint64))
                ns.append(n)
                k1.append(int(key[0].view(np.int64)))
                k2.append(int(key[1].view(np.int64)))
                if not n or not own or key.tobytes() in seen:
                    prefix.append(None)
                    sig.append(None)
                    continue
                seen.add(key.tobytes())
                head = n - -(-threshold * n // 100) + 1
                if len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    rank = np.where(common[at] == s, cls[at], 0)
                    s_order = np.argsort(rank, kind="stable")[:head]  # the hashes are sorted already
                    first = s[s_order]
                else:
                    first = s[:head]
                prefix.append(first.view(np.int64))
                sig.append(_bitmap(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), *batch.columns[2:],
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                ["doc", "n", "k1", "k2", "t1", "t2", "prefix", "sig"])
    return run


# ---- groups of documents that share a prefix shingle ---------------------------

def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (token, id): the ids of each token with two or more.
    ``whole`` is false for the first and last token of a partition, which may go
    on elsewhere, and for tokens of more than ``GROUP`` ids, given in parts."""
    seen: set[bytes] = set()
    out: list[tuple[int, bool, bytes]] = []
    token, held, size, first, cutoff = None, [], 0, True, False

    def close(end: bool) -> None:
        nonlocal held, size, cutoff, first
        whole = not (first or end or cutoff)
        if size >= (2 if whole else 1):
            ids = np.unique(np.concatenate(held)).tobytes()
            if not whole or ids not in seen:
                if whole and len(seen) < 1_000_000:
                    seen.add(ids)
                out.append((token, whole, ids))
        held, size, cutoff = [], 0, False
        first = False

    def batch_out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.bool_()),
                                           pa.array([o[2] for o in out], pa.binary())], ["token", "whole", "ids"])
        out.clear()
        return rows

    for batch in batches:
        t, ids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if not len(t):
            continue
        heads = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
        sizes = np.diff(np.append(heads, len(t)))
        # runs of one row in the middle of a batch belong to no group
        for k in np.flatnonzero((sizes > 1) | (heads == 0) | (heads + sizes == len(t))).tolist():
            lo, hi = int(heads[k]), int(heads[k] + sizes[k])
            if t[lo] != token:
                if token is not None:
                    close(False)
                elif lo:
                    first = False
                token = int(t[lo])
                if lo and lo != heads[0]:
                    first = False
            for at in range(lo, hi, GROUP):
                part = ids[at:min(hi, at + GROUP)]
                if size + len(part) > GROUP:
                    out.append((token, False, np.unique(np.concatenate(held)).tobytes()))
                    held, size, cutoff = [], 0, True
                held.append(part)
                size += len(part)
        if len(out) > 5000:
            yield batch_out()
    if token is not None:
        close(True)
    yield batch_out()


# ---- signature trees ---------------------------------------------------------------

def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


class SignatureTree:
    """Documents of one bitmap width in leaves of ``_LEAF``, nodes of ``_FAN``; a
    node holds the OR of the bitmaps, the size range, the largest excess and the
    component if all its documents share one (else -1)."""

    def __init__(self, rows: np.ndarray, bits: np.ndarray, size: np.ndarray, comp: np.ndarray):
        self.rows = rows
        excess = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, size, size, excess, comp)]
        fan = _LEAF
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, ex, co = self.levels[-1]
            at = np.arange(0, len(b), fan)
            low = np.minimum.reduceat(co, at)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.maximum.reduceat(ex, at), np.where(low == np.maximum.reduceat(co, at), low, -1)))
            fan = _FAN

    def folded(self, words: int) -> "SignatureTree":
        if self.levels[0][0].shape[1] == words:
            return self
        return SignatureTree(self.rows, _fold(self.levels[0][0], words), self.levels[0][1], self.levels[0][4])


def _children(level: int, node: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of the nodes and, for each, the place of its parent in ``node``."""
    fan = _LEAF if level == 1 else _FAN
    lo = node * fan
    n = np.minimum(lo + fan, count) - lo
    parent = np.repeat(np.arange(len(node)), n)
    return np.repeat(lo, n) + np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n), parent


def dual_traversal(x: SignatureTree, y: SignatureTree, threshold: int, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of document pairs (places in the rows of x and y) that may link and
    are not known to be in one component. With ``x is y`` each pair comes once."""
    same = x is y
    if same or x.levels[0][0].shape[1] == y.levels[0][0].shape[1]:
        fx, fy = x, y
    else:
        words = min(x.levels[0][0].shape[1], y.levels[0][0].shape[1])
        fx, fy = x.folded(words), y.folded(words)
    stack = [(len(fx.levels) - 1, len(fy.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        la, lb, a, b = stack.pop()
        ba, loa, hia, exa, ca = (v[a] for v in fx.levels[la])
        bb, lob, hib, exb, cb = (v[b] for v in fy.levels[lb])
        best = np.bitwise_count(ba & bb).sum(axis=1, dtype=np.int64) + np.minimum(exa, exb)
        best = np.minimum(best, np.minimum(hia, hib))
        keep = (best >= needed(loa, lob, threshold)) & (100 * hia >= threshold * lob) & (100 * hib >= threshold * loa)
        keep &= (ca != cb) | (ca < 0)
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if la == 0 and lb == 0:
            if same:
                a, b = a[a < b], b[a < b]
            if len(a):
                yield a, b
            continue
        if la >= lb and la:
            child, parent = _children(la, a, len(fx.levels[la - 1][0]))
            a, b, la = child, b[parent], la - 1
            if same and la < lb:  # both sides go down together, so that mirrored pairs are dropped
                child, parent = _children(lb, b, len(fy.levels[lb - 1][0]))
                a, b, lb = a[parent], child, lb - 1
                up = a <= b
                a, b = a[up], b[up]
        else:
            child, parent = _children(lb, b, len(fy.levels[lb - 1][0]))
            a, b, lb = a[parent], child, lb - 1
        for at in range(0, len(a), most):
            stack.append((la, lb, a[at:at + most], b[at:at + most]))


def link_rows(size: np.ndarray, sigs: list[bytes], comp: np.ndarray, threshold: int, check=None,
              side: np.ndarray | None = None) -> Forest:
    """Unites the rows that link. ``comp``: components known before (equal numbers
    are united). ``check(i, j)`` verifies a pair; without it a possible link
    counts. With ``side`` only pairs of a row with side 1 and any other are tried.

    First each row is tried against the first row of its stretch, so that dense
    groups are united after a few tests; then the trees are traversed, and pairs
    already united are left out.
    """
    m = len(size)
    forest = Forest(m)
    firsts: dict[int, int] = {}
    for i, c in enumerate(comp.tolist()):
        forest.union(firsts.setdefault(c, i), i)
    width = np.array([len(s) // 8 for s in sigs])
    by_width = {}
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        bits = np.frombuffer(b"".join(sigs[i] for i in rows.tolist()), np.uint64).reshape(len(rows), w)
        order = np.lexsort((*bits.T[:2], size[rows]))
        by_width[w] = (rows[order], bits[order])
    for rows, bits in by_width.values() if side is None else ():
        ex = size[rows] - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        left = np.arange(len(rows))
        for _ in range(4):
            if len(left) < 2:
                break
            p, others = left[len(left) // 2], np.delete(left, len(left) // 2)
            best = np.bitwise_count(bits[others] & bits[p]).sum(axis=1, dtype=np.int64) + np.minimum(ex[others], ex[p])
            hit = best >= needed(size[rows[others]], size[rows[p]], threshold)
            done = []
            for q in others[hit].tolist():
                i, j = int(rows[p]), int(rows[q])
                if forest.find(i) == forest.find(j) or check is None or check(i, j):
                    forest.union(i, j)
                    done.append(q)
            left = np.setdiff1d(others, done, assume_unique=True)
    known = forest.roots()
    # keep rows of one component together, so that whole nodes are skipped
    trees = {}
    for w, (rows, bits) in by_width.items():
        order = np.argsort(known[rows], kind="stable") if side is None else np.argsort(side[rows], kind="stable")
        rows, bits = rows[order], bits[order]
        if side is None:
            trees[w] = [SignatureTree(rows, bits, size[rows], known[rows])]
        else:
            k = int(np.searchsorted(side[rows], 1))
            trees[w] = [SignatureTree(rows[s], bits[s], size[rows[s]], known[rows[s]]) if len(rows[s]) else None
                        for s in (slice(0, k), slice(k, None))]

    def traverse(x, y):
        for a, b in dual_traversal(x, y, threshold):
            for i, j in zip(x.rows[a].tolist(), y.rows[b].tolist()):
                if forest.find(i) != forest.find(j) and (check is None or check(i, j)):
                    forest.union(i, j)

    # a set may link with one of up to 4/3 its size: the same bitmap width or the next
    # (with lower thresholds further ones)
    for w, mine in trees.items():
        for v, theirs in trees.items():
            if v < w or 100 * (w * 64) < threshold * (v * 64) / 2:
                continue
            if side is None:
                traverse(mine[0], theirs[0])
            else:
                pairs = [(mine[1], theirs[1]), (mine[1], theirs[0])] + ([(mine[0], theirs[1])] if v != w else [])
                for x, y in pairs:
                    if x is not None and y is not None:
                        traverse(x, y)
    return forest


def _stream(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pd.DataFrame]:
    """The rows of each key, from batches sorted by their first ``keys`` columns."""
    rest = None
    for batch in batches:
        df = batch.to_pandas()
        if rest is not None:
            df = pd.concat([rest, df], ignore_index=True)
        if not len(df):
            continue
        key = df.iloc[:, :keys]
        new = np.flatnonzero((key.to_numpy()[1:] != key.to_numpy()[:-1]).any(axis=1)) + 1
        bounds = [0, *new.tolist(), len(df)]
        for lo, hi in zip(bounds[:-2], bounds[1:-1]):
            yield df.iloc[lo:hi]
        rest = df.iloc[bounds[-2]:]
    if rest is not None and len(rest):
        yield rest


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])


def _possible_links(threshold: int):
    """Rows (gid, id, n, sig) sorted by gid -> star edges of what may link in each group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int]] = []
        for g in _stream(batches, 1):
            if len(g) < 2:
                continue
            ids = g["id"].to_numpy()
            roots = link_rows(g["n"].to_numpy().astype(np.int64), g["sig"].tolist(), np.arange(len(g)), threshold).roots()
            edges += [(int(ids[i]), int(ids[r])) for i, r in enumerate(roots.tolist()) if i != r]
            if len(edges) > 20_000:
                yield _edge_batch(edges)
                edges = []
        yield _edge_batch(edges)
    return run


def _exact_links(threshold: int, sided: bool):
    """Rows (block, unit, other, id, comp, side, tokens) sorted by the first three ->
    star edges of the components that exact links make in each unit, and with
    ``sided`` only between rows of side 1 and others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int]] = []
        for g in _stream(batches, 3):
            if len(g) < 2:
                continue
            g = g.sort_values(["side", "id"]).drop_duplicates("id", keep="last") if sided else g
            sets = [np.frombuffer(t, np.uint64) for t in g["tokens"]]
            size = np.array([len(s) for s in sets], np.int64)
            ids, comp = g["id"].to_numpy(), g["comp"].to_numpy()

            def check(i: int, j: int) -> bool:
                x, y = (sets[i], sets[j]) if size[i] <= size[j] else (sets[j], sets[i])
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                return 100 * both >= threshold * (len(x) + len(y) - both)
            forest = link_rows(size, [_bitmap(s) for s in sets], comp, threshold, check,
                               g["side"].to_numpy() if sided else None)
            edges += [(int(ids[i]), int(ids[r])) for i, r in enumerate(forest.roots().tolist()) if i != r]
            if len(edges) > 20_000:
                yield _edge_batch(edges)
                edges = []
        yield _edge_batch(edges)
    return run


# ---- the join ------------------------------------------------------------------------

_UNIT = ["block", "unit", "other"]


def _join_units(rows: DataFrame, threshold: int, sided: bool = False) -> DataFrame:
    cols = [*_UNIT, "id", "comp", "side", "tokens"]
    return (rows.select(*cols).repartition(tasks(rows.sparkSession), *_UNIT).sortWithinPartitions(*_UNIT)
            .mapInArrow(_exact_links(threshold, sided), "a long, b long"))


def _labels(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, comp``: the smallest id of each one's component (its own without edges)."""
    comp = components(edges)
    return ids.join(comp, ids["id"] == comp["node"], "left").select("id", F.coalesce("comp", "id").alias("comp"))


def _block_links(blocks: DataFrame, sets: DataFrame, threshold: int, unit_tokens: int) -> DataFrame:
    """Exact links (as edges that connect the same documents) within every block."""
    total = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("_docs"), F.sum("n").alias("_tokens"))
    units = F.greatest(F.ceil(F.col("_tokens") / unit_tokens), F.lit(1)).cast("int")
    total = cut(total.where("_docs > 1").select("block", units.alias("units")))
    placed = blocks.select("block", "id").join(total, "block").select(
        "block", "id", "units", F.pmod(F.xxhash64("id"), F.col("units")).cast("int").alias("unit"))
    full = cut(placed.join(sets, "id").select(
        "block", "units", "unit", F.lit(0).alias("other"), "id", F.col("id").alias("comp"), F.lit(0).alias("side"), "tokens"))
    links = cut(_join_units(full, threshold))
    large = full.where("units > 1")
    if not large.limit(1).count():
        return links
    # one representative of each component of a unit, across the units of its block
    ids = large.select("id", "block", "units")
    label = _labels(ids.select("id"), links)
    # (where these are many, in units again: this step only spares the next one work)
    pivots = large.join(label.where("id = comp").select("id"), "id", "left_semi")
    spread = pivots.groupBy("block").agg(F.ceil(F.sum(F.octet_length("tokens") / 8) / unit_tokens).cast("int").alias("_units"))
    pivots = pivots.join(spread, "block").withColumn("unit", F.pmod(F.xxhash64("id", F.lit(2)), F.col("_units")).cast("int"))
    links = links.unionByName(cut(_join_units(pivots, threshold)))
    # what is not in the block's largest component, against the whole block
    label = cut(_labels(ids.select("id"), links).join(ids, "id"))
    sizes = label.groupBy("block", "comp").agg(F.count(F.lit(1)).alias("_c"))
    largest = sizes.groupBy("block").agg(F.max_by("comp", "_c").alias("_largest"))
    rest = label.join(largest, "block").where("comp <> _largest").select("id")
    left = cut(large.drop("comp").join(label.select("id", "comp"), "id").join(
        rest.withColumn("_rest", F.lit(1)), "id", "left"))
    own = left.where("_rest = 1")
    if not own.limit(1).count():
        return links
    parts = own.groupBy("block").agg(F.ceil(F.sum(F.octet_length("tokens") / 8) / unit_tokens).cast("int").alias("_parts"))
    to_units = own.join(parts, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("units") - 1)).alias("unit"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.col("_parts")).cast("int").alias("other"), "id", "comp", F.lit(1).alias("side"), "tokens")
    all_rows = left.join(parts, "block").select(
        "block", "unit", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("other"),
        "id", "comp", F.lit(0).alias("side"), "tokens")
    return links.unionByName(_join_units(to_units.unionByName(all_rows), threshold, sided=True))


def _same_document(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Star edges between the classes of rows that share an id, for ids with several sets."""
    key = F.struct("k1", "k2")
    several = (usable.groupBy("doc").agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
               .where("_lo <> _hi").select("doc"))
    of = cut(usable.select("doc", "k1", "k2").join(several, "doc", "left_semi").distinct()
             .join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).select("doc", "rep"))
    return of.join(of.groupBy("doc").agg(F.min("rep").alias("a")), "doc").where("rep <> a").select("a", F.col("rep").alias("b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                       width: int = SHINGLE, unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row.

    Two rows link when 100 * intersection >= ``threshold`` * union of their sets.
    ``component_id`` is the smallest id reachable by links, itself included. A
    null, empty or wordless text has an empty set and links with nothing. A row
    with a null id links with nothing and has a null component. Rows that share
    an id and have words are in one component, with all their links. Ids may be of any
    type that has an order. An empty table gives no rows. Other columns are ignored.

    Within, every row has a number of its own, and one row's number stands for each
    class of equal sets; ids only name the components.
    """
    spark: SparkSession = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    common, cls = _common_shingles(rows.select("text"), width)
    facts = cut(map_texts(rows, _describe(width, threshold, common, cls),
                          f"doc {kind}, n int, k1 long, k2 long, t1 long, t2 long, prefix array<long>, sig binary")
                .withColumn("id", F.monotonically_increasing_id()))
    usable = facts.where("n > 0 AND doc IS NOT NULL")
    classes = cut(usable.groupBy("k1", "k2").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("_c"),
                                                 F.min(F.when(F.col("prefix").isNotNull(), F.col("id"))).alias("rep")))
    reps = usable.where("prefix IS NOT NULL").join(classes.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    posted = (reps.select(F.explode("prefix").alias("token"), "id")
              .repartitionByRange(tasks(spark), "token", "id").sortWithinPartitions("token", "id"))
    groups = cut(posted.mapInArrow(_groups, "token long, whole boolean, ids binary"))

    def ids_of(df: DataFrame, key: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                arrays = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
                if arrays:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(np.repeat(np.arange(len(arrays)), [len(x) for x in arrays]))),
                         pa.array(np.concatenate(arrays))], ["gid", "id"])
        return df.select(key, "ids").mapInArrow(run, "gid long, id long")

    small = ids_of(groups.where("whole").select("ids").distinct().withColumn("gid", F.xxhash64("ids")), "gid")
    members = small.join(reps.select("id", "n", "sig"), "id").select("gid", "id", "n", "sig")
    near = (members.repartition(tasks(spark), "gid").sortWithinPartitions("gid", "id")
            .mapInArrow(_possible_links(threshold), "a long, b long"))
    # groups in parts are handed on whole
    parts = ids_of(groups.where("NOT whole"), "token")
    star = parts.join(parts.groupBy("gid").agg(F.min("id").alias("a")), "gid").select("a", F.col("id").alias("b"))
    block = components(near.unionByName(star))
    sized = cut(block.join(reps.select("id", "n", "doc", "t1", "t2"), block["node"] == F.col("id"))
                .select(F.col("comp").alias("block"), "id", "n", F.xxhash64("doc", "t1", "t2").alias("source"), "t1", "t2"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([s.tobytes() for s in shingle_sets(batch.column(3), width)], pa.binary())], ["source", "t1", "t2", "tokens"])

    # the texts of representatives, found again by document and content
    source = F.xxhash64("doc", "t1", "t2")
    kept = maybe_in(rows, source, sized, F.col("source")).where("_maybe").select(source.alias("source"), "t1", "t2", "text")
    sets = (map_texts(kept, tokens, "source long, t1 long, t2 long, tokens binary").dropDuplicates(["source", "t1", "t2"])
            .join(sized.select("source", "t1", "t2", "id"), ["source", "t1", "t2"]).select("id", "tokens"))
    links = _block_links(sized.select("block", "id", "n"), sets, threshold, unit_tokens).unionByName(_same_document(usable, classes))
    label = components(links).withColumnsRenamed({"node": "rep", "comp": "label"})
    named = classes.join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    first = named.groupBy("label").agg(F.min("least").alias("component_id"))
    resolved = cut(named.join(first, "label").where("component_id <> least OR _c > 1").select("k1", "k2", "component_id"))
    return (facts.select("doc", "n", "k1", "k2").join(resolved, ["k1", "k2"], "left")
            .select(F.col("doc").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc").isNotNull(), F.coalesce("component_id", "doc"))
                    .otherwise(F.col("doc")).alias("component_id")))
