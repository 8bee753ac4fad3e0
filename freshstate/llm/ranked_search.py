"""Ranked lexical search by per-term geometric blocking.

Every document is a vector of integer term contributions; a query's score is the
sum of its terms' weights times them. Vectors are sorted by a code of random
projections, so that similar ones meet, and cut into shards of bounded size.
Within a shard, each term's posting list is clustered by similarity: some of its
documents are pivots, the others join the pivot nearest in the projected space, and
the clusters are cut into blocks. A block's summary holds the largest contribution of
any of its documents for each term, so a query's weights times the summary are an
exact upper bound of every score in the block, in whole numbers: a block is
skipped only when that bound is below the score that the query's k-th best
document is known to reach. Documents of other blocks are scored exactly.

A first round over the index scores the documents that hold a query's rarest
terms: their k-th best score is where the thresholds of the second round start.
Lists are blocked when a query first needs them; a list whose terms, together with all
lighter ones of the query, cannot reach the threshold is not needed. Summaries
keep the coordinates that queries with the list's term can use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_texts, mix64, slices, tasks, text_buffer, vector_sum, whole_text, word_hashes

#: Documents and postings of one shard, at most (a document is never split).
SHARD_DOCS, SHARD_POSTINGS = 4096, 2_000_000
#: Documents of one block, at most; half of it on average.
BLOCK = 32
#: Queries and query terms handled by one pass over the index.
QUERIES, QUERY_TERMS = 8192, 1 << 20
#: Documents that hold the terms by which a query's first threshold is found, about.
SEEDS = 2000
PLANES = 16
# Fixed values of the score: 1000 tf / (1000 tf + 8 m), m = 10 + 90 n N / L, weights in thousandths.
_UNIT, _SATURATION, _FLAT, _SLOPE, _SCALE = 1000, 8, 10, 90, 1_000_000_000


# ---- documents as vectors --------------------------------------------------------

def document_terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each text: its number of terms, its distinct term hashes (sorted), and how often each occurs."""
    buf, off = text_buffer(texts)
    for a, b in slices(off):
        h, count = word_hashes(buf[off[a]:off[b]], off[a:b + 1] - off[a], digits=True)
        doc = np.repeat(np.arange(b - a), count)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        tf = np.diff(np.append(heads, len(h)))
        ends = np.searchsorted(doc[heads], np.arange(b - a + 1))
        for n, lo, hi in zip(count.tolist(), ends[:-1], ends[1:]):
            yield n, h[heads[lo:hi]], tf[lo:hi]


def contributions(tf: np.ndarray, n: int, docs: int, terms: int) -> np.ndarray:
    """What each of a document's terms adds to a score, before its weight."""
    m = _FLAT + (_SLOPE * int(n) * docs) // terms
    return (_SCALE * tf.astype(np.int64)) // (_UNIT * tf.astype(np.int64) + _SATURATION * m)


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.floor(_UNIT * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)


def signs(term_hashes: np.ndarray) -> np.ndarray:
    """A random direction of each term: ``PLANES`` numbers of 1 or -1."""
    bits = mix64(term_hashes.astype(np.uint64).copy())[:, None] >> np.arange(PLANES, dtype=np.uint64) & np.uint64(1)
    return bits.astype(np.float32) * 2 - 1


@dataclass
class QueryBlock:
    """Queries over a common vocabulary: sorted term hashes, and each query's term numbers."""
    terms: np.ndarray
    queries: list[np.ndarray]
    weight: np.ndarray = field(default=None)
    df: np.ndarray = field(default=None)

    def using(self) -> list[list[int]]:
        """The queries with each term."""
        out: list[list[int]] = [[] for _ in self.terms]
        for q, ts in enumerate(self.queries):
            for t in ts.tolist():
                out[t].append(q)
        return out


def query_block(texts: list[str]) -> QueryBlock:
    hashes = [h for _, h, _ in document_terms(pa.array(texts, pa.string()))]
    terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
    return QueryBlock(terms, [np.searchsorted(terms, h) for h in hashes])


def describe(docs: DataFrame, id_col: str, text_col: str, terms: np.ndarray) -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term: numbers of those of the given
    ``terms`` that it holds, and how often."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, nums, tfs = [], [], []
            for n, h, tf in document_terms(batch.column(1)):
                at = np.minimum(np.searchsorted(terms, h), max(0, len(terms) - 1))
                hit = terms[at] == h if len(terms) else np.zeros(len(h), bool)
                ns.append(n)
                nums.append(at[hit].astype(np.int32).tobytes())
                tfs.append(tf[hit].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(nums, pa.binary()), pa.array(tfs, pa.binary())],
                                             ["id", "n", "terms", "tfs"])
    return (map_texts(docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("_text")),
                      run, f"id {kind}, n long, terms binary, tfs binary").where("n > 0"))


def build_index(facts: DataFrame, block: QueryBlock, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``ids, terms, adds`` of every distinct vector, similar ones side by side.

    Documents with equal vectors have equal scores, so of one vector the ``k``
    smallest ids are kept: no other can be among the ``k`` best.
    """
    held = facts.where(F.octet_length("terms") > 0).withColumn("h1", F.xxhash64("n", "terms", "tfs")).withColumn("h2", F.xxhash64(F.lit(1), "n", "terms", "tfs"))
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.col("id").asc_nulls_last()))
    vectors = (held.withColumn("_place", place).where(F.col("_place") <= k).groupBy("h1", "h2")
               .agg(F.first("n").alias("n"), F.first("terms").alias("terms"), F.first("tfs").alias("tfs"), F.collect_list(F.struct("id")).alias("ids")))
    axes = signs(block.terms) * block.weight[:, None].astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            adds, codes = [], []
            for n, ts, tf in zip(*(c.to_pylist() for c in batch.columns[2:])):
                add = contributions(np.frombuffer(tf, np.int32), n, n_docs, n_terms)
                adds.append(add.astype(np.int32).tobytes())
                side = add.astype(np.float32) @ axes[np.frombuffer(ts, np.int32)] > 0
                codes.append(int(np.packbits(side).view(">u2")[0]))
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), batch.column(0), batch.column(1), batch.column(3), pa.array(adds, pa.binary())],
                                             ["code", "h1", "ids", "terms", "adds"])
    kind = vectors.schema["ids"].dataType.simpleString()
    coded = cut(vectors.select("h1", "ids", "n", "terms", "tfs").mapInArrow(run, f"code int, h1 long, ids {kind}, terms binary, adds binary"))
    return cut(coded.repartitionByRange(tasks(facts.sparkSession), "code", "h1").sortWithinPartitions("code", "h1").select("ids", "terms", "adds"))


# ---- shards, lists and blocks -------------------------------------------------------

class Shard:
    """Some vectors, their posting lists, and the blocks of the lists that were needed."""

    def __init__(self, terms: list[bytes], adds: list[bytes], axes: np.ndarray):
        size = np.array([len(t) // 4 for t in terms])
        self.docs = len(size)
        self.row = np.concatenate([[0], np.cumsum(size)])
        self.term = np.frombuffer(b"".join(terms), np.int32)
        self.add = np.frombuffer(b"".join(adds), np.int32).astype(np.int64)
        by = np.argsort(self.term, kind="stable")
        doc = np.repeat(np.arange(self.docs), size)
        self.present, heads = np.unique(self.term[by], return_index=True)
        self.ends = np.append(heads, len(by))
        self.posted = doc[by]
        self.top = np.maximum.reduceat(self.add[by], heads) if len(heads) else np.zeros(0, np.int64)
        self.point = np.add.reduceat(axes[self.term] * self.add[:, None].astype(np.float32), self.row[:-1], axis=0) if len(self.term) else np.zeros((0, PLANES))
        self.point /= np.linalg.norm(self.point, axis=1, keepdims=True) + 1e-9
        self.made: dict[int, tuple] = {}

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all postings of ``docs``, and where each document's begin among them."""
        n = self.row[docs + 1] - self.row[docs]
        begin = np.cumsum(n) - n
        return np.repeat(self.row[docs] - begin, n) + np.arange(int(n.sum())), begin

    def clustered(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a list (by its place among the present terms) block by block, and where blocks begin."""
        docs = self.posted[self.ends[place]:self.ends[place + 1]]
        if len(docs) <= BLOCK:
            return docs, np.zeros(1, np.int64)
        pivots = docs[BLOCK // 2::BLOCK]
        nearest = np.argmax(self.point[docs] @ self.point[pivots].T, axis=1)
        by = np.argsort(nearest, kind="stable")
        docs, nearest = docs[by], nearest[by]
        heads = np.flatnonzero(np.append(True, nearest[1:] != nearest[:-1]))
        within = np.arange(len(docs)) - np.repeat(heads, np.diff(np.append(heads, len(docs))))
        return docs, np.flatnonzero(within % BLOCK == 0)

    def blocks(self, place: int, useful: np.ndarray) -> tuple:
        """Documents and block heads of a list, and the blocks' summaries: terms, largest
        contributions, and where each block's begin. ``useful``: which terms to keep."""
        if place not in self.made:
            docs, heads = self.clustered(place)
            at, begin = self.entries(docs)
            block = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(docs))))
            of = np.repeat(block, np.diff(np.append(begin, len(at))))
            keep = useful[self.term[at]]
            at, of = at[keep], of[keep]
            key = of * np.int64(len(useful)) + self.term[at]
            by = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(key[by]) > 0))
            high = np.maximum.reduceat(self.add[at[by]], first)
            begins = np.searchsorted(of[by[first]], np.arange(len(heads)))
            self.made[place] = docs, heads, self.term[at[by[first]]], high, begins
        return self.made[place]


class Searcher:
    """All queries of a block over one shard after another. ``floor``: scores that each
    query's k-th best document reaches for sure."""

    def __init__(self, block: QueryBlock, k: int, floor: np.ndarray):
        self.block, self.k, self.floor = block, k, floor.copy()
        self.best: list[np.ndarray] = [np.zeros(0, np.int64) for _ in block.queries]
        self.using = block.using()
        self.axes = signs(block.terms) * block.weight[:, None].astype(np.float32)
        self.weight = np.zeros(len(block.terms), np.int64)
        self.scored = self.skipped = 0

    def useful(self, term: int) -> np.ndarray:
        out = np.zeros(len(self.block.terms), bool)
        for q in self.using[term]:
            out[self.block.queries[q]] = True
        return out

    def search(self, shard: Shard, copies: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, documents of the shard, scores) that may be among the best.
        ``copies``: for how many ids a document stands."""
        for q, ts in enumerate(self.block.queries):
            at = np.searchsorted(shard.present, ts)
            at[at == len(shard.present)] = 0
            held = shard.present[at] == ts if len(shard.present) else np.zeros(len(ts), bool)
            ts, at = ts[held], at[held]
            most = self.block.weight[ts] * shard.top[at]
            by = np.argsort(-most, kind="stable")
            rest = np.append(np.cumsum(most[by][::-1])[::-1], 0)  # what the lists from here on can add up to
            if not len(ts) or rest[0] < max(1, self.floor[q]):
                continue
            self.weight[ts] = self.block.weight[ts]
            seen = np.zeros(shard.docs, bool)
            found, scores = [], []
            for i, p in enumerate(by.tolist()):
                if rest[i] < max(1, self.floor[q]):
                    break
                docs, heads, term, high, begins = shard.blocks(int(at[p]), self.useful(int(ts[p])) if int(at[p]) not in shard.made else None)
                bound = np.add.reduceat(self.weight[term] * high, begins)
                live = bound >= max(1, self.floor[q])
                self.skipped += int((~live).sum())
                docs = docs[np.repeat(live, np.diff(np.append(heads, len(docs))))]
                docs = docs[~seen[docs]]
                if not len(docs):
                    continue
                seen[docs] = True
                self.scored += len(docs)
                score = self.score(shard, docs)
                good = score >= max(1, self.floor[q])
                if good.any():
                    found.append(docs[good])
                    scores.append(score[good])
                    self.note(q, np.repeat(score[good], np.minimum(copies[docs[good]], self.k)))
            self.weight[ts] = 0
            if found:
                docs, score = np.concatenate(found), np.concatenate(scores)
                good = score >= self.floor[q]
                yield q, docs[good], score[good]

    def score(self, shard: Shard, docs: np.ndarray) -> np.ndarray:
        """Exact scores; ``weight`` holds the query's weights."""
        at, begin = shard.entries(docs)
        return np.add.reduceat(self.weight[shard.term[at]] * shard.add[at], begin)

    def note(self, q: int, scores: np.ndarray) -> None:
        best = np.sort(np.concatenate([self.best[q], scores]))[-self.k:]
        self.best[q] = best
        if len(best) == self.k:
            self.floor[q] = max(self.floor[q], best[0])


def _shards(batches: Iterator[pa.RecordBatch], axes: np.ndarray) -> Iterator[tuple[Shard, pa.Array]]:
    """Consecutive vectors in shards, with their ids."""
    ids, terms, adds, size = [], [], [], 0

    def close() -> tuple[Shard, pa.Array]:
        return Shard(terms, adds, axes), pa.concat_arrays(ids)
    for batch in batches:
        ts, ads = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        lo = 0
        for i, t in enumerate(ts):
            if terms and (len(terms) == SHARD_DOCS or size + len(t) // 4 > SHARD_POSTINGS):
                ids.append(batch.column(0).slice(lo, i - lo))
                yield close()
                ids, terms, adds, size, lo = [], [], [], 0, i
            terms.append(t)
            adds.append(ads[i])
            size += len(t) // 4
        ids.append(batch.column(0).slice(lo))
    if terms:
        yield close()


def _seed_scores(block: QueryBlock, k: int):
    """The k best scores of each query among documents with one of its rarest terms, by task."""
    seeds = []
    for ts in block.queries:
        by = ts[np.argsort(block.df[ts], kind="stable")]
        seeds.append(by[np.cumsum(block.df[by]) <= SEEDS])
    rare = np.zeros(len(block.terms), bool)
    for s in seeds:
        rare[s] = True
    using: dict[int, list[int]] = {}
    for q, s in enumerate(seeds):
        for t in s.tolist():
            using.setdefault(t, []).append(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[int]] = {}
        weight = np.zeros(len(block.terms), np.int64)
        for batch in batches:
            for ids, ts, ads in zip(pa.compute.list_value_length(batch.column(0)).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                t = np.frombuffer(ts, np.int32)
                for q in {q for x in t[rare[t]].tolist() for q in using[x]}:
                    weight[block.queries[q]] = block.weight[block.queries[q]]
                    score = int((weight[t] * np.frombuffer(ads, np.int32)).sum())
                    weight[block.queries[q]] = 0
                    best[q] = sorted(best.get(q, []) + [score] * min(ids, k))[-k:]
        rows = [(q, s) for q, all_scores in best.items() for s in all_scores]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())], ["q", "score"])
    return run


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  query_col: str = "item_id", query_text_col: str = "text", rank_ids: tuple[str, str] = ("rank", "score")) -> DataFrame:
    """``query_col, rank, id_col, score``: each query's ``k`` best documents with a
    score above 0, equal scores by ascending id (null last).

    Terms are runs of letters, digits and characters beyond ASCII, A-Z as a-z, compared by
    64-bit hashes. Null texts have none. Query rows that share an id are one query
    with the terms of all; a query without terms has no results. Repeated documents and ids
    are ranked each. Empty tables give no rows. Other columns are ignored.

    The documents are read once for every ``QUERIES`` queries.
    """
    spark = docs.sparkSession
    asked = queries.groupBy(F.col(query_col).alias("_q")).agg(
        F.concat_ws("\n", F.sort_array(F.collect_list(whole_text(query_text_col)))).alias("_t"))
    schema = f"q int, _item {queries.schema[query_col].dataType.simpleString()}"
    out, names, texts, held = None, [], [], 0

    def flush() -> None:
        nonlocal out
        items = spark.createDataFrame(list(enumerate(names)), schema)
        part = _search_block(docs, query_block(texts), k, id_col, text_col).join(F.broadcast(items), "q")
        part = part.select(F.col("_item").alias(query_col), F.col("place").alias(rank_ids[0]), F.col("id").alias(id_col), F.col("score").alias(rank_ids[1]))
        out = part if out is None else out.unionByName(part)

    for r in asked.toLocalIterator():
        if names and (len(names) == QUERIES or held + len(r["_t"]) > QUERY_TERMS):
            flush()
            names, texts, held = [], [], 0
        names.append(r["_q"])
        texts.append(r["_t"])
        held += len(r["_t"])
    flush()
    return out


def _search_block(docs: DataFrame, block: QueryBlock, k: int, id_col: str, text_col: str) -> DataFrame:
    """``q, place, id, score`` of the queries of a block."""
    kind = docs.schema[id_col].dataType.simpleString()
    facts = cut(describe(docs, id_col, text_col, block.terms))
    n_docs, n_terms = facts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(len(block.terms), np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=len(block.terms))
        return total
    block.df = vector_sum(facts.select("terms"), count, len(block.terms), dtype=np.int64)
    block.weight = weights(block.df, n_docs)
    index = build_index(facts, block, n_docs, n_terms, k)
    seeded = (index.mapInArrow(_seed_scores(block, k), "q int, score long")
              .withColumn("_place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where(F.col("_place") <= k)
              .groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == k))
    floor = np.zeros(len(block.queries), np.int64)
    for r in seeded.collect():  # a number for each query
        floor[r["q"]] = r["least"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(block, k, floor)
        for shard, ids in _shards(batches, searcher.axes):
            copies = np.asarray(pa.compute.list_value_length(ids))
            found = list(searcher.search(shard, copies))
            if found:
                rows = np.concatenate([d for _, d, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _, _ in found], [len(d) for _, d, _ in found]), pa.int32()),
                     pa.array(np.concatenate([s for _, _, s in found])), ids.take(pa.array(rows))], ["q", "score", "ids"])

    hits = (index.mapInArrow(run, f"q int, score long, ids array<struct<id:{kind}>>")
            .select("q", "score", F.explode("ids").alias("_i")).select("q", "score", "_i.id"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return hits.withColumn("place", place).where(F.col("place") <= k)
