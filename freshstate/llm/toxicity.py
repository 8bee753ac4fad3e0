"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the counts of terms (words, and their first bytes,
which inflected or compound words share) and the length is fitted with numpy from
confirmed toxic documents and unlabelled ones. Its risk is that of labelled
data, written with the class prior p: p * (loss of positives as positive) +
max(0, (loss of unlabelled as negative) - p * (loss of positives as negative));
where the second term would turn negative, the step goes the other way, so the
classifier cannot gain by fitting the positives hidden among the unlabelled.

Counts cover all documents, of equal texts one: the candidate terms come from the
confirmed documents, and every text is counted for each of them. Only the fit uses a
bounded sample (``MAX_POSITIVE`` and ``MAX_UNLABELLED`` documents, in the order
of a hash of their ids).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, slices, text_buffer, vector_sum, whole_text, word_hashes

MAX_POSITIVE = 20_000
MAX_UNLABELLED = 30_000
#: Candidate terms counted by one pass over the texts, and terms of the classifier.
CANDIDATES = 16_384
TERMS = 192
#: A term needs so many distinct confirmed texts, such a z-value against all distinct
#: texts, and must be so many times as frequent among the confirmed (less, where the
#: toxic share is so large that a toxic term could hardly reach it).
LEAST_DOCS, LEAST_Z, LEAST_LIFT = 5, 5.0, 3.0
PREFIXES = (5, 7)


@dataclass(frozen=True)
class ToxicityModel:
    """``words``: sorted 64-bit term hashes. A score is the logistic function of
    ``bias`` plus the ``weights`` times log2(1 + count) of each term, and the last
    weight times the standardised log of the number of words."""
    words: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float
    length_mean: float = 0.0
    length_scale: float = 1.0

    def score(self, doc: np.ndarray, num: np.ndarray, count: np.ndarray, size: np.ndarray) -> np.ndarray:
        z = self.bias + np.bincount(doc, weights=self.weights[num] * np.log2(1 + count), minlength=len(size))
        z += self.weights[-1] * (np.log1p(size) - self.length_mean) / self.length_scale
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _terms(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, term hash) of every word and word prefix."""
    words, count, *prefixes = word_hashes(buf, off, letters=True, prefixes=PREFIXES)
    doc = np.repeat(np.arange(len(count)), count)
    return np.tile(doc, 1 + len(prefixes)), np.concatenate([words, *prefixes])


def _matches(texts: pa.Array, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, term number, count) of the given terms in the texts, each pair
    once, and the number of words of every text."""
    buf, off = text_buffer(texts)
    size = np.zeros(len(off) - 1)
    pairs, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    most = max(1, len(words))
    for a, b in slices(off):
        doc, h = _terms(buf[off[a]:off[b]], off[a:b + 1] - off[a])
        size[a:b] = np.bincount(doc, minlength=b - a) / (1 + len(PREFIXES))
        if not len(words) or not len(h):
            continue
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        hit = np.flatnonzero(words[at] == h)
        pair, n = np.unique((doc[hit] + a) * most + at[hit], return_counts=True)
        pairs.append(pair)
        counts.append(n)
    pair = np.concatenate(pairs)
    return pair // most, pair % most, np.concatenate(counts), size


def _distinct(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """``_text`` and its content hash in two numbers (equal texts agree in both), after ``more``."""
    text = whole_text(text_col)
    return docs.select(*more, text.alias("_text"), F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2"))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term of a batch, and as term 0 all of them."""
    for batch in batches:
        buf, off = text_buffer(batch.column(0))
        terms = [np.zeros(batch.num_rows, np.uint64)]
        for a, b in slices(off):
            doc, h = _terms(buf[off[a]:off[b]], off[a:b + 1] - off[a])
            order = np.argsort(doc, kind="stable")
            ends = np.searchsorted(doc[order], np.arange(b - a + 1))
            terms += [np.unique(h[order[lo:hi]]) for lo, hi in zip(ends[:-1], ends[1:])]
        term, n = np.unique(np.concatenate(terms), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])


def _sample_rows(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, words: np.ndarray) -> np.ndarray:
    """log2(1 + count) of every term and log(1 + words), one row for each of ``ids``, a
    bounded list that has a document (of an id's texts the one with the least hash)."""
    width = len(words) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, num, count, size = _matches(batch.column(0), words)
            x = np.zeros((batch.num_rows, width), np.float32)
            x[doc, num] = np.log2(1 + count)
            x[:, -1] = np.log1p(size)
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(r.tobytes()) for r in x], pa.binary())], ["x"])

    text = whole_text(text_col)
    texts = (docs.join(F.broadcast(ids), docs[id_col] == ids["_sample"], "left_semi")
             .groupBy(id_col).agg(F.min_by(text, F.xxhash64(text)).alias("_text")).select("_text"))
    rows = map_texts(texts, run, "x binary").collect()
    return np.frombuffer(b"".join(zlib.decompress(r.x) for r in rows), np.float32).reshape(-1, width).copy()


def _toxic_share(docs: DataFrame, lab: DataFrame, id_col: str, text_col: str, label_col: str) -> float:
    """The share of toxic texts among the distinct texts with a usable label."""
    told = lab.groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(label_col) == 1).cast("int")).alias("_toxic"))
    share = (_distinct(docs, text_col, F.col(id_col).alias("_id")).drop("_text").join(told, "_id")
             .groupBy("_h1", "_h2").agg(F.max("_toxic").alias("_toxic")).agg(F.avg("_toxic")).first()[0])
    return min(share or 0.0, 0.9)


def _counts_everywhere(docs: DataFrame, text_col: str, words: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of all distinct texts hold each of ``words`` (sorted), and how many there are."""
    k = len(words)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, num, _, _ = _matches(batch.column(0), words)
            order = np.argsort(doc, kind="stable")
            ends = np.searchsorted(doc[order], np.arange(batch.num_rows + 1))
            num = num[order].astype(np.uint16)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([num[lo:hi].tobytes() for lo, hi in zip(ends[:-1], ends[1:])], pa.binary())],
                                             ["_h1", "_h2", "nums"])

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(k + 1)
        for batch in batches:
            total[:k] += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16), minlength=k)
            total[k] += batch.num_rows
        return total

    # distinct texts: what is shuffled here is a text's hash and candidate numbers
    once = (map_texts(_distinct(docs, text_col), found, "_h1 long, _h2 long, nums binary")
            .groupBy("_h1", "_h2").agg(F.first("nums").alias("nums")).select("nums"))
    total = vector_sum(once, count, k + 1)
    return total[:k], int(total[k])


def _z_values(n: np.ndarray, confirmed: int, everywhere: np.ndarray, texts: int, share: float) -> np.ndarray:
    """How far each term is more frequent among confirmed texts than among all; 0 without enough lift."""
    p1, p0 = n / confirmed, everywhere / texts
    # counts are whole numbers: half a document less (continuity correction)
    z = (p1 - p0 - 0.5 / confirmed) / np.sqrt(np.maximum(p0 * (1 - p0), 1e-9) / confirmed + 1e-9)
    # a term of toxic texts only is 1 / share times as frequent among them as in all distinct
    # texts: the limit is never more than half of that (in logarithms)
    z[p1 < min(LEAST_LIFT, max(share, 1e-9) ** -0.5) * p0] = 0
    return z


def _best_terms(docs: DataFrame, text_col: str, listed: dict[int, int], confirmed: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``TERMS`` candidates with the largest z-values, whatever their number.

    Candidates are counted over all texts ``CANDIDATES`` at a time, the most frequent
    among the confirmed first. A term occurs in all texts at least as often as in the
    confirmed ones, which bounds its z-value; counting ends when no candidate left can
    reach the best ``TERMS`` (or ``LEAST_Z``) any more.
    """
    order = sorted(listed, key=lambda h: (-listed[h], h))
    words, counts, zs = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
    for at in range(0, len(order), CANDIDATES):
        block = np.array(sorted(order[at:at + CANDIDATES]), np.uint64)
        n = np.array([listed[h] for h in block.tolist()], np.int64)
        everywhere, texts = _counts_everywhere(docs, text_col, block)
        words, counts = np.append(words, block), np.append(counts, n)
        zs = np.append(zs, _z_values(n, confirmed, everywhere, texts, share))
        best = np.sort(np.argsort(-zs, kind="stable")[:TERMS])
        words, counts, zs = words[best], counts[best], zs[best]
        left = np.array([listed[h] for h in order[at + CANDIDATES:]], np.int64)
        least = max(LEAST_Z, zs.min() if len(zs) == TERMS else 0)
        if not (_z_values(left, confirmed, left.astype(float), texts, share) >= least).any():
            break
    return words, counts, zs


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 500,
             rate: float = 0.05, decay: float = 3e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk of the logistic
    loss plus ``decay`` times the squared weights (Adam on full batches)."""
    k = positive.shape[1]
    theta, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    theta[-1] = np.log(prior / (1 - prior))

    def grad(x: np.ndarray, pull: np.ndarray) -> np.ndarray:
        return np.append(x.T @ pull, pull.sum()) / max(1, len(x))

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for t in range(1, steps + 1):
        zp = positive @ theta[:-1].astype(np.float32) + theta[-1]
        zu = unlabelled @ theta[:-1].astype(np.float32) + theta[-1]
        as_negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_negative = grad(unlabelled, sigmoid(zu)) - prior * grad(positive, sigmoid(zp))
        if as_negative >= 0:
            g = prior * grad(positive, sigmoid(zp) - 1) + g_negative
        else:
            g = -g_negative
        g[:-1] += 2 * decay * theta[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", usable: Column | None = None) -> ToxicityModel:
    """Fits the classifier. ``usable``: which label rows may be learnt from.

    Unlabelled text is drawn from all rows of ``docs``, whatever their label. The class prior is the share of positives among the
    usable labels. Without positives (or documents) every score is the prior.

    Null labels and label rows without an id are left out; null and empty texts have no
    terms; long texts are read whole; equal texts count once; of texts that share an id one is learnt from.
    """
    lab = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        lab = lab.where(usable)
    n_pos, n_lab = lab.agg(F.sum((F.col(label_col) == 1).cast("long")), F.count(F.lit(1))).first()
    prior = min(max((n_pos or 0) / n_lab, 1e-4), 0.9) if n_lab else 0.05
    empty = ToxicityModel(np.zeros(0, np.uint64), np.zeros(1), float(np.log(prior / (1 - prior))), prior)
    if not n_pos:
        return empty

    def some(ids: DataFrame, most: int) -> DataFrame:
        # at most `most` ids: small enough to broadcast
        rows = ids.select(F.col(id_col).alias("_sample")).distinct().orderBy(F.xxhash64("_sample"), "_sample").limit(most)
        return docs.sparkSession.createDataFrame(rows.collect(), rows.schema)

    confirmed = some(lab.where(F.col(label_col) == 1), MAX_POSITIVE)
    toxic = docs.join(F.broadcast(confirmed), docs[id_col] == confirmed["_sample"], "left_semi")
    counted = (map_texts(_distinct(toxic, text_col).dropDuplicates(["_h1", "_h2"]).select("_text"), _term_counts, "h long, n long")
               .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS))
    # as many as the bounded sample of confirmed texts has terms; term 0 counts its texts
    listed = {r.h & (1 << 64) - 1: r.n for r in counted.collect()}
    confirmed_docs = listed.pop(0, 0)
    if not listed:
        return empty
    lab_share = _toxic_share(docs, lab, id_col, text_col, label_col)
    words, _, z = _best_terms(docs, text_col, listed, confirmed_docs, lab_share)
    best = np.flatnonzero(z >= LEAST_Z)
    if not len(best):
        return empty
    best = best[np.argsort(words[best])]
    positive = _sample_rows(docs, confirmed, id_col, text_col, words[best])
    # text taken without regard to its labels, so that it holds toxic text at the prior's rate
    unlabelled = _sample_rows(docs, some(docs, MAX_UNLABELLED), id_col, text_col, words[best])
    mean, scale = float(unlabelled[:, -1].mean()), float(unlabelled[:, -1].std()) + 1e-6
    for x in (positive, unlabelled):
        x[:, -1] = (x[:, -1] - mean) / scale
    weights, bias = fit_nnpu(positive, unlabelled, prior)
    return ToxicityModel(words[best], weights, bias, prior, mean, scale)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
          keep_cols: tuple[str, ...] | None = None) -> DataFrame:
    """``keep_cols`` (default: the id) and ``score`` for every row, 0 to 1.

    Null and empty texts get the score of a text without any known word. Very
    long texts are read whole; repeated rows are scored each; null ids pass. An
    empty table gives no rows.
    """
    cols = list(keep_cols if keep_cols is not None else (id_col,))
    if "score" in cols:
        raise ValueError("a kept column is named score, like the result: rename it first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(model.score(*_matches(batch.column(0), model.words)))], names)

    names = [f"c{i}" for i in range(len(cols))] + ["score"]
    schema = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(cols)) + "score double"
    return map_texts(docs.select(whole_text(text_col).alias("_text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)]),
                     run, schema).toDF(*cols, "score")
