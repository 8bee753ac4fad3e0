"""Quality classifier: random Fourier features of document statistics.

Every document is reduced to a few statistics of its bytes, words and lines.
Random Fourier features approximate a Gaussian kernel over them; each partition
sums its share of the normal equations, the sums give ridge scores, and an
isotonic (monotone) map fitted on scores of rows that the scoring ridge did not see turns
scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_texts, slices, text_buffer, vector_sum, whole_text, word_hashes

FEATURES = 256
RIDGE = 1e-3
FOLDS = 5
#: Bins of the calibration: bounds what reaches the driver.
BINS = 512

_CLASSES = np.zeros((256, 7))
_CLASSES[65:91, 0] = 1                                                       # upper case
_CLASSES[48:58, 1] = 1                                                       # digits
_CLASSES[[33, 63], 2] = 1                                                    # ! and ?
_CLASSES[[44, 46, 58, 59], 3] = 1                                            # . , : ;
_CLASSES[[35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 92, 94, 95, 124, 126], 4] = 1  # symbols
_CLASSES[[9, 10, 11, 12, 13, 32], 5] = 1                                     # white space
_CLASSES[128:, 6] = 1                                                        # other than ASCII
STATISTICS = 17


def document_statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` numbers for each text; an empty text has all zeros."""
    buf, off = text_buffer(texts)
    out = np.zeros((len(off) - 1, STATISTICS))
    for a, b in slices(off):
        raw, at = buf[off[a]:off[b]], off[a:b + 1] - off[a]
        if not len(raw):
            continue
        size = np.diff(at)
        doc = np.repeat(np.arange(b - a), size)
        n = np.maximum(size, 1)
        kinds = np.bincount(doc * 256 + raw, minlength=(b - a) * 256).reshape(-1, 256)
        share = kinds @ _CLASSES / n[:, None]
        h, count = word_hashes(raw, at)
        words = np.maximum(count, 1)
        wdoc = np.repeat(np.arange(b - a), count)
        order = np.lexsort((h, wdoc))
        hs, ds = h[order], wdoc[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
        run = np.diff(np.append(np.flatnonzero(new), len(hs)))
        top = np.zeros(b - a)
        np.maximum.at(top, ds[new], run)
        again = np.zeros(b - a)
        if len(h) > 1:
            same = (h[1:] == h[:-1]) & (wdoc[1:] == wdoc[:-1])
            again = np.bincount(wdoc[1:][same], minlength=b - a)
        lines = kinds[:, 10] + 1
        p = kinds / n[:, None]
        entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
        live = size > 0
        out[a:b] = np.column_stack([
            share, np.log1p(size), np.log1p(count), np.where(live, (size - share[:, 5] * size) / words, 0),
            np.bincount(ds[new], minlength=b - a) / words, top / words, again / words, entropy,
            np.log1p(size / lines), lines / n, share[:, 0] * n / np.maximum(1, (1 - share[:, 5]) * n)]) * live[:, None]
    return out


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, random frequencies and phases, ridge weights, calibration knots."""
    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale, self.freq, self.phase) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values)


def fourier(stats, mean, scale, freq, phase) -> np.ndarray:
    """sqrt(2 / D) cos(x w + b), whose inner products approximate the kernel, and a constant."""
    x = np.clip((stats - mean) / scale, -8, 8)
    z = np.sqrt(2 / freq.shape[1]) * np.cos(x @ freq + phase)
    return np.column_stack([z, np.ones(len(x))])


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` (pool adjacent violators)."""
    means, mass, sizes = [], [], []
    for v, w in zip(values, weights):
        means.append(v)
        mass.append(w)
        sizes.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            w2, w1 = mass.pop(), mass.pop()
            m2, m1 = means.pop(), means.pop()
            means.append((m1 * w1 + m2 * w2) / (w1 + w2))
            mass.append(w1 + w2)
            sizes[-2:] = [sizes[-2] + sizes[-1]]
    return np.repeat(means, sizes)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, stats binary`` (doubles) for every row: the one pass over the texts.

    Null and empty texts have statistics of zero; long texts are read whole; repeated
    rows and null ids pass; an empty table gives no rows; other columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = document_statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "stats"])
    kind = docs.schema[id_col].dataType.simpleString()
    return cut(map_texts(docs.select(id_col, whole_text(text_col).alias("_text")), run, f"id {kind}, stats binary")
               .withColumnRenamed("id", id_col))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, STATISTICS)


def train(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          usable: Column | None = None, seed: int = 5) -> QualityModel:
    """Fits ridge scores on all usable labelled rows, and the calibration on
    out-of-fold scores: rows fall into ``FOLDS`` folds by a hash of the id, and each
    fold is scored by the ridge of the others (the sums of all less its own).

    Null labels and ids are left out; an id with several labels has the largest; of
    repeated documents each counts. A fold whose others are empty has scores of
    zero. Without any label every score is 0.5.
    """
    lab = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        lab = lab.where(usable)
    lab = lab.groupBy(id_col).agg(F.max(label_col).cast("double").alias("_y"))
    rows = cut(stats.join(lab, id_col).select("stats", "_y", F.pmod(F.xxhash64(id_col), F.lit(FOLDS)).cast("int").alias("_fold")))
    k = STATISTICS

    def moments(batches):
        total = np.zeros(2 * k + 1)
        for batch in batches:
            x = _matrix(batch.column(0))
            total += np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]])
        return total

    s = vector_sum(stats.select("stats"), moments, 2 * k + 1)
    n = max(s[-1], 1)
    mean = s[:k] / n
    scale = np.sqrt(np.maximum(s[k:2 * k] / n - mean ** 2, 0)) + 1e-6
    rng = np.random.default_rng(seed)
    freq = rng.normal(size=(k, FEATURES)) / (0.7 * np.sqrt(k))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    d = FEATURES + 1

    def equations(batches):
        total = np.zeros((FOLDS, d, d + 1))
        for batch in batches:
            z = fourier(_matrix(batch.column(0)), mean, scale, freq, phase)
            y, fold = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            for f in np.unique(fold).tolist():
                own = z[fold == f]
                total[f] += np.column_stack([own.T @ own, own.T @ y[fold == f]])
        return total.ravel()

    eq = vector_sum(rows.select("stats", "_y", "_fold"), equations, FOLDS * d * (d + 1)).reshape(FOLDS, d, d + 1)
    if not eq[:, -1, d - 1].sum():
        return QualityModel(mean, scale, freq, phase, np.zeros(d), np.array([-1.0, 1.0]), np.array([0.5, 0.5]))

    def ridge(sums: np.ndarray) -> np.ndarray:
        m = sums[-1, d - 1]
        return np.linalg.solve(sums[:, :d] + RIDGE * m * np.eye(d) / FEATURES, sums[:, d]) if m else np.zeros(d)

    weights, others = ridge(eq.sum(axis=0)), np.stack([ridge(eq.sum(axis=0) - eq[f]) for f in range(FOLDS)])
    grid = np.linspace(-0.5, 1.5, BINS + 1)

    def histogram(batches):
        total = np.zeros((2, BINS))
        for batch in batches:
            z = fourier(_matrix(batch.column(0)), mean, scale, freq, phase)
            z = (z * others[np.asarray(batch.column(2))]).sum(axis=1)
            i = np.clip(np.searchsorted(grid, z, "right") - 1, 0, BINS - 1)
            total += [np.bincount(i, minlength=BINS), np.bincount(i, weights=np.asarray(batch.column(1)), minlength=BINS)]
        return total.ravel()

    count, ones = vector_sum(rows.select("stats", "_y", "_fold"), histogram, 2 * BINS).reshape(2, BINS)
    seen = count > 0
    middle = (grid[:-1] + grid[1:]) / 2
    flat = isotonic(ones[seen] / count[seen], count[seen])
    # a slight slope keeps the order of the ridge scores within a pooled stretch
    knots = np.concatenate([[-2.0], middle[seen], [3.0]])
    values = 0.99 * np.concatenate([[flat[0]], flat, [flat[-1]]]) + 0.01 * (np.clip(knots, -1, 2) + 1) / 3
    return QualityModel(mean, scale, freq, phase, weights, knots, np.clip(values, 0, 1))


def score(stats: DataFrame, model: QualityModel, id_col: str = "doc_id") -> DataFrame:
    """``id_col, score`` (0 to 1) for every row of ``statistics``.

    Null and empty texts get the score of a text whose statistics are zero.
    Repeated rows are scored each; null ids pass; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], ["id", "score"])
    kind = stats.schema[id_col].dataType.simpleString()
    return stats.select(id_col, "stats").mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
