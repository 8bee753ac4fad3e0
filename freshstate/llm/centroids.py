"""Centroid clustering by geometric drift tightening.

Lloyd's rounds over integer vectors, with bounds that spare most distances. Every
vector keeps its cluster, its exact distance to that centroid, and a lower
bound of its distance to any other one. When the centroids move, the lower
bound must be loosened. The members of a cluster lie in a sphere round the old
centroid, so for another centroid moving from p to q the bound shrinks by at
most the largest d(x, p) - d(x, q) of any x in that sphere. This is a problem in
the plane: with the origin half way between p and q, an x is its height along
pq and its distance from that line, and the difference rises with the height
and, above the origin, falls with the distance from the line. Arcs of the
sphere's outline therefore bound it from above, mostly far below the full drift
|pq|. A vector whose own centroid stays certainly nearest is settled by one
distance; the others are ambiguous and scanned against all centroids exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, vector_sum

#: Arcs by which a sphere's outline is bounded.
ARCS = 64
#: Components beyond this are refused: squared distances would not fit a long.
LARGEST = 1 << 26
#: What the double arithmetic of the bounds may be off, relatively.
SLACK = 1e-9


# ---- geometry -----------------------------------------------------------------

def loosening(height: np.ndarray, aside: np.ndarray, radius: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """An upper bound of d(x, p) - d(x, q) over all x of a sphere, never below 0
    or above ``drift`` = |pq|. The sphere's centre has the signed ``height`` over the
    plane half way between p and q (towards q) and the distance ``aside`` from the line pq."""
    angle = np.linspace(0, np.pi / 2, ARCS + 1)
    # on the arc from angle i to i + 1 the height is at most that of i, the distance at least that of i + 1
    h = height[..., None] + radius[..., None] * np.cos(angle[:-1])
    v = np.maximum(0, aside[..., None] - radius[..., None] * np.sin(angle[1:]))
    half = drift[..., None] / 2
    gain = np.hypot(h + half, v) - np.hypot(h - half, v)
    return np.clip(np.where(h > 0, gain, 0).max(axis=-1) * (1 + SLACK) + SLACK, 0, drift)


def drift_bounds(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For every cluster, how much the distance of its members to any other
    centroid can have shrunk. ``radius``: of each cluster's sphere round its old centroid."""
    p, q, c = old[None].astype(float), new[None].astype(float), old[:, None].astype(float)
    move = q - p
    drift = np.sqrt((move ** 2).sum(-1)) * np.ones((len(old), 1))
    unit = move / np.maximum(drift, 1e-300)[..., None]
    from_middle = c - (p + q) / 2
    height = (from_middle * unit).sum(-1)
    aside = np.sqrt(np.maximum((from_middle ** 2).sum(-1) - height ** 2, 0))
    # a little more for rounding in the squares
    slack = SLACK * (1 + np.sqrt((from_middle ** 2).sum(-1)))
    out = loosening(height + slack, np.maximum(aside - np.sqrt(SLACK) * (1 + aside), 0), radius[:, None] * (1 + SLACK) + slack, drift)
    np.fill_diagonal(out, 0)
    return out.max(axis=1) if len(old) > 1 else np.zeros(len(old))


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (long) of all rows to all centroids."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if x.shape[1] * (2 * most) ** 2 < 1 << 53:  # whole numbers that doubles hold exactly
        a, b = x.astype(float), centroids.astype(float)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def own_distance(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    return ((x - centroids[cluster]) ** 2).sum(1)


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), its squared distance, and a lower bound of the others'."""
    d = distances(x, centroids)
    cluster = d.argmin(axis=1)
    own = d[np.arange(len(x)), cluster]
    if len(centroids) == 1:
        return cluster, own, np.full(len(x), np.inf)
    d[np.arange(len(x)), cluster] = np.iinfo(np.int64).max
    return cluster, own, np.sqrt(d.min(axis=1).astype(float)) * (1 - SLACK)


def reassign(x: np.ndarray, cluster: np.ndarray, lower: np.ndarray, centroids: np.ndarray,
             shrink: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, squared distance, lower bound, and whether a vector had to be
    scanned. ``shrink``: loosening by cluster; ``apart``: half the distance to the nearest other centroid."""
    cluster, lower = cluster.copy(), lower - shrink[cluster]
    own = own_distance(x, centroids, cluster)
    sure = np.maximum(lower, apart[cluster])
    ambiguous = ~(np.sqrt(own.astype(float)) * (1 + SLACK) < sure * (1 - SLACK))
    if ambiguous.any():
        cluster[ambiguous], own[ambiguous], lower[ambiguous] = scan(x[ambiguous], centroids)
    return cluster, own, lower, ambiguous


def half_gaps(centroids: np.ndarray) -> np.ndarray:
    if len(centroids) < 2:
        return np.full(len(centroids), np.inf)
    d = np.sqrt(distances(centroids, centroids).astype(float))
    np.fill_diagonal(d, np.inf)
    return d.min(axis=1) / 2


# ---- the jobs --------------------------------------------------------------------

_STATE = "vec binary, cluster int, distance long, lower double, scanned boolean"


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dims)


def _state(head: list, x: np.ndarray, cluster, own, lower, scanned) -> list:
    return [*head, pa.array([r.tobytes() for r in x], pa.binary()), pa.array(cluster.astype(np.int32)), pa.array(own),
            pa.array(lower), pa.array(scanned)]


def integer_vectors(rows: DataFrame, vec_col: str = "embedding", dims: int = 64, scale: int = 64, keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``keep`` and ``_vec`` (longs as bytes): floor(``scale`` * x) of every vector with
    exactly ``dims`` components, none null or non-finite; other rows go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(scale * np.asarray(batch.column(0).flatten(), np.float64).reshape(-1, dims))
            if len(x) and np.abs(x).max() > LARGEST:
                raise ValueError(f"a component beyond {LARGEST / scale}: squared distances would not fit a long")
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([r.tobytes() for r in x.astype(np.int64)], pa.binary())], names)

    names = [f"k{i}" for i in range(len(keep))] + ["_vec"]
    schema = "".join(f"k{i} {rows.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep)) + "_vec binary"
    finite = F.forall(vec_col, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    kept = rows.where(F.col(vec_col).isNotNull() & (F.size(vec_col) == dims) & finite)
    return (kept.select(F.col(vec_col).cast("array<double>").alias("_v"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
            .mapInArrow(run, schema).toDF(*keep, "_vec"))


def cluster_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, rounds: int = 3,
                    dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """One row per kept vector: ``id_col, cluster, distance, cluster_inertia,
    inertia, centroid_sha256, scanned`` (whether the last assignment had to scan it).

    Vectors without exactly ``dims`` finite components are left out. Centroids 0, 1,
    ... start as the ``k`` vectors with the smallest sha256 of ``<seed>:<id>``;
    fewer vectors make fewer centroids; of repeated ids the smallest vectors (as
    bytes) come first; a vector without an id is clustered and starts no centroid.
    Each round assigns every vector to the nearest centroid (ties: smaller
    number), then moves every non-empty centroid to the floor of its mean; at the
    end vectors are assigned once more. An empty table gives no rows; other columns are ignored.

    State (one row per vector) is cut every round; what reaches the driver is a
    few numbers per centroid.
    """
    base = cut(integer_vectors(rows, vec_col, dims, scale, (id_col,)))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    first = base.where(F.col(id_col).isNotNull()).orderBy(order, "_vec").limit(k).select("_vec").collect()
    kind = rows.schema[id_col].dataType.simpleString()
    if not first:
        return base.select(id_col, *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"),
            ("centroid_sha256", "string"), ("scanned", "boolean"))]).limit(0)
    centroids = np.frombuffer(b"".join(bytes(r[0]) for r in first), np.int64).reshape(-1, dims).copy()
    n = len(centroids)
    names = ["id", "vec", "cluster", "distance", "lower", "scanned"]

    def begin(c: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _vectors(batch.column(1), dims)
                yield pa.RecordBatch.from_arrays(_state([batch.column(0)], x, *scan(x, c), np.ones(len(x), bool)), names)
        return run

    def again(c: np.ndarray, shrink: np.ndarray):
        apart = half_gaps(c)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _vectors(batch.column(1), dims)
                out = reassign(x, np.asarray(batch.column(2)).astype(np.int64), np.asarray(batch.column(3)), c, shrink, apart)
                yield pa.RecordBatch.from_arrays(_state([batch.column(0)], x, *out), names)
        return run

    def sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((n, dims), np.int64)
        for batch in batches:
            x, of = _vectors(batch.column(0), dims), np.asarray(batch.column(1))
            by = np.argsort(of, kind="stable")
            heads = np.flatnonzero(np.append(True, np.diff(of[by]) > 0)) if len(by) else []
            if len(by):
                total[of[by][heads]] += np.add.reduceat(x[by], heads, axis=0)
        return total.ravel()

    state = cut(base.select(F.col(id_col).alias("id"), "_vec").mapInArrow(begin(centroids), f"id {kind}, {_STATE}"))
    for _ in range(rounds):
        facts = {r["cluster"]: r for r in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far")).collect()}
        total = vector_sum(state.select("vec", "cluster"), sums, n * dims, dtype=np.int64).reshape(n, dims)
        moved = np.stack([total[j] // facts[j]["n"] if j in facts else centroids[j] for j in range(n)])
        radius = np.array([np.sqrt(float(facts[j]["far"])) if j in facts else 0.0 for j in range(n)])
        shrink = drift_bounds(centroids, moved, radius)
        centroids = moved
        state = cut(state.select("id", "vec", "cluster", "lower").mapInArrow(again(centroids, shrink), f"id {kind}, {_STATE}"))
    inertia = {r["cluster"]: r["s"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    # one row per centroid
    told = rows.sparkSession.createDataFrame([(j, s, sum(inertia.values()), digest[j]) for j, s in inertia.items()],
                                             "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(told), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scanned")
