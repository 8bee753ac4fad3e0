"""Centroid clustering against plain Lloyd rounds, and its geometric bounds."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshstate.llm import centroids as C
from freshstate.llm.common import add_chunks, vector_sum


def lloyd(rows, k, rounds, dims, scale=64, seed="1"):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), np.array(v, np.int64).tobytes(), v) for i, v in kept if i is not None))[:k]
    cents = [v for _, _, v in first]
    if not cents:
        return []

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        of = assign()
        for j in range(len(cents)):
            own = [v for (_, v), (c, _) in zip(kept, of) if c == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own)]
    of = assign()
    whole = sum(d for _, d in of)
    return sorted(((i, c, d, sum(e for g, e in of if g == c), whole,
                    hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(kept, of)), key=str)


def clustered(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, lower string")
    out = C.cluster_vectors(df, **kw)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scanned"]
    return sorted((tuple(r)[:6] for r in out.collect()), key=str), out


@pytest.mark.parametrize("seed,k,rounds", [(1, 4, 3), (2, 7, 6), (3, 1, 2)])
def test_equals_plain_rounds(spark, seed, k, rounds):
    rng = np.random.default_rng(seed)
    hubs = rng.normal(size=(5, 6))
    rows = [(i, (hubs[i % 5] + rng.normal(scale=0.1, size=6)).astype(np.float32).tolist()) for i in range(300)]
    got, out = clustered(spark, rows, k=k, rounds=rounds, dims=6)
    assert got == lloyd(rows, k, rounds, 6)


def test_bounds_spare_scans(spark):
    rng = np.random.default_rng(4)
    hubs = rng.normal(size=(8, 6)) * 4
    rows = [(i, (hubs[i % 8] + rng.normal(scale=0.05, size=6)).astype(np.float32).tolist()) for i in range(400)]
    got, out = clustered(spark, rows, k=8, rounds=5, dims=6)
    assert got == lloyd(rows, 8, 5, 6)
    assert out.where("scanned").count() < 40


def test_odd_rows(spark):
    """Null and non-finite components, other lengths, repeated ids and vectors, ties, null ids."""
    v = [1.0, -2.0, 0.5, 0.25]
    rows = [(1, v), (1, v), (2, v), (3, [None, 1.0, 1.0, 1.0]), (4, [float("nan")] + v[1:]), (5, [float("inf")] + v[1:]), (6, v[:3]),
            (7, v + [1.0]), (8, None), (9, []), (None, [-x for x in v]), (10, [0.0] * 4), (1, [3.0] * 4), (11, [-0.01] * 4)]
    for k in (1, 2, 3, 50):
        got, _ = clustered(spark, rows, k=k, rounds=2, dims=4)
        assert got == lloyd(rows, k, 2, 4)


def test_no_vectors(spark):
    assert clustered(spark, [], k=3, dims=4)[0] == []
    assert clustered(spark, [(None, [1.0] * 4)], k=3, dims=4)[0] == []


def test_large_components(spark):
    rows = [(i, [float(2 ** 19 + i * 7), float(-i), 1.0, 2.0 ** 18]) for i in range(40)]
    got, _ = clustered(spark, rows, k=3, rounds=2, dims=4)
    assert got == lloyd(rows, 3, 2, 4)
    with pytest.raises(Exception, match="would not fit"):
        clustered(spark, [(1, [1e30] * 4)], k=1, dims=4)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10 ** 9), st.integers(2, 6), st.floats(0.01, 30))
def test_loosening_holds_for_every_point(seed, dims, spread):
    rng = np.random.default_rng(seed)
    old = np.floor(rng.normal(size=(4, dims)) * 40).astype(np.int64)
    new = old + np.floor(rng.normal(size=(4, dims)) * spread).astype(np.int64)
    radius = np.abs(rng.normal(size=4)) * 30
    bound = C.drift_bounds(old, new, radius)
    full = np.sqrt(((old - new) ** 2).sum(1))
    for a in range(4):
        assert bound[a] <= max(full[j] for j in range(4) if j != a) * (1 + 1e-6) + 1e-6
        u = rng.normal(size=(200, dims))
        x = old[a] + radius[a] * u / np.linalg.norm(u, axis=1)[:, None] * rng.uniform(0.9, 1, size=(200, 1))
        for j in range(4):
            if j != a:
                loss = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert loss.max() <= bound[a] + 1e-6


def test_loosening_is_tighter_than_drift():
    """A far sphere beside the line of motion loses little."""
    old = np.array([[0, 1000], [0, 0]])
    new = np.array([[0, 1000], [50, 0]])
    assert C.drift_bounds(old, new, np.array([10.0, 10.0]))[0] < 3 < 50


def test_vector_sum_adds_in_two_levels(spark):
    df = spark.range(0, 4000, 1, 2000)

    def part(batches):
        v = np.zeros(20, np.int64)
        for b in batches:
            v[0] += b.num_rows
            v[3] += int(np.asarray(b.column(0)).sum())
        return v
    got = vector_sum(df, part, 20, chunk=2, dtype=np.int64)
    assert got.tolist() == [4000, 0, 0, 3999 * 2000] + [0] * 16


def test_chunks_of_many_partitions_meet_in_groups(spark):
    """With 2,000 partitions neither level adds more than 64 vectors to one."""
    from pyspark.sql import functions as F
    rows = spark.range(2000).select((F.col("id") / 64).cast("int").alias("g"), F.lit(0).alias("k"),
                                    F.lit(np.ones(4).tobytes()).alias("v"))
    assert rows.groupBy("g", "k").count().agg(F.max("count")).first()[0] <= 64
    once = add_chunks(rows)
    assert once.count() == 32
    whole = add_chunks(once.withColumn("g", F.lit(0))).collect()
    assert len(whole) == 1 and np.frombuffer(whole[0].v).tolist() == [2000.0] * 4
