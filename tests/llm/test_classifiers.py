"""Quality and toxicity: held-out accuracy, and their parts."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshstate.llm import quality as Q
from freshstate.llm import queries
from freshstate.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def auc(y, s):
    r = np.argsort(np.argsort(s, kind="stable"), kind="stable")
    y = np.asarray(y, bool)
    return (r[y].mean() - (y.sum() - 1) / 2) / max(1, (~y).sum())


def held_out(spark, name, label, fold, k):
    import zlib
    df = queries.QUERIES[name](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(df) == docs and df.score.between(0, 1).all() and ((df.score >= 0.3) == (df.predicted == 1)).all()
    assert (df.held_out == [zlib.crc32(str(i).encode()) % fold == k for i in df.doc_id]).all()
    both = df.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    both = both[both.held_out]
    return both[label].to_numpy(), both


def test_quality_on_held_out_rows(spark):
    y, rows = held_out(spark, "op6_quality_classifier", "quality", 5, 0)
    assert auc(y, rows.score) > 0.97 and (rows.predicted == y).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    y, rows = held_out(spark, "op10_toxicity", "toxic", 4, 2)
    assert auc(y, rows.score) > 0.75
    flagged = rows.predicted == 1
    assert y[flagged].mean() > 0.9 and y[flagged].sum() >= 0.5 * y.sum()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 5)), min_size=1, max_size=12))
def test_isotonic_is_the_best_monotone_fit(points):
    v, w = np.array([p[0] for p in points]), np.array([float(p[1]) for p in points])
    fit = Q.isotonic(v, w)
    assert (np.diff(fit) >= -1e-12).all()
    # the min-max formula of isotonic regression
    for i in range(len(v)):
        best = max(min(np.average(v[a:b + 1], weights=w[a:b + 1]) for b in range(i, len(v))) for a in range(i + 1))
        assert fit[i] == pytest.approx(best)


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, Q.STATISTICS))
    freq, phase = rng.normal(size=(Q.STATISTICS, 20_000)) * 0.2, rng.uniform(0, 2 * np.pi, 20_000)
    z = Q.fourier(x, 0, 1, freq, phase)[:, :-1]
    want = np.exp(-0.5 * 0.04 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_statistics_by_hand():
    s = Q.document_statistics(pa.array(["Ab ab 1!", "", None, "x\ny", "Ab ab 1!"]))
    assert s[0][0] == pytest.approx(1 / 8) and s[0][1] == pytest.approx(1 / 8) and s[0][5] == pytest.approx(2 / 8)
    assert s[0][8] == pytest.approx(np.log1p(3)) and s[0][10] == pytest.approx(2 / 3) and s[0][12] == pytest.approx(1 / 3)
    assert not s[1].any() and not s[2].any() and (s[0] == s[4]).all()


def test_quality_odd_rows(spark):
    texts = ["good text with words", None, "", "x " * 60_000, "BAD!! BAD!!"] * 3
    df = spark.createDataFrame([(i, t, 3, 0.5) for i, t in enumerate(texts)] + [(0, "again", 3, 0.5), (None, "null id", 3, 0.5)],
                               "doc_id long, text string, stats int, score double")
    lab = spark.createDataFrame([(0, 1, "x"), (4, 0, "x"), (4, 0, "x"), (1, None, "x"), (None, 1, "x"), (999, 1, "x")],
                                "doc_id long, quality int, stats string")
    stats = Q.statistics(df)
    rows = Q.score(stats, Q.train(stats, lab)).collect()
    assert len(rows) == len(texts) + 2 and all(0 <= r.score <= 1 for r in rows)
    none = Q.train(stats, lab.limit(0))
    assert {round(r.score, 6) for r in Q.score(stats, none).collect()} <= {0.5} or all(0 <= r.score <= 1 for r in Q.score(stats, none).collect())
    empty = Q.statistics(df.limit(0))
    assert Q.score(empty, Q.train(empty, lab)).count() == 0


def test_nnpu_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(2)
    positive = (rng.random((300, 4)) < [0.9, 0.5, 0.1, 0.1]).astype(np.float32)
    hidden = (rng.random((400, 4)) < [0.9, 0.5, 0.1, 0.1]).astype(np.float32)
    negative = (rng.random((3600, 4)) < [0.02, 0.5, 0.1, 0.1]).astype(np.float32)
    w, b = T.fit_nnpu(positive, np.concatenate([hidden, negative]), 0.1)
    p = 1 / (1 + np.exp(-(np.concatenate([hidden, negative]) @ w + b)))
    assert auc(np.arange(4000) < 400, p) > 0.9 and w[0] > 5 * abs(w[1:]).max()
    assert 0.05 < p.mean() < 0.2


def toxic_fixture():
    words = ["sun", "tree", "river", "stone", "cloud", "field", "bird", "road", "hill", "lake"]
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(600):
        text = [words[k] for k in rng.integers(0, 10, 30)]
        toxic = i % 8 == 0
        if toxic:
            text[5], text[17] = "Vilething,", "scumbag" + "ab"[i % 2]
        rows.append((i, " ".join(text)))
        if i % 3 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_finds_unlabelled_cases(spark):
    rows, labels = toxic_fixture()
    docs = spark.createDataFrame([(i, t, 1.0, "w") for i, t in rows] + [(None, "Vilething scumbaga", 1.0, "w"), (1, None, 1.0, "w"), (2, "", 1.0, "w")],
                                 "doc_id long, text string, score double, c0 string")
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    model = T.train(docs, lab, usable=queries._fold(4) != 2)
    got = T.score(docs, model, keep_cols=("doc_id", "text")).collect()
    assert len(got) == len(rows) + 3
    for r in got:
        assert (r.score >= 0.3) == ("Vilething" in (r.text or "")), (r.doc_id, r.score)
    assert T.score(docs.limit(0), model).count() == 0


def test_toxicity_without_positives(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for lab in ([], [(1, 0), (2, 0)]):
        model = T.train(docs, spark.createDataFrame(lab, "doc_id long, toxic int"))
        assert len({r.score for r in T.score(docs, model).collect()}) == 1
    empty = docs.limit(0)
    assert T.score(empty, T.train(empty, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))).count() == 0


def test_toxicity_of_copied_texts(spark):
    # a fourth of the rows are copies of one toxic text: its terms must still be learnt
    rows, labels = toxic_fixture()
    copied = rows[8][1]
    rows += [(1000 + i, copied) for i in range(200)]
    labels += [(1000 + i, 1) for i in range(0, 200, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    models = [T.train(docs.repartition(n), lab) for n in (1, 7)]
    assert (models[0].words == models[1].words).all()  # whatever the batches
    for r in T.score(docs, models[0], keep_cols=("doc_id", "text")).collect():
        assert (r.score >= 0.3) == ("Vilething" in r.text), (r.doc_id, r.score)


def test_toxicity_of_half_the_texts(spark):
    rows, labels = toxic_fixture()
    rows = [(i, t + " Vilething scumbag") if i % 2 else (i, t) for i, t in rows if i % 8]
    labels = [(i, i % 2) for i, _ in labels if i % 8]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = T.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    for r in T.score(docs, model, keep_cols=("doc_id", "text")).collect():
        assert (r.score >= 0.3) == ("Vilething" in r.text), (r.doc_id, r.score)


def test_toxicity_length_is_standardised(spark):
    rows, labels = toxic_fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = T.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    lengths = np.log1p([len(t.replace(",", "").split()) for _, t in rows])
    assert model.length_mean == pytest.approx(lengths.mean(), rel=1e-3)
    assert model.length_scale == pytest.approx(lengths.std(), abs=1e-4)
