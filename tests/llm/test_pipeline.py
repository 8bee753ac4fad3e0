"""The pipeline's stages against plain Python, and odd tables."""

import os

import corpus_pipeline as C
import pytest
from tokenizers import Tokenizer
import public_tokenizers as P

from test_jaccard_join import brute as components_by_brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="test data missing")


def test_stages_in_turn(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = {}
    for name, stage in C.STAGES:
        path = scratch(name)
        stage(spark, docs, SF).write.parquet(path)
        docs = tables[name] = spark.read.parquet(path)
        assert name == "best_fit_packing" or docs.columns == columns
    toxic, exact, near, marked, packed = (tables[n].collect() for n, _ in C.STAGES)
    newest = {}
    for r in toxic:
        newest[r.text] = max(newest.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in exact} == set(newest.values())
    comp = {i: c for i, _, c in components_by_brute([(r.doc_id, r.text) for r in exact])}
    assert {r.doc_id for r in near} == {i for i, c in comp.items() if i == c}
    assert {r.doc_id for r in marked} == {r.doc_id for r in near}
    assert all("AKIA" not in r.text or len(r.text) < 20 for r in marked) and all(r.n_chars == len(r.text) for r in marked)
    tok, length = Tokenizer.from_file(P.path("word_bpe_49k.json")), {}
    for r in packed:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    assert length == {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in marked}
    whole = sorted(tuple(r)[:5] for r in C.run(spark, SF).collect())
    assert whole == sorted(tuple(r)[:5] for r in packed)


def test_odd_tables(spark, scratch):
    sf = scratch("odd")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "same text", "en", "s", 9), (3, "same text", "en", "s", 9),
            (4, "same text", "en", "s", 9), (None, "null id", "en", "s", 7), (5, "token=abcdefgh", "en", "s", 14)]
    spark.createDataFrame(rows, schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    got = [r.doc_id for r in C.run(spark, sf).collect()]
    assert sorted(got, key=str) == sorted([2, 4, None, 5], key=str)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0


def test_nothing_learnt_rejects_nothing(spark, scratch):
    sf = scratch("unlearnt")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(8)], "doc_id long, text string")
    spark.createDataFrame([(i, 1) for i in range(3)], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert C.drop_toxic(spark, docs, sf).count() == 8


def test_copies_with_null_and_repeated_ids(spark):
    rows = [(9, "A"), (None, "A"), (None, "B"), (7, "C"), (7, "A"), (8, "C"), (7, "D"), (None, "B")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in C.drop_copies(spark, docs, SF).collect()), key=str)
    assert got == sorted([(9, "A"), (None, "B"), (8, "C"), (7, "D")], key=str)


def test_columns_named_like_those_of_the_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "2.5D AS score", "'s' AS secrets", "'m' AS _m")
    for stage in (C.drop_toxic, C.mark_secrets):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        plain = stage(spark, docs.drop("score", "secrets", "_m"), SF)
        assert sorted(map(tuple, out.collect())) == sorted((*r, 2.5, "s", "m") for r in plain.collect())
