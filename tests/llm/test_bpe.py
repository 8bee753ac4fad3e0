"""Byte-level BPE against the tiktoken library, and exact appends and edits."""

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from freshstate.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def table():
    return bpe.MergeTable(bpe.read_ranks(PATH))


@pytest.fixture(scope="module")
def library(table):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table.ranks, special_tokens={})


TEXT = st.text(alphabet="abcdeinorst'LMéßü漢🎉 \n\t\x1c\x85\xa0\u3000 12.,!$", max_size=80)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_texts_as_the_library(table, library, text):
    assert bpe.TextEncoder(table, P.PATTERN, text).ids() == library.encode_ordinary(text)
    assert bpe.decode(table, library.encode_ordinary(text)) == text.encode()


@settings(max_examples=150, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 80), st.integers(0, 20), TEXT), max_size=3))
def test_edits_and_appends_are_exact(table, library, text, edits):
    enc = bpe.TextEncoder(table, P.PATTERN, text)
    for at, size, new in edits:
        a = min(at, len(text))
        b = min(a + size, len(text))
        text = text[:a] + new + text[b:]
        enc.replace(a, b, new)
        assert enc.text == text and enc.ids() == library.encode_ordinary(text)
    enc.append("ing the")
    assert enc.ids() == library.encode_ordinary(text + "ing the")


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=120), st.binary(max_size=40), st.integers(0, 120), st.integers(0, 30))
def test_prefix_table(table, library, data, more, at, size):
    t = bpe.PrefixTable(table, data)
    kept = list(t.last)
    t.append(more)
    assert t.last[:len(kept)] == kept            # an append never changes an old prefix
    whole = data + more
    assert t.ids() == bpe.PrefixTable(table, whole).ids() and bpe.decode(table, t.ids()) == whole
    if whole not in table.ranks:
        assert t.ids() == library._core_bpe.encode_single_piece(whole)
    a = min(at, len(whole))
    b = min(a + size, len(whole))
    t.replace(a, b, b"the ")
    assert t.ids() == bpe.PrefixTable(table, whole[:a] + b"the " + whole[b:]).ids()


def test_an_edit_far_from_the_end_is_local(table):
    data = b"the quick brown fox jumps over it and so on " * 200
    t = bpe.PrefixTable(table, data)
    assert t.replace(30, 33, b"cat") < 600


def test_documents(spark, library):
    texts = ["", None, "a b\n\n c", "x" * 50_000, "Therti$$$ theaheble*** l'idiot 12 345", " leading", "trailing  "]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)] + [(0, "again", "s", 1), (None, "null id", "s", 1)],
                               "doc_id long, text string, ids string, id int")
    rows = bpe.encode_documents(df, PATH, P.PATTERN, with_decoded=True).collect()
    assert len(rows) == 9
    by = {(r.doc_id, bytes(r.decoded).decode()): list(r.ids) for r in rows}
    for i, t in [*enumerate(texts), (0, "again"), (None, "null id")]:
        assert by[i, t or ""] == library.encode_ordinary(t or "")
    coded = bpe.encode_documents(df, PATH, P.PATTERN)
    assert {bytes(r.decoded).decode() for r in bpe.decode_documents(coded, PATH).collect()} == {t or "" for t in texts} | {"again", "null id"}
    assert bpe.encode_documents(df.limit(0), PATH, P.PATTERN).count() == 0


def test_a_full_cache_is_emptied(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    enc = bpe._Cached(PATH, P.PATTERN)
    import numpy as np
    for text in ["one two three four five six", "six seven one two", ""]:
        assert np.frombuffer(enc.encode(text), "<i4").tolist() == library.encode_ordinary(text)
