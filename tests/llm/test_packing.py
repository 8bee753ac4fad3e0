"""Best-fit packing: ids as the library's, valid places, certified bounds."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from freshstate.llm import packing as K

PATH = P.path("word_bpe_49k.json")
TEXTS = ["", None, "Hello, World! l'idiot 12é", "ÉCOLE straße *** $$$ a\tb\u3000c", "x " * 5000, "<|endoftext|> tail", "Σας ΣΑΣ İstanbul",
         "e\u0301 combining", "Therti$$$ theaheble*** END!!", "a" * 3000]


def test_pieces_as_the_library(spark):
    tok = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(0, "again", 1), (None, "null id", 1)],
                               "doc_id long, text string, length int")
    rows = K.pieces(df, PATH, with_ids=True).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.ids == b"", r.piece)):
        got[r.doc_id].append(r)
    for i, t in enumerate(TEXTS):
        if i == 0:
            continue
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(b"".join(bytes(r.ids) for r in got[i]), "<u4").tolist() == ids
        assert [r.start for r in got[i]] == list(range(0, len(ids), 2048)) and [r.piece for r in got[i]] == list(range(len(got[i])))
        assert all(r.length == 2048 for r in got[i][:-1]) and all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got[i])
    assert len(got[0]) == 2 and len(got[None]) == 1
    assert K.pieces(df.limit(0), PATH).count() == 0


def test_a_full_cache_is_refilled(monkeypatch):
    monkeypatch.setattr(K, "CACHE_ENTRIES", 4)
    enc, tok = K.WordIds(PATH), Tokenizer.from_file(PATH)
    for t in ["one two three four five one", "five, six seven two", "one"]:
        assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_best_fit_and_bound(lengths):
    x = np.array(lengths)
    bins, offsets = K.best_fit_decreasing(x, 40)
    fill = np.bincount(bins, weights=x)
    assert fill.max() <= 40 and len(fill) >= K.lower_bound(x, 40) >= -(-sum(lengths) // 40)
    for b in range(len(fill)):
        own = sorted(zip(offsets[bins == b].tolist(), x[bins == b].tolist()))
        assert own[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(own, own[1:]))


def test_bound_is_proven_by_search():
    # the optimum by trying every assignment, for a few small cases
    def optimum(xs, cap):
        best = [len(xs)]

        def go(i, rooms):
            if len(rooms) >= best[0]:
                return
            if i == len(xs):
                best[0] = len(rooms)
                return
            for k, r in enumerate(rooms):
                if r >= xs[i]:
                    go(i + 1, rooms[:k] + [r - xs[i]] + rooms[k + 1:])
            go(i + 1, rooms + [cap - xs[i]])
        go(0, [])
        return best[0]
    rng = np.random.default_rng(1)
    for _ in range(60):
        xs = rng.integers(1, 13, 7).tolist()
        assert K.lower_bound(np.array(xs), 12) <= optimum(xs, 12) <= len(np.bincount(K.best_fit_decreasing(np.array(xs), 12)[0]))
    assert K.lower_bound(np.array([7, 7, 7]), 12) == 3      # no two fit together: more than the sum proves


def test_exchange_closes_the_gaps(spark):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(1, 400, 3000)] + [2048] * 5
    df = spark.createDataFrame([(i, n, 7) for i, n in enumerate(lengths)], "doc_id long, length long, offset int")
    rows = K.best_fit_pack(df, group_pieces=100).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(lengths)))
    used = check_places(rows, 2048)
    assert used <= -(-sum(lengths) // 2048) + 1
    assert check_places(K.best_fit_pack(df, group_pieces=100, rounds=1).collect(), 2048) > used


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 2048), (3, 2048), (None, 5)], "doc_id long, length long")
    rows = K.best_fit_pack(df).collect()
    assert sorted((r.length is None or r.length < 1) == (r.sequence_id is None) for r in rows) == [True] * 5
    assert len({r.sequence_id for r in rows if r.length == 2048}) == 2
    assert K.best_fit_pack(df.limit(0)).count() == 0
    import pytest
    with pytest.raises(ValueError):
        K.best_fit_pack(spark.createDataFrame([(1, 2049)], "doc_id long, length long"))
