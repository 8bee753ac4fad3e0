"""Benchmark decontamination against every window at every place."""

import random
import re

import pytest

from freshstate.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_list(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = word_list(t)
        for p in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[p:p + window]), set()).add(None if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, named = word_list(t), set(), set()
        for win, ids in wins.items():
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p:p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    named |= ids
        spans = []
        for k in sorted(hit):
            if spans and spans[-1][1] == k:
                spans[-1][1] = k + 1
            else:
                spans.append([k, k + 1])
        out.append((d, len(w), len(hit), tuple(sorted(x for x in named if x is not None)), tuple(map(tuple, spans))))
    return sorted(out, key=str)


def judged(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, token string, start int")
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, win string")
    out = D.decontaminate(d, b, **kw)
    assert out.columns == ["doc_id", "n_words", "n_hit", "items", "spans"]
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple((s.start, s.end) for s in r.spans)) for r in out.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(25)] + ["ñu", "É", "1st"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 3, 9, 10, 11, 14, 25])))) for i in range(25)]
    docs = []
    for d in range(80):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(3)):
            part = word_list(rnd.choice(items)[1])
            lo = rnd.randrange(len(part))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = part[lo:lo + rnd.choice([3, 9, 10, 12, 40])]
        docs.append((d, rnd.choice([" ", ", ", "\n", "--"]).join(x.upper() if rnd.random() < 0.2 and x.isascii() else x for x in w)))
    return docs, items


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_equals_all_windows(spark, max_bytes):
    """Also where the benchmark is too large to be broadcast."""
    docs, items = corpus(1)
    assert judged(spark, docs, items, max_bytes=max_bytes) == brute(docs, items)


def test_other_windows(spark):
    docs, items = corpus(2)
    for window, shingle in ((5, 5), (4, 1)):
        assert judged(spark, docs, items, window=window, shingle=shingle) == brute(docs, items, window)


def test_odd_rows(spark):
    """Nulls, no words, repeated rows and ids, items without an id, shared windows, characters beyond ASCII."""
    ten = " ".join(f"a{i}" for i in range(10))
    items = [(1, ten), (1, ten + " b"), (2, "X " + ten.upper()), (None, "solo passage"), (3, None), (4, ""), (5, " ,.-"), (6, "Ñandú"), (7, "é")]
    docs = [(1, ten), (1, ten), (None, ten + "\x00" + ten), (2, None), (3, ""), (4, "?!"), (5, "SOLO  passage"), (5, "other"),
            (6, "ñandú É é Ñandú"), (7, ten[:-1]), (8, "\U0001d54f " + ten + " \U0001d54f")]
    for max_bytes in (1 << 20, 0):
        assert judged(spark, docs, items, max_bytes=max_bytes) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(3)
    assert judged(spark, [], items) == []
    assert judged(spark, docs, []) == brute(docs, [])
    assert judged(spark, [], []) == []


def test_long_text_and_copies(spark):
    """A passage over and over in one long text, and in many copies of a text."""
    passage = " ".join(f"p{i}" for i in range(14))
    long = " ".join([passage, "gap"] * 1500)
    docs = [(0, long), *[(k, "so " + passage) for k in range(1, 300)], (999, "clean " * 50)]
    items = [(k, passage) for k in range(20)] + [(77, "clean room")]
    got = {r[0]: r for r in judged(spark, docs, items)}
    assert got[0][1:3] == (22500, 21000) and len(got[0][4]) == 1500
    assert got[5] == (5, 15, 14, tuple(sorted(str(k) for k in range(20))), ((1, 15),))
    assert got[999][2] == 0


def test_native_plan(spark):
    docs, items = corpus(1)
    plan = D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text and "Cartesian" not in text
