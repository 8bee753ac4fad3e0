"""The Jaccard join against all pairs, its stages, and hot groups."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshstate.llm import common
from freshstate.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(data, threshold=75):
    sets = [(i, word_set(t)) for i, t in data]
    forest = common.Forest(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and None not in (sets[a][0], sets[b][0]) and 100 * len(x & y) >= threshold * len(x | y):
                forest.union(a, b)
            elif sets[a][0] is not None and sets[a][0] == sets[b][0] and x and y:
                forest.union(a, b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[forest.find(k)] = min(least.get(forest.find(k), i), i)
    return sorted(((i, len(s), None if i is None else least[forest.find(k)] if s else i) for k, (i, s) in enumerate(sets)), key=str)


def joined(spark, data, **kw):
    df = spark.createDataFrame([(i, t, "x", 9) for i, t in data], "doc_id long, text string, token string, n int")
    return sorted((tuple(r) for r in J.jaccard_components(df, **kw).collect()), key=str)


def edited(rnd, words, share):
    out = list(words)
    for k in rnd.sample(range(len(out)), max(1, int(share * len(out)))):
        out[k] = f"z{rnd.randrange(10 ** 6)}"
    return out


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    docs = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.45 and docs:
            docs.append(edited(rnd, rnd.choice(docs), rnd.choice([0.005, 0.02, 0.03, 0.04, 0.06])))
        elif kind < 0.6:
            docs.append([rnd.choice(vocab) for _ in range(rnd.randint(0, 40))] + passage)
        elif kind < 0.7 and docs:
            docs.append(list(rnd.choice(docs)))
        else:
            docs.append([rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 8, 60, 200, 400]))])
    return [(100 + k, " ".join(d)) for k, d in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    data = corpus(seed)
    got = joined(spark, data)
    assert got == brute(data)
    assert len({c for _, _, c in got}) < len(data)


def test_small_units_and_groups(spark, monkeypatch):
    # tiny limits force chunks of groups, several units to a block, representatives and the rest
    monkeypatch.setattr(J, "GROUP", 4)
    data = corpus(3, 80)
    assert joined(spark, data, unit_tokens=400) == brute(data)


def test_a_hot_group_of_near_copies(spark):
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    data = [(i, " ".join(edited(rnd, base, 0.01))) for i in range(150)] + [(500 + i, " ".join(base)) for i in range(100)]
    data += [(1000 + i, " ".join(f"u{i}_{k}" for k in range(30))) for i in range(50)]
    got = joined(spark, data, unit_tokens=3000)
    assert got == brute(data)


def test_odd_rows(spark):
    data = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (None, "one two"), (7, "a b c d e"),
            (8, "a b c d e f g h"), (7, "a b c d e"), (9, "é É ß x y z"), (10, "É é ß x y z"), (11, "word " * 40_000), (12, "word " * 39_000)]
    assert joined(spark, data) == brute(data)
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_that_share_an_id(spark):
    """Different texts of one id unite all that links with any of them."""
    rnd = random.Random(8)
    a, b = ([f"{k}{rnd.randrange(10 ** 6)}" for _ in range(200)] for k in "ab")
    near_a, near_b = a[:-3] + ["x", "y", "z"], ["p", "q"] + b[2:]
    data = [(7, " ".join(a)), (7, " ".join(b)), (8, " ".join(near_a)), (9, " ".join(near_b)), (7, None), (7, "other words")]
    assert joined(spark, data) == brute(data)
    assert {r[2] for r in joined(spark, data)} == {7}
    crowd = data + [(7, f"one more text {k}") for k in range(60)] + [(100 + k, f"one more text {k}") for k in range(60)]
    assert joined(spark, crowd) == brute(crowd)


def test_text_ids(spark):
    words = [f"w{k}" for k in range(100)]
    df = spark.createDataFrame([("b", " ".join(words)), ("a", " ".join(words[:-1])), ("c", "alone"), (None, "alone")], "doc_id string, text string")
    assert {tuple(r) for r in J.jaccard_components(df).collect()} == {("b", 96, "a"), ("a", 95, "a"), ("c", 1, "c"), (None, 1, None)}


def test_a_row_without_id_comes_first(spark):
    # one task, so that the row without an id is the first with its set
    base = [f"w{i}" for i in range(100)]
    data = [(None, " ".join(base)), (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(base[:-2] + ["z1", "z2"])), (None, "x"), (4, "x"), (5, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    got = sorted((tuple(r) for r in J.jaccard_components(df).collect()), key=str)
    assert got == brute(data) and {(2, 96, 1), (3, 96, 1), (5, 1, 4)} <= set(got)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=60), min_size=2, max_size=25), st.sampled_from([50, 75, 90]))
def test_traversal_keeps_every_link(sets, threshold):
    rng = np.random.default_rng(4)
    names = rng.integers(0, 2 ** 63, 61).astype(np.uint64)
    hashed = [np.sort(names[list(s)]) for s in sets]
    size = np.array([len(s) for s in sets])

    def check(i, j):
        both = len(sets[i] & sets[j])
        return 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both)
    got = J.link_rows(size, [J._bitmap(h) for h in hashed], np.arange(len(sets)), threshold, check).roots()
    want = common.Forest(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if check(i, j):
                want.union(i, j)
    assert got.tolist() == want.roots().tolist()
    # with sides, the links between side 1 and the others
    side = (np.arange(len(sets)) % 3 == 0).astype(int)
    got = J.link_rows(size, [J._bitmap(h) for h in hashed], np.arange(len(sets)), threshold, check, side).roots()
    want = common.Forest(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if check(i, j) and (side[i] or side[j]):
                want.union(i, j)
    assert got.tolist() == want.roots().tolist()


def test_common_shingles_only_shape_the_order(spark, monkeypatch):
    monkeypatch.setattr(J, "_LOCAL_LEAST", 2)
    data = corpus(5)
    assert joined(spark, data) == brute(data)


def test_shingle_sets():
    texts = ["a b c d e f", "A b\tc\nd e f", "a b c d e", "a b", "", None, "a b c d e " * 10]
    sets = list(J.shingle_sets(pa.array(texts)))
    assert [len(s) for s in sets] == [len(word_set(t)) for t in texts]
    assert (sets[0] == sets[1]).all() and sets[2][0] in sets[0] and sets[2][0] not in sets[3]


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    forest = common.Forest(1100)
    for a, b in edges:
        forest.union(a, b)
    comp = defaultdict(set)
    for x in {x for e in edges if e[0] != e[1] for x in e}:
        comp[forest.find(x)].add(x)
    want = {x: min(c) for c in comp.values() for x in c}
    got = {r.node: r.comp for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
