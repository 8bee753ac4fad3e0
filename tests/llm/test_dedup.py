"""Exact dedup, line dedup and fingerprints against plain Python."""

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshstate.llm import exact_dedup as X
from freshstate.llm import line_dedup as LD
from freshstate.llm import simhash as S

COLS = "doc_id long, text string, keep_id string, kept int, _len int"
PREFIX = "the same first sixty-four characters of a text that goes on, and on "


def test_exact_dedup(spark):
    data = [(1, "a"), (5, "a"), (3, "b"), (2, None), (4, ""), (9, PREFIX + "x"), (8, PREFIX + "y"), (7, PREFIX + "x"),
            (6, "c"), (6, "c"), (None, "a"), (None, "only"), (11, "L" * 200_000), (10, "L" * 200_000), (12, "A"), (-3, "neg"), (-5, "neg")]
    df = spark.createDataFrame([(i, t, "z", 1, 2) for i, t in data], COLS)
    for bits in (X.FILTER_BITS, 1 << 15):
        rows = X.exact_dedup(df, keep_cols=("_len",), filter_bits=bits).collect()
        assert len(rows) == len(data) and all(r["_len"] == 2 for r in rows)
        groups = defaultdict(list)
        for i, t in data:
            groups[t or ""].append(i)
        want = sorted((i, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""])) for i, t in data if i is not None)
        assert sorted((r.doc_id, r.keep_id, r.group_size) for r in rows if r.doc_id is not None) == want
        assert sum(r.kept for r in rows) == len(groups)             # one row of each text, also of repeated rows
        assert all(r.kept == (r.doc_id == r.keep_id) for r in rows if r.doc_id is not None and r.doc_id != 6)
    assert X.exact_dedup(df.limit(0)).count() == 0


def test_exact_dedup_is_native(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "Python" not in X.exact_dedup(df)._jdf.queryExecution().executedPlan().toString()


def brute_lines(docs, k=3):
    first, spans = {}, defaultdict(set)
    for i, t in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        lines = (t or "").split("\n")
        for p in range(len(lines) - k + 1):
            w = tuple(lines[p:p + k])
            if not "".join(w).strip(" "):
                continue
            if w in first and first[w] != (i, p):
                spans[i].update(range(p, p + k))
            first.setdefault(w, (i, p))
    return {i: "\n".join(x for p, x in enumerate((t or "").split("\n")) if p not in spans[i]) for i, t in docs}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "", " "]), max_size=12), min_size=1, max_size=6))
def test_line_dedup_brute(spark, docs):
    data = [(i, "\n".join(d)) for i, d in enumerate(docs)]
    got = {r.doc_id: r.text for r in LD.line_dedup(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == brute_lines(data)


def test_line_dedup_edges(spark):
    long = "\n".join(f"line {i}" for i in range(5000))
    data = [(1, "p\nq\nr\ns"), (2, "x\np\nq\nr\ny"), (3, None), (4, ""), (5, "p\nq"), (6, long), (7, long), (None, "p\nq\nr"), (8, "\n\n\n\n")]
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in data] + [(2, "x\np\nq\nr\ny", "c", 0)], "doc_id long, text string, spans string, n_lines int")
    rows = LD.line_dedup(df).collect()
    assert len(rows) == len(data) + 1
    got = {r.doc_id: r for r in rows}
    assert got[1].text == "p\nq\nr\ns" and got[2].text == "x\ny" and got[2].n_removed == 3
    assert [tuple(s) for s in got[2].spans] == [(1, 4)] and got[3].text == "" and got[None].text == ""
    assert got[6].text == long and got[7].text == "" and got[7].n_removed == 5000 and got[8].text == "\n\n\n\n"
    assert LD.line_dedup(df.limit(0)).count() == 0


def test_text_ids(spark):
    data = [("b", "p\nq\nr\ns"), ("a", "x\np\nq\nr\ny"), (None, "p\nq\nr"), ("c", "p\nq\nr\ns"), ("d", None)]
    df = spark.createDataFrame(data, "doc_id string, text string")
    got = {r.doc_id: (r.text, [tuple(s) for s in r.spans]) for r in LD.line_dedup(df).collect()}
    assert got == {"a": ("x\np\nq\nr\ny", []), "b": ("s", [(0, 3)]), "c": ("", [(0, 4)]), None: ("", [(0, 3)]), "d": ("", [])}
    kept = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.exact_dedup(df).collect()}
    assert kept == {("a", "a", 1, True), ("b", "c", 2, False), ("c", "c", 2, True), (None, None, 1, True), ("d", "d", 1, True)}
    nulls = spark.createDataFrame([(None, "t"), ("", "t"), (None, "t")], "doc_id string, text string")
    assert sorted((r.doc_id is None, r.kept) for r in X.exact_dedup(nulls).collect()) == [(False, True), (True, False), (True, False)]


def test_spans_of_one_long_text(spark):
    """Many separate duplicate stretches in one text."""
    block = "\n".join(["p", "q", "r"])
    text = "\n".join(f"{block}\nown {k}" for k in range(4000))
    rows = {r.doc_id: r for r in LD.line_dedup(spark.createDataFrame([(1, block), (2, text)], "doc_id long, text string")).collect()}
    assert rows[2].n_removed == 12000 and len(rows[2].spans) == 4000 and rows[2].text == "\n".join(f"own {k}" for k in range(4000))


def docs_for_simhash():
    words = [f"w{i}" for i in range(400)]
    a = " ".join(words[:200])
    return [(10, a), (9, a), (7, " ".join(words[200:])), (5, ""), (4, None), (3, "one"), (2, "é" * 7 + " b"), (1, "word " * 30_000)]


def test_edit_comparison(spark):
    data = docs_for_simhash()
    df = spark.createDataFrame([(i, t, 5) for i, t in data], "doc_id long, text string, n_chars int")
    got = {r.doc_id: r for r in S.edit_comparison(df).collect()}
    order = sorted(data, reverse=True)
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and got[i].near_next == 1 - bits(got[i].fingerprint, got[order[(k + 1) % len(order)][0]].fingerprint) / S.BITS
        assert got[i].near_edited == 1 - bits(got[i].fingerprint, got[i].edited_fingerprint) / S.BITS
    assert got[10].fingerprint == got[9].fingerprint and got[10].near_next == 1.0
    assert got[9].near_edited > got[9].near_next
    assert S.edit_comparison(df.limit(0)).count() == 0
    assert S.edit_comparison(df.where("doc_id = 7")).first().near_next == 1.0


def bits(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def test_next_text_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET", 3)
    ids = [0, 1, 2, 3, 50, 51, 1000, 1001, 1002, -7, None, 3]
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    rows = S.with_next_text(df).where("NOT _guest").collect()
    nxt = {r._text: r._next for r in rows}
    assert len(nxt) == len(ids)
    at, seen = "t8", []
    for _ in ids:
        seen.append(ids[int(at[1:])])
        at = nxt[at]
    assert at == "t8" and seen == [1002, 1001, 1000, 51, 50, 3, 3, 2, 1, 0, -7, None]


def test_votes_by_hand(spark):
    # with one term each sign is the hash's bit; weights multiply votes
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c a b c")], "doc_id long, text string")
    one = S.fingerprints(df, ["doc_id"], "text", words=1, weight=lambda w: F.when(w == "a", 10).otherwise(1), max_weight=10)
    only_a = S.fingerprints(spark.createDataFrame([(1, "a")], "doc_id long, text string"), ["doc_id"], "text", words=1)
    assert {r.fingerprint for r in one.collect()} == {only_a.first().fingerprint}
    h = spark.sql("select xxhash64(xxhash64('a')) a, xxhash64(77, xxhash64('a')) b").first()
    assert only_a.first().fingerprint == f"{h.a & (1 << 64) - 1:016x}{h.b & (1 << 64) - 1:016x}"


def test_votes_of_a_long_text(spark):
    # more votes than one run counts, against the same count in Python
    words = [f"w{k * k % 700}" for k in range(3000)]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    got = int(S.fingerprints(df, ["doc_id"], "text").first().fingerprint, 16)
    terms = [tuple(words[k:k + 3]) for k in range(3000)]
    h = {t: r for t in set(terms) for r in ()}
    rows = spark.createDataFrame([(*t, *[None] * (3 - len(t))) for t in sorted(set(terms))], "a string, b string, c string")
    for r in rows.selectExpr(
            "a", "b", "c", *[f"if({c} is null, null, xxhash64({c})) h{c}" for c in "abc"]).selectExpr(
            "a", "b", "c", "xxhash64(ha, hb, hc) x", "xxhash64(77, ha, hb, hc) y").collect():
        h[tuple(v for v in (r.a, r.b, r.c) if v is not None)] = ((r.x & (1 << 64) - 1) << 64) | (r.y & (1 << 64) - 1)
    want = sum(1 << n for n in range(128) if 2 * sum(h[t] >> n & 1 for t in terms) > len(terms))
    assert got == want


def test_block_tables_find_every_pair(spark):
    import random
    rnd = random.Random(5)
    base = [rnd.getrandbits(128) for _ in range(30)]
    fps = {f"{b:032x}" for b in base}
    for b in base:
        for n in (1, 3, 4, 5, 6):
            x = b
            for k in rnd.sample(range(128), n):
                x ^= 1 << k
            fps.add(f"{x:032x}")
    data = sorted(fps)
    df = spark.createDataFrame([(f,) for f in data] + [(data[0],), (None,)], "fingerprint string")
    asked = df.where(F.col("fingerprint").substr(32, 1).isin(*"02468ace"))
    queries = {r.fingerprint for r in asked.collect()}
    for radius, blocks, salts in ((3, 5, 1), (4, 7, 3), (6, 8, 8), (0, 1, 2)):
        got = [tuple(r) for r in S.near_fingerprints(asked, df, radius, blocks, salts=salts).collect()]
        want = {(q, f, 1 + (f == data[0]), bits(q, f)) for q in queries for f in data if bits(q, f) <= radius}
        assert len(got) == len(set(got)) and set(got) == want and want
    assert S.near_fingerprints(df, df.limit(0), 3, 5).count() == 0 and S.near_fingerprints(df.limit(0), df, 3, 5).count() == 0


def test_count_near(spark):
    import random
    rnd = random.Random(6)
    fps = [0, 1, 3, 1 << 127, (1 << 128) - 1, (1 << 128) - 1] + [rnd.getrandbits(6) << 40 for _ in range(60)]
    data = [(k if k % 7 else None, f"{f:032x}", "x") for k, f in enumerate(fps)] + [(100, None, "x"), (50, f"{fps[9]:032x}", "x")]
    df = spark.createDataFrame(data, "doc_id long, fingerprint string, n_rows string")
    rows = S.count_near(df, F.col("doc_id") % 2 == 0).collect()
    assert sorted(map(str, ((r.doc_id, r.fingerprint, r.n_rows) for r in rows))) == sorted(map(str, data))
    for r in rows:
        want = None
        if r.doc_id is not None and r.doc_id % 2 == 0 and r.fingerprint:
            want = sum(bits(r.fingerprint, f) <= S.RADIUS for _, f, _ in data if f) - 1
        assert r.n_near == want
    assert S.count_near(df.limit(0), F.lit(True)).count() == 0


def test_order_of_odd_ids(spark, monkeypatch):
    """Null, repeated, far-off and text ids are dealt over buckets evenly."""
    monkeypatch.setattr(S, "BUCKET", 20)
    ids = [None] * 400 + [5] * 300 + [10 ** 15, -(1 << 63), (1 << 63) - 1] + list(range(200))
    data = [(i, f"text {k}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    h = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(data, key=lambda x: (x[0] is None, -(x[0] or 0), h[x[1]]))
    rows = S.with_next_text(df).where("NOT _guest").collect()
    assert {r._text: r._next for r in rows} == {t: order[(k + 1) % len(order)][1] for k, (_, t) in enumerate(order)}
    sizes = defaultdict(int)
    for r in rows:
        sizes[r._bucket] += 1
    assert len(rows) == len(data) and len(sizes) > 25 and max(sizes.values()) < 100

    texts = df.selectExpr("concat('id', doc_id) AS doc_id", "text")
    rows = S.with_next_text(texts).where("NOT _guest").collect()
    nxt = {r._text: r._next for r in rows}
    at, seen = "text 0", set()
    while at not in seen:
        seen.add(at)
        at = nxt[at]
    assert len(seen) == len(data)
    got = S.edit_comparison(texts.where("text = 'text 500'")).first()
    assert got.doc_id == "id5" and got.near_next == 1.0


def test_fingerprints_are_native(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    fps = S.edit_comparison(df)
    for out in (fps, S.near_fingerprints(fps, fps), S.count_near(fps, F.lit(True))):
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    plan = S.near_fingerprints(fps, fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_key" in plan
