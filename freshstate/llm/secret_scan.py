"""Secret scans through a trigram inverted index.

For every rule a Boolean query over trigrams is derived from its parsed regular
expression: whatever the expression matches must satisfy the query. Each Arrow
batch of documents gets an inverted index from the trigrams the queries name to
the documents that hold them; intersecting and uniting postings leaves the
candidates, and only those run the expression. A rule without a mandatory
trigram is run on every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, slices, text_buffer, whole_text


@dataclass(frozen=True)
class SecretRule:
    """``pattern``'s leftmost non-overlapping matches; those whose ``group`` has
    fewer than ``least`` characters are dropped."""
    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0


#: The base kinds, in the order in which ties at a start are listed.
BASE_RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               re.IGNORECASE | re.ASCII, 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    SecretRule("hex", r"[0-9a-f]+", 0, 0, 24),
)
#: Further kinds: key blocks, and tokens that carry a fixed public prefix.
MORE_RULES = (
    SecretRule("keyblock", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("prefixed", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,})"),
    SecretRule("userinfo", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/@]{3,100}@"),
)

# A query is True (no demand), ("tri", code), ("and", q...) or ("or", q...).
_TOO_MANY = 64


def _all(qs):
    qs = [q for q in qs if q is not True]
    return True if not qs else qs[0] if len(qs) == 1 else ("and", *qs)


def _any(qs):
    qs = list(qs)
    return True if not qs or any(q is True for q in qs) else qs[0] if len(qs) == 1 else ("or", *qs)


def _literal(text: str):
    raw = text.encode()
    return _all([("tri", raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) for i in range(len(raw) - 2)])


def _options(op, arg):
    """The short strings (lower case) one parsed item can match, or None."""
    if op is C.LITERAL:
        return [chr(arg).lower()] if arg < 128 else None
    if op is C.IN and all(o is C.LITERAL and a < 128 for o, a in arg):
        return sorted({chr(a).lower() for _, a in arg}) if len(arg) <= 8 else None
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] <= 3:
        inner = _sequence_options(arg[2])
        if inner:
            out = {""} if arg[0] == 0 else set()
            cur = [""]
            for n in range(1, int(arg[1]) + 1):
                cur = [a + b for a in cur for b in inner]
                if len(cur) > _TOO_MANY:
                    return None
                if n >= arg[0]:
                    out.update(cur)
            return sorted(out) if len(out) <= _TOO_MANY else None
    if op is C.SUBPATTERN:
        return _sequence_options(arg[3])
    if op is C.BRANCH:
        each = [_sequence_options(b) for b in arg[1]]
        if all(each):
            return sorted({x for e in each for x in e})
    return None


def _sequence_options(items):
    out = [""]
    for op, arg in items:
        o = _options(op, arg)
        if o is None or len(out) * len(o) > _TOO_MANY:
            return None
        out = [a + b for a in out for b in o]
    return out


def _query(items):
    """Trigram query of a parsed sequence: what its runs of short alternatives
    demand, and what its sub-patterns demand on their own."""
    demands, run = [], [""]

    def flush():
        nonlocal run
        demands.append(_any([_literal(x) for x in run]))
        run = [""]

    for op, arg in items:
        o = _options(op, arg)
        if o is not None and len(run) * len(o) <= _TOO_MANY:
            run = [a + b for a in run for b in o]
            continue
        flush()
        if o is not None and len(o) <= _TOO_MANY:
            run = o
        elif op is C.SUBPATTERN:
            demands.append(_query(arg[3]))
        elif op is C.BRANCH:
            demands.append(_any([_query(b) for b in arg[1]]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] > 0:
            demands.append(_query(arg[2]))
    flush()
    return _all(demands)


def trigram_query(rule: SecretRule):
    """The Boolean trigram query that the lower-cased text of any match satisfies;
    True if the rule has no mandatory trigram."""
    return _query(list(_parser.parse(rule.pattern, rule.flags)))


def _codes(query) -> set[int]:
    return set() if query is True else {query[1]} if query[0] == "tri" else set().union(*map(_codes, query[1:]))


def _evaluate(query, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
    if query is True:
        return np.ones(n, bool)
    if query[0] == "tri":
        return postings.get(query[1], np.zeros(n, bool))
    parts = [_evaluate(q, postings, n) for q in query[1:]]
    return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)


_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def postings(buf: np.ndarray, off: np.ndarray, wanted: np.ndarray) -> dict[int, np.ndarray]:
    """Trigram code -> mask of the documents that hold it, for the wanted codes.
    ``wanted`` is a boolean table over all trigram codes."""
    n, out = len(off) - 1, {}
    for a, b in slices(off):
        low = _FOLD[buf[off[a]:off[b]]]
        if len(low) < 3:
            continue
        code = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
        at = np.flatnonzero(wanted[code])
        doc = np.searchsorted(off, at + off[a], "right") - 1
        inside = at + off[a] + 2 < off[doc + 1]
        for c, d in {*zip(code[at[inside]].tolist(), doc[inside].tolist())}:
            if c not in out:
                out[c] = np.zeros(n, bool)
            out[c][d] = True
    return out


def find_spans(texts: list[str], buf: np.ndarray, off: np.ndarray, rules: tuple[SecretRule, ...],
               compiled: list, queries: list, wanted: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """``(start, rule number, end)`` of every match, sorted, for each text; code points."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    index = postings(buf, off, wanted)
    for k, rule in enumerate(rules):
        expr, least, group = compiled[k], rule.least, rule.group
        for d in np.flatnonzero(_evaluate(queries[k], index, len(texts))).tolist():
            for m in expr.finditer(texts[d]):
                if m.end(group) - m.start(group) >= least:
                    found[d].append((m.start(), k, m.end()))
    for spans in found:
        spans.sort()
    return found


def secret_scan(docs: DataFrame, rules: tuple[SecretRule, ...] = BASE_RULES + MORE_RULES,
                id_col: str = "doc_id", text_col: str = "text", keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, ``keep_cols`` and ``secrets``: an array of (kind, start, end) for every row.

    Positions are code points, the end exclusive, ordered by start, then by the
    order of the rules. Null or empty text has no secrets; very long texts are
    scanned whole; repeated rows are scanned each; null ids pass. An empty table
    gives no rows. ``keep_cols`` may include the text column itself, but not a column
    named ``secrets``.
    """
    if "secrets" in (id_col, *keep_cols):
        raise ValueError("a kept column is named secrets, like the result: rename it first")
    queries = [trigram_query(r) for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [re.compile(r.pattern, r.flags) for r in rules]
        wanted = np.zeros(1 << 24, bool)
        wanted[list(set().union(*map(_codes, queries)))] = True
        kinds = [r.kind for r in rules]
        for batch in batches:
            text = batch.column(0)
            buf, off = text_buffer(text)
            found = find_spans(text.to_pylist(), buf, off, rules, compiled, queries, wanted)
            spans = pa.array([[{"kind": kinds[k], "start": s, "end": e} for s, k, e in x] for x in found],
                             pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], spans], out_names)

    cols = [id_col, *keep_cols]
    out_names = [f"c{i}" for i in range(len(cols))] + ["secrets"]
    schema = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(cols))
    out = docs.select(whole_text(text_col).alias("_text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    return map_texts(out, run, f"{schema}, secrets array<struct<kind:string,start:bigint,end:bigint>>").toDF(*cols, "secrets")


def redact(docs: DataFrame, rules: tuple[SecretRule, ...] = BASE_RULES + MORE_RULES, text_col: str = "text",
           mark: str = "[SECRET]", size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping secrets become one mark.

    All rows and columns stay. A null text stays null. ``size_col``, if it is a
    column, is set to the new number of code points where the text changed.
    """
    names = docs.columns
    # the documents may have columns of the names used here
    cols = [f"_doc_{i}" for i in range(len(names))]
    docs, text_col = docs.toDF(*cols), cols[names.index(text_col)]
    size_col = cols[names.index(size_col)] if size_col in names else None
    found = secret_scan(docs, rules, cols[0], text_col, tuple(cols[1:]))
    merged = F.expr("""aggregate(secrets, array(struct(0L AS s, 0L AS e)), (a, x) ->
        if(x.start < element_at(a, -1).e,
           concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).s AS s, greatest(element_at(a, -1).e, x.end) AS e))),
           concat(a, array(struct(x.start AS s, x.end AS e)))))""")
    t = f"`{text_col}`"
    clean = F.expr(f"""concat(concat_ws('', transform(slice(_m, 2, size(_m)), (x, i) ->
        concat(substring({t}, cast(_m[i].e + 1 AS int), cast(x.s - _m[i].e AS int)), '{mark}'))),
        substring({t}, cast(element_at(_m, -1).e + 1 AS int)))""")
    hit = F.size("secrets") > 0
    out = found.withColumn("_m", F.when(hit, merged)).withColumn(text_col, F.when(hit, clean).otherwise(F.col(text_col)))
    if size_col in cols:
        kind = docs.schema[size_col].dataType
        out = out.withColumn(size_col, F.when(hit, F.char_length(text_col).cast(kind)).otherwise(F.col(size_col)))
    return out.select(*cols).toDF(*names)
