"""URL filters: pattern rules found through their rarest literal token.

Every rule is a regular expression with the literal tokens (runs of ASCII letters
and digits, lower-cased) that any URL it matches must contain. Spark counts, over all
URLs, how many hold each of those tokens: a URL's distinct tokens are exploded,
joined with the rules' tokens and counted by token. Each rule is then indexed under its
rarest one. The index is sent to every executor once; a URL's own tokens fetch the
candidate rules, and only those are compiled and run. A rule without a literal token is
tried on every URL.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import bounded_broadcast
from .common import map_texts

_TOKEN = re.compile("[A-Za-z0-9]+")


def tokens_of(text: str) -> set[str]:
    return {t.lower() for t in _TOKEN.findall(text)}


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in ``host + path``, or with ``whole`` in all that follows
    ``://`` (its host lower-cased); the matching rule with the largest ``weight`` decides, at equal
    weights the first listed."""
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    weight: int = 0
    whole: bool = False


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for ``host`` and all its subdomains where the URL's path starts with
    ``path``; the longer host and path weighs more."""
    tokens = tuple(dict.fromkeys(t.lower() for t in _TOKEN.findall(host)))
    return Rule(host + path, verdict, rf"\A(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tokens, len(host + path))


def word_rule(verdict: str, words: str) -> Rule:
    """A rule for hosts with a label made of ``words``, joined by hyphens."""
    return Rule(words, verdict, rf"\A(?:[^/]*\.)?{re.escape(words)}\.", tuple(words.split("-")), 0)


#: What ``^`` stands for in a wildcard rule: a character that separates parts of a URL, or the end.
_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\Z)"


def wildcard_rule(verdict: str, expr: str, weight: int = 0) -> Rule:
    """A rule as block lists write them, over host, path, query and fragment: ``*`` is
    anything, ``^`` a separator or the end, a leading ``||`` the start of the host or of a
    label in it, a leading ``|`` the start of the host, a trailing ``|`` the end.

    A literal run is a token of every URL that matches if nothing can go on before or after it.
    """
    start, body = (r"\A(?:[^/?#]*\.)?", expr[2:]) if expr.startswith("||") else (r"\A", expr[1:]) if expr.startswith("|") else ("", expr)
    end, body = (r"\Z", body[:-1]) if body.endswith("|") else ("", body)
    pattern = "".join({"*": ".*", "^": _SEPARATOR}.get(c) or re.escape(c) for c in body)
    whole = [m for m in _TOKEN.finditer(body)
             if (body[m.start() - 1] != "*" if m.start() else start) and (body[m.end()] != "*" if m.end() < len(body) else end)]
    return Rule(expr, verdict, start + pattern + end, tuple(dict.fromkeys(m[0].lower() for m in whole)), weight, True)


#: The default pattern rules: host labels of unwanted sites, then lists' kinds of
#: rules (wildcards in hosts, paths and queries), then hosts that are numbers or strings of hyphens.
PATTERN_RULES = tuple(word_rule("block", w) for w in (
    "spam-farm", "cheap-pills", "casino-bonus", "free-prizes", "adult-content", "link-exchange", "pill-shop", "seo-links")) + tuple(
    wildcard_rule("block", w) for w in (
        "||casino-*.", "||free-bets.", "||*-slots.", "/cgi-bin/*.php?*url=", "/banner/*/click^", "&affiliate_id=", "?redirect=http*",
        "|tracker.", "/wp-login.php|")) + (
    Rule("numeric host", "block", r"\A[0-9]{1,3}(?:[.][0-9]{1,3}){3}(?::[0-9]+)?(?:/|\Z)", ()),
    Rule("hyphenated host", "block", r"\A(?:[^/]*[.])?(?:[^./-]+-){3}", ()),
)


def host_of(url_col: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url_col: str) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rest_of(url_col: str) -> Column:
    """From the host's end to the URL's; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)\A.*?://[^/?#]*(.*)", 1)


def token_counts(pages: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many of all rows (``_host``, ``_rest``) hold each literal token of the rules; as many
    counts as the rules have tokens, whatever the input."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    spark = pages.sparkSession
    text = F.translate(F.concat("_host", "_rest"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    each = pages.select(F.explode(F.array_distinct(F.split(text, "[^a-z0-9]+"))).alias("token"))
    known = bounded_broadcast(spark.createDataFrame([(t,) for t in wanted], "token string"))
    found = {r["token"]: r["n"] for r in each.join(known, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {t: found.get(t, 0) for t in wanted}


class RuleIndex:
    """What an executor needs of the rules. Expressions are compiled when they are first run."""

    def __init__(self, rules: tuple[Rule, ...], counts: dict[str, int]):
        self.rules = rules
        self.by_token, self.always = index_rules(rules, counts)
        order = sorted(range(len(rules)), key=lambda i: (-rules[i].weight, i))
        self.rank = {i: n for n, i in enumerate(order)}
        self.compiled: dict[int, re.Pattern] = {}

    def __getstate__(self):
        return self.__dict__ | {"compiled": {}}

    def judge(self, host: str, path: str, rest: str) -> Rule | None:
        """The rule that decides a URL; only candidates run."""
        tried = set(self.always)
        for token in tokens_of(host + rest):
            tried.update(self.by_token.get(token, ()))
        for i in sorted(tried, key=self.rank.__getitem__):
            if i not in self.compiled:
                self.compiled[i] = re.compile(self.rules[i].pattern)
            if self.compiled[i].search(host + (rest if self.rules[i].whole else path)):
                return self.rules[i]
        return None


def index_rules(rules: tuple[Rule, ...], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rules by their rarest token, and the rules that have none."""
    by_token, always = defaultdict(list), []
    for i, r in enumerate(rules):
        if r.tokens:
            by_token[min(r.tokens, key=lambda t: (counts.get(t, 0), t))].append(i)
        else:
            always.append(i)
    return dict(by_token), always


def url_filter(pages: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row.

    A null or empty URL, or one without ``://``, has an empty host and path and
    gets whatever rule matches the empty text (none of the site rules does),
    else ``default``. Repeated rows are judged each; very long URLs whole. An
    empty table gives no rows. Other columns are ignored.
    """
    parts = pages.select(F.col(id_col), host_of(url_col).alias("_host"), path_of(url_col).alias("_path"), rest_of(url_col).alias("_rest"))
    index = pages.sparkSession.sparkContext.broadcast(RuleIndex(rules, token_counts(parts, rules)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, verdicts = [], []
            for host, path, rest in zip(*(c.to_pylist() for c in batch.columns[1:])):
                hit = index.value.judge(host, path, rest)
                names.append(hit.name if hit else None)
                verdicts.append(hit.verdict if hit else default)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                ["id", "host", "path", "rule", "verdict"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return map_texts(parts, judge, f"id {id_type}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
