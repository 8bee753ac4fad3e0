"""URL filters against trying every rule on every URL."""

import re

import pytest

from freshstate.llm import url_filter as U
from freshstate.llm.queries import SITE_RULES

URLS = [None, "", "no scheme", "http://example.com/en/1", "http://example.com/en", "HTTP://WWW.Example.COM/en/x?q=/fr/",
        "https://a.b.www.example.com/en/", "http://x.net/es/#f", "http://x.net/fr/a://b/en/", "http://notexample.com/en/1",
        "http://org/", "ftp://spam-farm.example.org/de/1", "http://a.cheap-pills.shop/x", "http://spam-farmer.org/",
        "http://com", "http://com/", "://host.net/fr/", "http://é.com/É", "http://x.org/" + "p/" * 20_000]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules):
    host, path = parts(url)
    hits = [r for r in rules if re.search(r.pattern, host + path)]
    best = max(hits, key=lambda r: (r.weight, -rules.index(r)), default=None)
    return host, path, best.name if best else None, best.verdict if best else "allow"


def test_against_every_rule(spark):
    rules = SITE_RULES + U.PATTERN_RULES + (U.Rule("any digits", "block", r"/\d{3}$", ()),)
    df = spark.createDataFrame([(i, u, "rule") for i, u in enumerate(URLS)] + [(3, URLS[3], "again"), (None, "http://x.net/es/", None)],
                               "page_id long, url string, rule string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in U.url_filter(df, rules).collect()), key=str)
    want = [(i, *brute(u, rules)) for i, u in enumerate(URLS)] + [(3, *brute(URLS[3], rules)), (None, *brute("http://x.net/es/", rules))]
    assert got == sorted(want, key=str)
    assert U.url_filter(df.limit(0), rules).count() == 0
    assert {r.verdict for r in U.url_filter(df, ()).collect()} == {"allow"}


@pytest.mark.parametrize("url,rule", [("http://example.com/en/1", "example.com/en/"), ("http://www.example.com/en/1", "www.example.com/en/"),
                                      ("http://example.com/fr/1", "com/"), ("http://example.com", None), ("http://a.net/es/", "net/es/")])
def test_longest_site_rule_wins(spark, url, rule):
    got = U.url_filter(spark.createDataFrame([(1, url)], "page_id long, url string"), SITE_RULES).first()
    assert got.rule == rule


def whole(url):
    host, _ = parts(url)
    return host + re.match(r"(?s)[^/?#]*(.*)", url.split("://", 1)[1])[1] if url and "://" in url else ""


WILD = ["||ads.", "||ads.example.com^", "|x.net/", "/banner/*/ad-", "?utm_source=", "utm_*=feed|", "*track*", "-Promo-", "^id^", "a*b|", "||*-bets.", "/p|"]
WILD_URLS = ["http://ads.x.org/", "https://my.ads.example.com", "http://ads.example.com:80/x", "http://adsx.example.com/", "http://x.net/a", "http://ax.net/",
             "http://h.org/banner/9/x/ad-1", "http://h.org/banner/ad-1", "http://h.org/?utm_source=feed", "http://h.org/q?utm_medium=feed",
             "http://h.org/q?utm_medium=feeds", "http://h.org/backtracking", "http://h.org/a-Promo-b", "http://h.org/a-promo-b", "http://h.org/x?id",
             "http://h.org/?id=3", "http://h.org/aaab", "http://best-bets.h.org/", "http://bets.h.org/", "http://h.org/p", "http://h.org/pp", "http://h.org/a\u212ab", None, ""]


def test_wildcard_rules(spark):
    """Against every rule on every whole URL; tokens only pick what may match."""
    rules = tuple(U.wildcard_rule("block", w) for w in WILD)
    df = spark.createDataFrame(list(enumerate(WILD_URLS)), "page_id long, url string")
    for r in rules:  # one at a time, so that no other rule hides a miss
        got = {x.page_id for x in U.url_filter(df, (r,)).collect() if x.rule}
        want = {i for i, u in enumerate(WILD_URLS) if re.search(r.pattern, whole(u))}
        assert got == want, r
    hit = {r.name: {u for u in WILD_URLS if u and re.search(r.pattern, whole(u))} for r in rules}
    assert hit["||ads.example.com^"] == {"https://my.ads.example.com", "http://ads.example.com:80/x"}
    assert hit["utm_*=feed|"] == {"http://h.org/?utm_source=feed", "http://h.org/q?utm_medium=feed"}
    assert hit["/p|"] == {"http://h.org/p"} and hit["||*-bets."] == {"http://best-bets.h.org/"}
    assert {r.name: r.tokens for r in rules}["/banner/*/ad-"] == ("banner", "ad") and U.wildcard_rule("block", "*track*").tokens == ()


def test_hosts_of_numbers_and_hyphens(spark):
    urls = ["http://10.0.0.1/x", "http://10.0.0.1:8080/", "http://10.0.0.x/", "http://buy-now-cheap-here.org/", "http://a-b.c-d.org/", "http://x.org/a-b-c-d-e"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [r.rule for r in U.url_filter(df, U.PATTERN_RULES).orderBy("page_id").collect()]
    assert got == ["numeric host", "numeric host", None, "hyphenated host", None, None]


def test_many_rules(spark):
    """10^5 rules: a URL runs the few that its tokens fetch."""
    rules = tuple(U.wildcard_rule("block", f"||host{k}.example^") for k in range(100_000))
    df = spark.range(3000).selectExpr("id AS page_id", "concat('http://www.host', id * 50, '.example/', id) AS url")
    out = U.url_filter(df, rules).collect()
    assert all(r.rule == (f"||host{r.page_id * 50}.example^" if r.page_id < 2000 else None) for r in out) and len(out) == 3000


def test_rules_are_indexed_by_their_rarest_token():
    by_token, always = U.index_rules(SITE_RULES + (U.Rule("r", "block", "x", ()),), {"com": 50, "example": 90, "www": 3, "net": 1})
    assert by_token == {"com": [0, 1], "www": [2], "net": [3, 4]} and always == [5]
