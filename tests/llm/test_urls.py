from __future__ import annotations

import re

from test_components import brute_components

from tabwright.llm.urls import judge_urls, page_links

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path, rules=RULES):
    fits = [(len(r), a == "allow", r, a) for a, r in rules for name, rest in [(r.split("/")[0], "/" + r.partition("/")[2])]
            if (host == name or host.endswith("." + name)) and path.startswith(rest)]
    return max(fits)[2:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "http://A.Example.COM/en/x", "http://www.example.com/en/",
    "https://b.www.example.com/en/1?x=/de/", "http://x.net/es/1", "http://x.net/es", "http://net/fr/", "http://x.org/fr/#a",
    "http://x.org?http://y.net/es/", "ftp://x.net#/es/", "http://notcom/", "http://x.net/es/1", "http://É.net/fr/",
    "http://example.com/en/" + "a" * 5000,
]


def test_rules_equal_brute_force(spark):
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(URLS)], "page_id long, url string, host string")
    edges = spark.createDataFrame([], "a string, b string")
    found = judge_urls(pages, edges, RULES)
    assert found.columns == ["page_id", "url", "host", "host_", "path", "rule", "verdict"]
    rows = found.collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = parts(r.url)
        rule, action = rule_of(host, path)
        assert (r.host_, r.path, r.rule, r.verdict) == (host, path, rule, action or "allow")
    assert judge_urls(pages.limit(0), edges, RULES).collect() == []
    assert {r.verdict for r in judge_urls(pages, edges, []).collect()} == {"allow"}


def test_links_of_pages(spark):
    pages = spark.createDataFrame([
        ("http://a.org/x/y?q#f", '<LINK href="https://B.org/z?a=1&amp;b=2#top" rel=canonical>'),
        ("http://a.org/x/y", "<meta http-equiv='Refresh' content='0; URL=/new'>"),
        ("http://a.org/x/y", '<link rel="canonical" href="other">'), ("http://a.org", '<link rel="canonical" href="//c.org">'),
        ("http://a.org", '<link rel="canonical" href="mailto:x">'), ("http://a.org", "canonical refresh <a href='http://b.org'>"),
        (None, '<link rel="canonical" href="http://c.org">'), ("http://a.org", None),
    ], "url string, html string")
    links = {tuple(r) for r in page_links(pages).collect() if r.b}
    assert links == {("a.org/x/y?q", "b.org/z?a=1&b=2"), ("a.org/x/y", "a.org/new"), ("a.org/x/y", "a.org/x/other"), ("a.org/", "c.org/")}


def test_blocks_reach_aliases_but_not_allowed_urls(spark):
    names = ["a.org/1", "a.org/2", "x.net/es/1", "b.com/3", "c.org/4", "d.org/5", "e.org/6"]
    edges = [("a.org/1", "a.org/2"), ("a.org/2", "x.net/es/1"), ("b.com/3", "a.org/1"), ("c.org/4", "d.org/5"), ("e.org/6", None)]
    urls = ["http://" + n for n in names] + ["https://a.org/1#x", "http://a.org/1", None]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    found = {r.page_id: r.verdict for r in judge_urls(pages, spark.createDataFrame(edges, "a string, b string"), RULES).collect()}
    component = dict(brute_components(edges))
    for k, url in enumerate(urls):
        node = (url or "").split("://")[-1].split("#")[0]
        own = rule_of(*parts(url))[1]
        others = [n for n in component if component[n] == component.get(node)]
        blocked = any(rule_of(*parts("x://" + n))[1] == "block" for n in others)
        assert found[k] == (own or ("block" if blocked else "allow"))
    assert [found[k] for k in range(7)] == ["block", "block", "block", "allow", "allow", "allow", "allow"]
