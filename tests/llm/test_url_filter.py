import math

import pytest

from kickflow.llm.queries import QUERIES, URL_RULES
from kickflow.llm.url_filter import FEATURES, apply_rules, judge, lexical, parts

URLS = [
    ("http://A.Example.NET/en/1", "a.example.net", "/en/1", "example.net/en/"),
    ("https://example.net/en", "example.net", "/en", "net/"),
    ("https://example.net/en/?q=/de/", "example.net", "/en/", "example.net/en/"),
    ("ftp://notexample.net/x#y", "notexample.net", "/x", "net/"),
    ("http://net/", "net", "/", "net/"),
    ("http://planet.com/", "planet.com", "/", None),
    ("http://x.net?a=/", "x.net", "", None),
    ("http://www.example.com/de/a", "www.example.com", "/de/a", "example.com/de/"),
    ("http://example.com/den/", "example.com", "/den/", None),
    ("http://a.org/fr/#t", "a.org", "/fr/", "org/fr/"),
    ("http://É.ORG/fr/x", "É.org", "/fr/x", "org/fr/"),
    ("a://b://c/d", "b:", "//c/d", None),
    ("http://h\n.net/p\nq", "h\n.net", "/p\nq", "net/"),
    ("no scheme.net/", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
]


def brute_rule(host, path):
    best = None
    for _, rule in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best or ""):
            best = rule
    return best


def test_parts_and_rules(spark):
    urls = spark.createDataFrame([(u,) for u, *_ in URLS], "url string")
    found = apply_rules(parts(urls), URL_RULES).collect()
    for (url, host, path, rule), row in zip(URLS, found, strict=True):
        assert (row.host, row.path, row.rule) == (host, path, rule), url
        assert brute_rule(host, path) == rule


def test_longest_rule_wins_whatever_the_order(spark):
    rules = [("allow", "b.com/x/"), ("block", "com/"), ("block", "b.com/"), ("allow", "com/")]
    urls = parts(spark.createDataFrame([("http://a.b.com/x/",), ("http://b.com/",), ("http://c.com/",)], "url string"))
    for order in (rules, rules[::-1]):
        found = apply_rules(urls, order).collect()
        assert [r.rule for r in found] == ["b.com/x/", "b.com/", "com/"]
    assert [r.decided for r in apply_rules(urls, rules).collect()] == ["allow", "block", "block"]


def test_features(spark):
    url = "http://a-b.c.com/x1/y/?k=1&l=&m#z"
    row = lexical(parts(spark.createDataFrame([(url,), (None,)], "url string"))).collect()
    first = row[0]
    assert (first.path_depth, first.parameters, first.hyphens, first.has_fragment) == (3, 2, 1, 1)
    assert (first.host_labels, first.suffix, first.domain) == (3, "com", "c.com")
    assert first.digit_ratio == pytest.approx(2 / len(url))
    share = [url.count(c) / len(url) for c in set(url)]
    assert first.entropy == pytest.approx(-sum(p * math.log2(p) for p in share))
    assert (row[1].url_length, row[1].entropy) == (0, 0)
    assert len(FEATURES) == 13


def test_query(spark):
    path = "/root/testdata/sf0.01"
    found = QUERIES["op8_url_filter"](spark, path).collect()
    verdicts = dict((rule, verdict) for verdict, rule in URL_RULES)
    assert len(found) == spark.read.parquet(f"{path}/pages.parquet").count()
    for r in found:
        assert r.rule == brute_rule(r.host, r.path)
        assert r.verdict == verdicts.get(r.rule, "block" if r.score >= 0.5 else "allow")
    assert {r.verdict for r in found if r.rule is None} == {"allow", "block"}
    ruled = [r for r in found if r.rule]
    assert sum((r.score >= 0.5) == (r.verdict == "block") for r in ruled) / len(ruled) > 0.9


def test_odd_rows(spark):
    rows = [(i, u, "x") for i, (u, *_) in enumerate(URLS)] + [(None, "http://q.com/" + "x" * 20_000, "x"), (1, URLS[1][0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    found = judge(pages, URL_RULES).collect()
    assert len(found) == len(rows)
    assert all(r.verdict in ("allow", "block") and 0 <= r.score <= 1 for r in found)
    assert judge(pages.where("false"), URL_RULES).count() == 0


@pytest.mark.parametrize("rules, verdict", [([], "allow"), ([("block", "net/")], "block"), ([("allow", "net/")], "allow")])
def test_one_kind_of_label(spark, rules, verdict):
    pages = spark.createDataFrame([(1, "http://a.net/"), (2, "http://a.com/"), (3, None)], "page_id long, url string")
    assert {r.verdict for r in judge(pages, rules).collect()} == {verdict}


def test_too_many_rules(spark):
    with pytest.raises(ValueError, match="at most"):
        apply_rules(parts(spark.createDataFrame([("u",)], "url string")), [("block", f"h{i}/") for i in range(1001)])
