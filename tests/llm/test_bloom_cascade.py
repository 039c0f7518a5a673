import re

import pytest

from epispan.llm import bloom_cascade as b

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"), ("block", "a.org/")]
URLS = [
    "http://x.com/a", "https://EXAMPLE.com/en/1?x#y", "http://www.example.com/en/", "http://m.www.example.com/en/z", "http://example.com/EN/", "http://example.com",
    "http://example.com?/en/", "http://b.net/es/q", "http://net/fr/", "http://bnet/fr/", "ftp://a.net/frx", None, "", "no scheme/com/", "http://", "http:///com/", "http://É.COM/\n",
    "http://" + "a." * 50_000 + "com/en/", "http://a.org/" + "p/" * 50_000, "http://xa.org/", "http://x.com/a", "https://u://v.com/a", "http://x.com./a",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match("[^/?#]*", rest)[0])
        path = re.match("[^/?#]*([^?#]*)", rest)[1]
    fits = []
    for verdict, rule in RULES:
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_judgements(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id bigint, url string, rule string").repartition(3)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in b.judge_urls(pages, RULES).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}
    assert b.judge_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in b.judge_urls(pages, []).collect()} == {"allow"}
    with pytest.raises(ValueError):
        b.judge_urls(pages, [*RULES, ("block", "com/")])


@pytest.mark.parametrize("n", [0, 1, 40, 1500, 3000])
def test_cascade_is_exact_over_its_universe(spark, n):
    universe = spark.range(3000).selectExpr("concat('key-', id) as key")
    cascade = b.build_cascade(universe.where(f"cast(substr(key, 5) as int) < {n}"), universe)
    keys = [f"key-{i}" for i in range(3000)]
    assert cascade.holds(keys).tolist() == [i < n for i in range(3000)]
    assert n in (0, 3000) or len(cascade.levels) > 1 or n == 1
    assert cascade.holds([]).tolist() == []


def test_lists_beyond_the_bound_go_through_a_join(spark, monkeypatch):
    keys = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("b", 2)], "key string, n int")
    listed = spark.createDataFrame([("b",), (None,), ("b",), ("z",)], "key string")
    by_filter = sorted(r.n for r in b.listed_keys(keys, listed).collect())
    monkeypatch.setattr(b, "MAX_BITS", 1)
    assert by_filter == sorted(r.n for r in b.listed_keys(keys, listed).collect()) == [2, 2]
