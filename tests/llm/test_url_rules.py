import random
import re

import pytest

from orderlake.llm.url_rules import judge, rules_table

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"), ("a.b.net", "", "allow"), ("b.net", "/fr/x", "allow"),
]


def verdict(url, rules, default="allow"):
    url = url or ""
    rest = url[url.index("://") + 3 :] if "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h) + len(p), len(h), h + p, p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[4] if best else default


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com?/en/",
    "http://example.com/en", "http://example.com/en/#a", "http://badexample.com/en/", "http://com/",
    "http://x.com.evil.net/fr/", "http://net/es/", "http://..net/es/", "http://a.b.net", "http://c.a.b.net/fr/xy",
    "http://b.net/fr/x", "http://é.net/fr/", "x://y://z.com/a", "http://com.", "http://n.com/a?b#c", "http://z-.net/fr/",
]


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


@pytest.mark.parametrize("sweeps", [None, 1, 3])
def test_tricky_urls(spark, sweeps):
    df = pages(spark, URLS).selectExpr("*", "'x' as host", "1 as key", "2 as sweep", "3 as kind", "4 as stack")
    for r in judge(df, rules_table(spark, RULES), sweeps=sweeps).collect():
        assert tuple(r)[1:] == verdict(URLS[r.page_id], RULES), URLS[r.page_id]


def test_many_nested_rules(spark):
    rng = random.Random(1)
    labels = ["a", "b", "ab", "a-", "com"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))

    rules = sorted({(host(), rng.choice(["", "/", "/a", "/a/b"]), rng.choice(["allow", "block"])) for _ in range(60)})
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [f"http://{host()}{rng.choice(['', '/', '/a', '/a/bc', '/b'])}" for _ in range(400)]
    found = judge(pages(spark, urls), rules_table(spark, rules), "block", sweeps=4).collect()
    assert len(found) == len(urls)
    for r in found:
        assert tuple(r)[1:] == verdict(urls[r.page_id], rules, "block"), urls[r.page_id]


def test_no_rows_no_rules_and_nulls(spark):
    none = pages(spark, []).where("false")
    assert judge(none, rules_table(spark, RULES)).collect() == []
    some = pages(spark, URLS)
    assert {r.verdict for r in judge(some, rules_table(spark, [(None, "/", "block")])).collect()} == {"allow"}
    twice = some.unionByName(some)
    assert judge(twice, rules_table(spark, RULES)).count() == 2 * len(URLS)
