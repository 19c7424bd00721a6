"""URL verdicts against a loop over the rules."""

import pytest

from quayline.llm import urls

URLS = [None, "", "no scheme/en/", "http://example.com/en/x", "HTTP://EXAMPLE.com/en/", "https://www.example.com/en/1?a=/fr/", "http://m.www.example.com/en/",
        "http://badexample.com/en/", "http://example.com", "http://example.com?x=/en/", "http://example.com#/en/", "http://example.com/EN/x",
        "http://a.net/es/b", "http://net/fr/", "http://a.b.c.d.net/fr/x/y/z", "http://net/frx/", "ftp://x://y.com/", "http:///en/", "http://.com/a",
        "http://com./a", "http://ü.com/en/ü", "http://example.com//en/", "://com/", "http://a.com:80/x", "http://" + "a." * 300 + "com/" + "p/" * 3000]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    rest = rest[:cut]
    host, slash, path = rest.partition("/")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    path = slash + path
    fits = [(len(r), r, v) for r, v in rules for h, p in [(r.split("/", 1)[0], "/" + r.split("/", 1)[1])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, default)))


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_verdicts_equal_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(urls, "BROADCAST_RULES", broadcast)
    rules = [*urls.RULES, ("example.com/", "block"), ("c.d.net/fr/x/y/", "allow"), ("ü.com/en/", "block"), ("/en/", "block")][:-1]
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3])] * 4 + [(None, URLS[3])]
    df = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, host string, _at int")
    found = urls.judge(df.repartition(3), urls.rule_table(spark, rules), "page_id").collect()
    expected = [(i, *brute(u, rules)) for i, u in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_rules_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    twice = urls.rule_table(spark, [("com/", "allow"), ("com/", "block")])
    assert urls.judge(df, twice, "page_id").first()["verdict"] == "block"
    none = twice.limit(0)
    assert tuple(urls.judge(df, none, "page_id", default="block").first()) == (1, "a.com", "/x", None, "block")
    assert urls.judge(df.limit(0), twice, "page_id").collect() == []
    for bad in (("com", "allow"), ("com/a", "allow"), ("com/", "maybe"), (None, "allow")):
        with pytest.raises(ValueError):
            urls.judge(df, urls.rule_table(spark, [bad]), "page_id")
