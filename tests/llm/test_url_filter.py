import random

import pytest

from deedflow.llm import url_filter as u


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].translate(str.maketrans(u.UPPER, u.LOWER))
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, default)))


RULES = [*u.RULES, ("block", "a.example.net", "/en"), ("allow", "a.example.net", "/en"), ("block", "co.uk", "/x/y")]


def run(spark, rows, rules):
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule int, digest string, rows string, fit string, verdict string")
    out = u.filter_urls(pages, spark.createDataFrame(rules, "verdict string, host string, path string"))
    return sorted(map(tuple, out.collect()), key=str)


def test_brute_force_with_nulls_repeats_ties_and_clashing_columns(spark):
    rnd = random.Random(1)
    hosts = ["net", "example.net", "A.Example.NET", "b.a.example.net", "notexample.net", "example.com", "x.example.com", "org", "q.org", "é.org", "a.co.uk", ".net", "net.", "net:80", "", "." * 50 + "net"]
    paths = ["", "/", "/en", "/en/", "/english", "/de/x", "/fr/" + "y" * 5000, "/x/yz", "/DE/", "/\n/fr/", "?q=/en/", "#/fr/", "/en/?a://b/"]
    urls = [rnd.choice(["http", "", "h\nx"]) + "://" + h + p for h in hosts for p in paths] + [None, "", "no scheme", "://", "a://b://net/", "x" * 20000]
    rows = [(i // 2, x, "clash", 1, "d", "r", "f", "v") for i, x in enumerate(urls)] + [(None, "http://net/", *[None] * 6), (0, urls[0], "clash", 1, "d", "r", "f", "v")]
    assert run(spark, rows, RULES) == sorted(((r[0], *brute(r[1], RULES)) for r in rows), key=str)


@pytest.mark.parametrize(("rows", "rules"), [([], u.RULES), ([(1, "http://a.net/", *[None] * 6)], []), ([], [])])
def test_empty_tables(spark, rows, rules):
    assert run(spark, rows, rules) == [(r[0], *brute(r[1], rules)) for r in rows]
