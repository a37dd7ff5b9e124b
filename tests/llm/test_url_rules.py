"""URL rules against a direct reading of every rule."""

import random
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from minekit.llm import url_rules

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("example.org", "/en/", "allow"), ("a.com", "", "block"),
         ("a.com", "", "allow"), (None, "/", "block"), ("B.a.com", None, "allow")]


def _direct(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    best = {}
    for h, p, v in rules:
        if h is not None:
            best[h.lower(), p or ""] = max(v, best.get((h.lower(), p or ""), ""))
    fits = [(len(h), len(p), h + p, v) for (h, p), v in best.items()
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def _urls(n):
    rng = random.Random(4)
    hosts = ["example.org", "www.Example.org", "a.com", "b.a.com", "xb.a.com", "aa.com", "com", "org", "net", "",
             "xexample.org", "a\x01b.org", "é.org", "example.org."]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12/x", "/en/2", "/fr/x", "/de/", "?q=/de/", "#/fr/", "/fr/?a#b", "//"]
    return [None, "", "nohost/es/", "://", "x://y://z"] + [
        f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(n)]


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_judgements(spark, ranges):
    urls = _urls(300)
    rows = [(None if i == 3 else i, u, "r", quote(u or "")) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, key string").repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = [tuple(r) for r in url_rules.judge_urls(pages, rules, ranges=ranges).collect()]
    assert sorted(got, key=repr) == sorted(((i, *_direct(u, RULES)) for i, u, _, _ in rows), key=repr)


def test_one_host_is_cut_into_ranges_and_repeats_stay(spark):
    pages = spark.createDataFrame([(i, "http://a.com/x") for i in range(2000)] + [(1, "http://a.com/x")] * 3,
                                  "page_id long, url string")
    rules = spark.createDataFrame([("com", "/x", "block")], "host string, path string, verdict string")
    out = url_rules.judge_urls(pages, rules, ranges=16)
    assert out.filter("rule = 'com/x' AND verdict = 'block'").count() == 2003


@pytest.mark.parametrize("host", ["a.com", "x" * 150 + "." + "y" * 150 + ".com"])
def test_long_urls_are_cut_into_ranges(spark, host):
    path = "/" + "p" * 250
    pages = spark.createDataFrame([(i, f"http://{host}{path}") for i in range(4000)], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "block"), (host, path, "allow"), (host, path + "q", "block")],
                                  "host string, path string, verdict string")
    out = url_rules.judge_urls(pages, rules, ranges=16)
    assert out.filter(F.col("rule") == host + path).filter("verdict = 'allow'").select("page_id").distinct().count() == 4000
    keyed = pages.select(F.concat(url_rules.host_key(F.lit(host)), F.lit(path + "\x00"),
                                  F.col("page_id").cast("string")).alias("key"))
    assert len(url_rules._boundaries(keyed, 16, 4000)) >= 10


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in url_rules.judge_urls(pages, rules, default="block").collect()] == [
        (1, "a.com", "/x", None, "block")]
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
