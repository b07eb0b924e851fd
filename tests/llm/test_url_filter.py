import random

import pytest
from pyspark.sql import functions as F

from formlens.llm import url_filter as U


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, verdict string")


def brute(url, rules, blocked):
    host, path = U.split_url(url)
    fits = lambda h: host == h or host.endswith("." + h)
    best = max(((len(h + p), len(h), h + p, v) for v, h, p in rules if fits(h) and path.startswith(p)), default=None)
    return (host, path, best[2], best[3]) if best else (host, path, None, "block" if any(fits(b) for b in blocked) else "allow")


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


@pytest.mark.parametrize("url,want", [
    (None, ("", "")), ("", ("", "")), ("no scheme", ("", "")), ("http://", ("", "")), ("http://A.Com", ("a.com", "")), ("x://É.Net/P?q#f", ("É.net", "/P")),
    ("http://a.b?x://c/d", ("a.b", "")), ("http://h#f/x", ("h", "")), ("a://b://c", ("b:", "//c")),
])
def test_split(url, want):
    assert U.split_url(url) == want


def test_equals_brute_force(spark):
    r = random.Random(1)
    hosts = [".".join(r.choices(["www", "m", "example", "spam", "ads", "shop"], k=r.randint(0, 2)) + [r.choice(["com", "net", "org", "example.com"])]) for _ in range(200)]
    urls = [f"http://{h}{r.choice(['', '/', '/en/', '/en/x?y', '/es/a#b', '/ES/', '?q=/en/'])}" for h in hosts] + [None, "", "x", "http://", "http://spam.org", "http://spam.org"]
    blocked = ["spam.org", "ads.net", "shop.example.com", "never.seen"]
    out = U.judge(frame(spark, urls), RULES, spark.createDataFrame([(b,) for b in blocked] + [(None,), ("spam.org",)], "key string")).collect()
    assert sorted((x.page_id, x.host, x.path, x.rule, x.verdict) for x in out) == sorted(
        ((i, *brute(u, RULES, blocked)) for i, u in enumerate(urls)), key=lambda x: x[0])


@pytest.mark.parametrize("listed,total", [(0, 50), (40, 50), (300, 5000), (50, 50)])
def test_cascade_is_exact_over_the_universe(spark, listed, total):
    keys = [f"host{i}.example/é{i % 7}" for i in range(total)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string").select("key", *U._hashes(F.col("key")))
    cascade = U.build(universe, spark.createDataFrame([(k,) for k in keys[:listed]], "key string"))
    assert [U.contains(cascade, k) for k in keys] == [i < listed for i in range(total)]


def test_too_long_a_list_is_refused_and_joined(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(500)], "key string")
    universe = keys.select("key", *U._hashes(F.col("key")))
    assert U.build(universe, keys, max_bytes=16) is None
    assert U.listed_among(universe, keys.limit(20)).count() == 20


def test_empty_tables(spark):
    none = spark.createDataFrame([], "key string")
    assert U.judge(frame(spark, []), RULES, none).count() == 0
    assert U.judge(frame(spark, ["http://a.org/"]), [], none).first().verdict == "allow"
