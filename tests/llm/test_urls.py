"""URL rules against a plain definition, and cascades against sets."""

import pytest
from pyspark.sql import functions as F

from tripflow.llm import url_filters as u

URLS = [
    None, "", "no scheme", "http://", "HTTP://A.ORG", "http://a.org/", "http://Example.ORG/es/1",
    "http://x.example.org/en/1?utm_source=a", "http://x.example.org/en/2", "http://com/fr/",
    "http://a.com/de/x#y", "http://acom/de/x", "http://a.com/x?ref=1", "http://a.com/x?xref=1",
    "http://a.com/x#?ref=1", "http://a.net/?a=b&gclid", "a://b://c.org/d", "http://c.org/d",
    "http://c.org/d", "http://u@h.org:80/p;q?z", "http://" + "a." * 500 + "org/" + "p" * 5000,
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, rest = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        cut = min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])
        path = rest[:cut]
    fits = []
    for rule, verdict in u.DEFAULT.verdicts:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, *max(fits)[1:]
    query = (url or "").split("#")[0].partition("?")[2]
    names = {part.split("=")[0] for part in query.split("&")}
    return host, path, None, "block" if names & set(u.DEFAULT.tracking) else "allow"


def test_judged_urls(spark):
    pages = spark.createDataFrame(
        [(i, url, "h", "k") for i, url in enumerate(URLS)],
        "page_id long, url string, html string, key string",
    )
    found = {r.page_id: tuple(r)[1:] for r in u.judge_urls(pages).collect()}
    assert found == {i: plain(url) for i, url in enumerate(URLS)}
    assert u.judge_urls(pages.limit(0)).count() == 0


@pytest.mark.parametrize("listed", [0, 1, 40, 300])
def test_cascade_is_exact(spark, listed):
    every = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    on = every.limit(listed).union(spark.createDataFrame([("absent",)], "key string"))
    cascade = u.build_cascade(every, on)
    found = {r.key for r in every.filter(cascade.lists(F.col("key"))).collect()}
    assert found == {f"k{i}" for i in range(listed)}


def test_cascade_of_a_long_list_is_exact(spark):
    every = spark.range(500_000).select(F.col("id"), F.concat(F.lit("k"), "id").alias("key"))
    on = every.filter(F.pmod(F.xxhash64("id"), F.lit(5)) < 2).select("key")
    cascade = u.build_cascade(every.select("key"), on)
    assert 2 < len(cascade.levels) < 20
    marked = every.select(
        cascade.lists(F.col("key")).alias("found"),
        (F.pmod(F.xxhash64("id"), F.lit(5)) < 2).alias("listed"),
    )
    counts = {(r.found, r.listed): r["count"] for r in marked.groupBy("found", "listed").count().collect()}
    assert set(counts) == {(True, True), (False, False)}
    assert counts[True, True] > 190_000


def test_a_level_has_its_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    level = u.bloom_level(keys.filter("key < '5'"), 12_000, 2.0**-8, 3)
    assert max(level.data) < 128
    passed = keys.filter(level.has(F.col("key"))).groupBy((F.col("key") < "5").alias("own")).count()
    counts = {r.own: r["count"] for r in passed.collect()}
    assert counts[True] == keys.filter("key < '5'").count()
    assert counts.get(False, 0) < 20_000 * 2.0**-6
