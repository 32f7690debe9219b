"""URL rules and the cascade against sets."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.url_filter import Rule, build_cascade, host_and_path, judge_urls, matching_rule


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


URLS = [None, "", "x", "http://", "http://a.NET", "http://net/", "https://www.Example.net/en/1?x=/de/", "a://b://c/d",
        "http://example.net/en", "http://notexample.com/de/1", "http://m.example.com/de/", "http://x.org/fr/a#b/",
        "http://x.org?/fr/", "ftp://É.ORG/fr/é", "http://a.net\n/x\ny?z", "http://net", "HTTP://a.com/%20?ref=x"]
EXPECT = [None, None, None, None, None, "net/", "example.net/en/", None, "net/", None, "example.com/de/", "org/fr/",
          None, "org/fr/", None, None, None]


def test_hosts_paths_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "i int, url string")
    h, p = host_and_path(F.col("url"))
    got = df.select("i", h.alias("h"), p.alias("p")).withColumn("r", matching_rule(F.col("h"), F.col("p"))["name"])
    rows = got.orderBy("i").collect()
    assert [(r.h, r.p) for r in rows] == [split(u) for u in URLS]
    assert [r.r for r in rows] == EXPECT


@pytest.mark.parametrize("shard_bits", [1 << 22, 640])
def test_cascade_is_exact(spark, shard_bits):
    keys = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 3).alias("listed"))
    both = keys.union(keys).union(keys.limit(1).select(F.lit(None).alias("key"), F.lit(True).alias("listed")))
    cascade = build_cascade(both, shard_bits=shard_bits)
    assert (cascade.shards == 1) == (shard_bits > 1000) and len(cascade.paths) >= 2
    out = cascade.contains(keys.withColumn("_shard", F.lit("clash")), F.col("key"), "got")
    assert out.filter(F.col("got") != F.col("listed")).count() == 0 and out.count() == 6000


@pytest.mark.parametrize("listed", [True, False])
def test_cascade_of_all_or_none(spark, listed):
    keys = spark.range(500).select(F.col("id").cast("string").alias("key"), F.lit(listed).alias("listed"))
    out = build_cascade(keys).contains(keys, F.col("key"), "got")
    assert out.filter(F.col("got") != F.col("listed")).count() == 0


def test_edge_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "n"), (1, "http://a.com/x", "n"), (None, None, None),
                                   (2, "http://b.net/", "n")], "page_id long, url string, host string")
    keys = spark.createDataFrame([("a.com/x", True), ("b.net/", True)], "key string, listed boolean")
    rules = (Rule("net", "/", False),)
    got = judge_urls(pages, build_cascade(keys), rules)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "listed", "verdict"]
    rows = sorted(((r.page_id or 0, r.host, r.rule, r.listed, r.verdict) for r in got.collect()), key=str)
    assert rows == [(0, "", None, False, "allow"), (1, "a.com", None, True, "block"), (1, "a.com", None, True, "block"),
                    (2, "b.net", "net/", True, "allow")]
    none = build_cascade(keys.limit(0))
    assert judge_urls(pages, none, rules).filter("listed").count() == 0
    assert judge_urls(pages.limit(0), none, rules).collect() == []
