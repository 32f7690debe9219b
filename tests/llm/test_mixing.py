"""Mixing: targets by hand, nearness, caps, repeatability and edge rows."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.mixing import factor, five_digits, mix, source_targets
from tests.conftest import SF_SMALL


def water_fill(totals, cap=3):
    """Share, cap and reshare until no target is above its cap."""
    names = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, target, open_ = sum(totals.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > cap * totals[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = cap * totals[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("totals", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 1, "d": 1000, "e": 5, None: 7}, {"a": 0, "b": 10, "c": 0},
    {s: 100 for s in "abcdefgh"}, {"a": 1, "b": 2, "c": 3, "d": 100, "e": 200, "f": 300, "g": 100},
    {"a": 9}, {None: 4, "Z": 50, "a": 1, "\U0001f600": 3, "￿": 3}, {"a": 0}])
def test_targets(spark, totals):
    rows = spark.createDataFrame([(s, 1, t, float(t)) for s, t in totals.items()],
                                 "source string, n long, total long, boosted double")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    assert got == pytest.approx(water_fill(totals))


def test_mix_is_near_capped_and_repeatable(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = mix(docs)
    assert out.filter("taken > 3 * size or copies < 0").count() == 0
    by = out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m"))
    for r in by.collect():
        assert abs(r.t - r.g) <= 0.05 * r.g + r.m / 2, r       # ten documents a source here
    again = mix(docs.repartition(7))
    assert sorted(out.select("doc_id", "taken").collect()) == sorted(again.select("doc_id", "taken").collect())


def test_buckets_do_not_change_the_choice_before_the_edge(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("source", F.lit("one"))
    other = docs.withColumn("source", F.lit("two")).withColumn("doc_id", F.col("doc_id") + 100_000)
    a = mix(docs.union(other), bucket_rows=20)
    b = mix(docs.union(other), bucket_rows=10**6)
    differ = a.join(b.select("doc_id", F.col("copies").alias("c")), "doc_id").filter("copies <> c")
    assert differ.count() <= 4           # at most the one that fills the gap, per source


def test_edge_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a b c", "s", 9), (1, "a b c", "s", 9), (None, None, None, 1), (2, "", "s", 1), (3, None, "t", 1),
         (4, "x " * 5000, None, 1), (5, " \t\n", "u", 1)], "doc_id long, text string, source string, target int")
    out = mix(rows)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    got = {(r.doc_id, r.source): (r["size"], r.source_size, r.taken) for r in out.collect()}
    assert out.count() == 7
    assert got[(None, None)] == (0, 5000, 0) and got[(4, None)][:2] == (5000, 5000)
    assert got[(3, "t")] == (0, 0, 0) and got[(1, "s")][:2] == (3, 6)
    assert mix(rows.limit(0)).collect() == []


def test_weights_change_the_odds(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("q", F.pmod("doc_id", F.lit(2)) * 3 + 0.1)
    out = mix(docs, weight_col="q").filter("target < source_size").groupBy((F.col("doc_id") % 2).alias("k"))
    got = {r.k: r.c for r in out.agg(F.avg("copies").alias("c")).collect()}
    assert got[1] > got[0]


@pytest.mark.parametrize("sizes, rest", [
    ({1.0: 10, 2.0: 30, 3.0: 60}, 20.0), ({1.0: 1000, 7.0: 3, 20.0: 500}, 900.0), ({4.0: 8}, 7.5), ({1.0: 0, 2.0: 5}, 2.0),
    ({0.0: 50, 2.0: 5}, 20.0), ({0.0: 50, 0.5: 5, 8.0: 5}, 7.0), ({1.0: 5}, 0.0)])
def test_factor_meets_the_words(spark, sizes, rest):
    rows = spark.createDataFrame([(sorted(sizes.items()), rest, sum(sizes.values()))],
                                 "c array<struct<boost: double, words: long>>, rest double, total long")
    p0 = rows.select(factor(F.col("c"), F.col("rest"), F.col("total")).alias("p0")).first().p0
    can = sum(w for b, w in sizes.items() if b > 0)
    assert sum(min(1.0, p0 * b) * w for b, w in sizes.items()) == pytest.approx(min(rest, can))


def test_weights_keep_five_digits(spark):
    rows = spark.createDataFrame([(float(x),) for x in [*range(64), 65, 1000, 0.1, 1e-300, float("nan"), float("inf")]] + [(None,)],
                                 "w double")
    got = [r.b for r in rows.select(five_digits(F.col("w")).alias("b")).collect()]
    assert got[:64] == [float(x) for x in range(64)] and got[64:66] == [64.0, 992.0]
    assert 0.097 < got[66] <= 0.1 and got[67:] == [0.0, 1.0, pytest.approx(1e200, rel=0.04), 1.0]


def test_ranks_follow_the_inclusion_odds(spark):
    """A thousand sources of the same documents are a thousand draws: those with p = 1 are always taken, the others as often as
    p says, within three standard errors and the words that filling up at the edge moves (at most those of one document)."""
    runs, sizes = 1002, [1] * 200 + [6] * 20 + [40] * 3
    docs = spark.range(runs * len(sizes)).select(
        F.col("id").alias("doc_id"), F.format_string("s%06d", F.floor(F.col("id") / len(sizes))).alias("source"),
        F.element_at(F.array(*(F.lit("w " * k) for k in sizes)), (F.col("id") % len(sizes) + 1).cast("int")).alias("text"))
    out = mix(docs).filter("target < source_size").groupBy("size", "target").agg(F.avg("copies").alias("share")).collect()
    assert [r.target for r in out] == [pytest.approx(220)] * 3
    p0 = (220 - 120) / (200 * 1 + 120 * 3)               # 40 words have six binary digits: certain
    for r in out:
        n = sizes.count(r["size"])
        p = {1: p0, 6: 3 * p0, 40: 1.0}[r["size"]]
        error = (p * (1 - p) / (n * runs / 3)) ** 0.5
        assert abs(r.share - p) <= (3 * error + 6 / (n * r["size"]) if p < 1 else 0), (r, p)
