"""Toxicity: held-out accuracy, features by hand, and edge rows."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.toxicity import (FEATURES, Lexicon, features, fit, held_out, learned_lexicon, op1_toxicity_gbt,
                                     word_parts)

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    df = op1_toxicity_gbt(spark, SF).cache()
    yield df
    df.unpersist()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    x = scored.filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    rank, pos = x.score.rank(), int(x.toxic.sum())
    auc = (rank[x.toxic == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(x) - pos))
    assert auc > 0.9
    assert ((x.predicted == 1) & (x.toxic == 0)).sum() <= 0.01 * len(x)
    assert ((x.predicted == 1) & (x.toxic == 1)).sum() >= 0.7 * pos


def test_rows_and_range(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert scored.count() == docs.count() == scored.select("doc_id").distinct().count()
    assert scored.filter("score IS NULL OR score < 0 OR score > 1 OR predicted <> int(score >= 0.7)").count() == 0
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored.limit(500).collect())


def test_features():
    lex = Lexicon({"foul*": 3.0, "meh": 1.0})
    f = dict(zip(FEATURES, features("You fouled IT! Meh, id1ot you?? aaab", lex)))
    assert f["insults"] == 0 and f["learned_max"] == 3.0 and f["near_you"] == pytest.approx(2 / 8)
    assert f["obfuscated_insults"] > 0 and f["repeats"] > 0 and f["capital_words"] > 0
    assert features("", lex) == features(" 12 !", lex) == [0.0] * len(FEATURES)
    assert word_parts("ab") == ["ab"] and word_parts("abcd") == ["abcd", "abc*", "abcd*"]


def test_lexicon_is_bounded(spark):
    rows = [(f"w{i % 7}x good", 0, 0) for i in range(200)] + [(f"w{i % 7}x grumfle{i % 5}", 1, 0) for i in range(60)]
    df = spark.createDataFrame(rows, "text string, y int, part int")
    lex = learned_lexicon(df, size=3)
    assert len(lex) == 3 and set(lex) <= {"gru*", "grum*", "grumf*", "grumfl*"}


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "word " * 100_000, "x")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    model = fit(docs, labels)
    got = [(r.doc_id, r.score) for r in model.score(docs).collect()]
    assert len(got) == 4 and {s for _, s in got} == {1.0}           # one class only: the share of toxic rows
    assert [r.score for r in fit(docs, labels.limit(0)).score(docs).collect()] == [0.0] * 4
    assert model.score(docs.limit(0)).collect() == []
    assert [r[0] for r in docs.select(held_out(F.col("doc_id"))).collect()][0] is False


def test_one_shouted_sentence_in_a_long_text():
    calm = "the weather was fine and we went home early " * 40
    f = dict(zip(FEATURES, features(calm + "YOU ARE AWFUL SHUT UP NOW \u00c9COUTEZ", Lexicon({}))))
    assert f["capital_words"] == pytest.approx(7 / (9 * 40 + 7))
    assert dict(zip(FEATURES, features(calm, Lexicon({}))))["capital_words"] == 0


def test_repeated_rows_and_long_texts(spark):
    from ledgerlens.llm.toxicity import ToxicityModel, dense
    rows = [(1, "you fool"), (1, "you fool"), (None, "you fool"), (2, "calm " * 300_000 + "FOOL"), (3, None), (4, "")]
    df = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    lex = {"fool": 2.0}
    got = sorted(((r.doc_id, r.x) for r in dense(df, lex).collect()), key=str)
    assert got == sorted(((i, features(t or "", Lexicon(lex))) for i, t in rows), key=str)
    assert sorted(map(tuple, ToxicityModel(lex, constant=0.25).score(df).collect()), key=str) == sorted(
        ((i, 0.25) for i, _ in rows), key=str)
    assert ToxicityModel(lex).score(df.limit(0)).collect() == []
