"""Decontamination against a plain search for the items, and hand-made templates."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import decontam
from ledgerlens.llm.decontam import NAME, NUMBER, UNIT, leaks, op10_template_leaks, plain_tokens, template_tokens
from tests.conftest import SF_ORACLE


def tokens(spark, text):
    df = spark.createDataFrame([(text,)], "x string")
    r = df.select(template_tokens(F.col("x")).alias("t"), plain_tokens(F.col("x")).alias("p")).collect()[0]
    assert len(r.t) == len(r.p)
    return r.t


def test_templates(spark):
    assert tokens(spark, "On Monday, Ann paid $3.50 for 12 miles (40%).") == [
        "on", NAME, NAME, "paid", NUMBER, "for", NUMBER, UNIT, NUMBER]
    assert tokens(spark, "He met Ann Lee. She ran 5 km in 2,000 s!  m") == [
        "he", "met", NAME, NAME, "she", "ran", NUMBER, UNIT, "in", NUMBER, UNIT, "m"]
    assert tokens(spark, " \n") == [] and tokens(spark, "a ... b") == ["a", "b"]


ITEM = "A train leaves Paris at 9:30 and runs 120 km to reach Lyon in 2 hours before it returns to Paris"


def found(spark, texts, items=(ITEM,), **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id, r.changed) for r in leaks(docs, bench, **kw).collect())


def test_parameters_and_consistency(spark):
    other = ITEM.replace("Paris", "Rome").replace("120 km", "75 miles").replace("2 hours", "1 hour")
    mixed = ITEM.replace("to Paris", "to Rome")       # Paris stands for two places
    twice = f"{ITEM}. Then some words follow here, and: {other}"
    assert found(spark, [ITEM, "x y. " + other + " z", mixed, twice, ITEM.upper(), "A train leaves.", None, ""]) == [
        (0, 0, False), (1, 0, True), (3, 0, True)]


def test_half_of_an_item(spark):
    words = [f"w{chr(97 + i)}" for i in range(24)]
    item, half = " ".join(words), " ".join(words[:16])
    less = " ".join(words[:14])
    assert found(spark, [half, less, " ".join(reversed(words))], [item]) == [(0, 0, False)]


@pytest.mark.parametrize("bits", [decontam.FILTER_BITS, 0])
def test_short_items_and_filter_size(spark, monkeypatch, bits):
    monkeypatch.setattr(decontam, "FILTER_BITS", bits)
    texts = ["so what is the red one called today", "what is the red", "is the what red one", ITEM, "a b"]
    assert found(spark, texts, ["What is the red one?", "a b", "1 2 3 4 5 6 7 8 9", None, ITEM]) == [
        (0, 0, False), (3, 4, False), (4, 1, False)]


@pytest.mark.parametrize("bits", [decontam.FILTER_BITS, 0])
def test_items_of_one_to_four_words(spark, monkeypatch, bits):
    monkeypatch.setattr(decontam, "FILTER_BITS", bits)
    texts = ["ask: What is it? and more", "what is item", "In 1984, Orwell", "in 1985 Orwell", "xylem", "xylems", "it is what"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(["What is it?", "in 1984 Orwell", "Xylem", ITEM, "..."])), "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.run, r.short) for r in leaks(docs, bench).collect())
    assert got == [(0, 0, 3, True), (2, 1, 3, True), (4, 2, 1, True)]


@pytest.mark.parametrize("bits", [decontam.FILTER_BITS, 0])
def test_a_passage_of_a_long_item(spark, monkeypatch, bits):
    monkeypatch.setattr(decontam, "FILTER_BITS", bits)
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    cut = lambda a, b: " ".join(["some", "lead", *words[a:b], "and", "so", "on"])
    texts = [cut(90, 210), cut(31, 81), cut(31, 80), cut(250, 300), cut(0, 50), cut(0, 300), cut(100, 140) + " " + cut(200, 240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = sorted((r.doc_id, r.run, r.short) for r in leaks(docs, bench).collect())
    assert got == [(0, 120, False), (1, 50, False), (3, 50, False), (4, 50, False), (5, 300, False)]


def test_rows_with_one_id_or_none_are_judged_alone(spark):
    other = ITEM.replace("Paris", "Rome").replace("120 km", "75 miles").replace("2 hours", "1 hour")
    mixed = ITEM.replace("to Paris", "to Rome")
    for i in (7, None):
        docs = spark.createDataFrame([(i, ITEM), (i, other), (i, "nothing here"), (8, mixed), (8, "x")], "doc_id long, text string")
        bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
        got = [(r.doc_id, r.item_id, r.cover) for r in leaks(docs, bench).collect()]
        assert got == [(i, 1, 1.0)]


@pytest.mark.parametrize("bits", [decontam.FILTER_BITS, 0])
def test_partly_masked_tokens(spark, monkeypatch, bits):
    """The filter must not look for what a mask leaves of a token."""
    monkeypatch.setattr(decontam, "FILTER_BITS", bits)
    items = ["he came to the U.S. when very young", "some call it code in C++ and like it",
             "most of the H2O here is from rain", "with U.S. in U.S. in U.S. in U.S."]
    texts = [*items, "nothing of the kind stands in this text", "so we heard he came to the U.S. when very young"]
    assert found(spark, texts, items) == [(0, 0, False), (1, 1, False), (2, 2, False), (3, 3, False), (5, 0, False)]


@pytest.mark.parametrize("bits", [decontam.FILTER_BITS, 0])
def test_few_plain_tokens_and_other_contexts(spark, monkeypatch, bits):
    monkeypatch.setattr(decontam, "FILTER_BITS", bits)
    items = ["Who wrote Pride and Prejudice?", "sum 12 30 7 9 and 2 4 8", "What is the capital of France?",
             "Ann, Bob, Carl Dent, Eve Frank, Gus Hall, Ira Jones"]
    texts = ["Question: Who wrote Pride and Prejudice? Answer: Jane Austen", "first sum 12 30 7 9 and 2 4 8",
             "Question: What is the capital of France?", "so, Ann, Bob, Carl Dent, Eve Frank, Gus Hall, Ira Jones too",
             "Question: What is the capital of Spain?",
             "Who wrote Crime and Punishment?", "first sum 13 31 7 9 and 2 4 8", "Paris is the capital of France"]
    assert found(spark, texts, items) == [
        (0, 0, False), (1, 1, False), (2, 2, False), (3, 3, False), (4, 2, True)]


def words_of(text):
    return re.sub(r"[^\w\s]", "", text.lower()).split()


def test_whole_table_against_search(spark):
    """Every item that stands in a document as it is must be found; nothing that shares no 8 words with it may be."""
    docs = [(r.doc_id, words_of(r.text)) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    items = {r.item_id: words_of(r.text) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()}
    index, want, some = {}, set(), set()
    for i, w in items.items():
        for k in range(len(w) - 7):
            index.setdefault(tuple(w[k:k + 8]), set()).add(i)
    for d, w in docs:
        text = " " + " ".join(w) + " "
        near = set().union(*(index.get(tuple(w[k:k + 8]), ()) for k in range(len(w) - 7))) if len(w) > 7 else set()
        some |= {(d, i) for i in near}
        want |= {(d, i) for i in near if " " + " ".join(items[i]) + " " in text}
    got = {(r.doc_id, r.item_id) for r in op10_template_leaks(spark, SF_ORACLE).collect()}
    assert want and want <= got <= some


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, ITEM, 1), (4, ITEM, 1), (4, ITEM, 1), (5, None, 1)],
                                 "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, ITEM, "x"), (1, ITEM, "x"), (None, None, "x")], "item_id long, text string, doc_id string")
    got = sorted((r.doc_id or -1, r.item_id, r.cover) for r in leaks(docs, bench).collect())
    assert got == [(-1, 1, 1.0), (4, 1, 1.0)]
    assert leaks(docs.limit(0), bench).collect() == [] and leaks(docs, bench.limit(0)).collect() == []
    long = spark.createDataFrame([(1, "word " * 200_000 + ITEM)], "doc_id long, text string")
    assert [r.doc_id for r in leaks(long, bench).collect()] == [1]
