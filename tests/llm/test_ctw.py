"""Context-tree weighting against a plain recursive one, base scores against plain counts."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import ctw
from ledgerlens.llm.ctw import DEPTH, END, PAD, grams, log_kt, op7_ctw_score, score_texts
from tests.conftest import SF_SMALL

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def symbols(text):
    data = (text or "").encode().translate(LOWER)
    full = bytes([PAD] * DEPTH) + data + bytes([END])
    for i in range(DEPTH, len(full)):
        yield full[i - DEPTH:i][::-1], full[i]          # nearest byte first


class Plain:
    """Nodes (context, bit prefix) in dicts; weighted probabilities by recursion."""

    def __init__(self, texts):
        self.n = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for t in texts:
            for context, s in symbols(t):
                for j in range(8):
                    prefix, bit = (j, s >> (8 - j)), s >> (7 - j) & 1
                    for d in range(DEPTH + 1):
                        self.n[context[:d], prefix][bit] += 1
                        if d:
                            self.children[context[:d - 1], prefix].add(context[:d])
        self.memo = {}

    def kt(self, node):
        a, b = self.n[node]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def below(self, context, prefix):
        return sum(self.weighted(c, prefix) for c in self.children.get((context, prefix), ()))

    def weighted(self, context, prefix):
        key = context, prefix
        if key not in self.memo:
            own = self.kt(key)
            self.memo[key] = own if len(context) == DEPTH else np.logaddexp(own, self.below(context, prefix)) - math.log(2)
        return self.memo[key]

    def bit(self, context, prefix, bit):
        nodes = [c for c in (context[:d] for d in range(DEPTH + 1)) if (c, prefix) in self.n]
        p, left = 0.0, 1.0
        if not nodes:
            return 0.5
        for c in nodes:
            n = self.n[c, prefix]
            own = (n[bit] + .5) / (sum(n) + 1)
            stop = 1.0 if c == nodes[-1] else 1 / (1 + math.exp(min(700, self.below(c, prefix) - self.kt((c, prefix)))))
            p, left = p + left * stop * own, left * (1 - stop)
        return p

    def score(self, text):
        return sum(math.log10(self.bit(c, (j, s >> (8 - j)), s >> (7 - j) & 1)) for c, s in symbols(text) for j in range(8))


TEXTS = ["the cat sat on the mat. The cat sat.", "The dog sat on the log", "a cat and a dog", "", "ZZZ é ñ 日本", "the the the",
         "cat", None, "x" * 300, "the cat sat on a dog and a log " * 9]


def test_scores_equal_plain_ctw(spark):
    train = [i % 3 != 2 for i in range(len(TEXTS))]
    plain = Plain([t for t, own in zip(TEXTS, train) if own])
    df = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(TEXTS, train))], "doc_id long, text string, t boolean")
    got = {r.doc_id: r for r in score_texts(df, F.col("t")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i].score == pytest.approx(plain.score(t), abs=1e-6)
        assert got[i].bits_per_byte == pytest.approx(-got[i].score * math.log2(10) / (len((t or "").encode()) + 1))


@pytest.mark.parametrize("chunk", [32 << 20, 20_000])
def test_base_scores(spark, chunk):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = score_texts(docs, ~ctw.held_out(F.col("doc_id")), chunk_bytes=chunk).toPandas().set_index("doc_id").sort_index()
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text))
             for r in docs.collect()}
    count, trained = Counter(), 0
    for d, w in words.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            count.update(w)
            trained += 1
    n, v = sum(count.values()) + trained, len(count) + 1
    for d, w in words.items():
        c = [*(count[x] for x in w), trained]
        assert out.n_tokens[d] == len(c) and out.n_known[d] == sum(x > 0 for x in c) and out.train_tokens[d] == n
        assert out.base_score[d] == pytest.approx(sum(math.log10((x + 1) / (n + v + 1)) for x in c), rel=1e-12)
    # the chunks don't change the model
    if chunk < 32 << 20:
        whole = score_texts(docs, ~ctw.held_out(F.col("doc_id"))).toPandas().set_index("doc_id").sort_index()
        assert np.allclose(whole.score, out.score, rtol=0, atol=1e-6) and (whole.n_known == out.n_known).all()


def test_held_out_texts_cost_less_than_the_base(spark):
    out = op7_ctw_score(spark, "/root/testdata/sf0.1").filter("held_out").agg(
        F.avg((F.col("score") > F.col("base_score")).cast("int")).alias("share"), F.avg("bits_per_byte").alias("b")).collect()[0]
    assert out.share > 0.75 and out.b < 2.3


def test_grams_and_kt():
    data = np.frombuffer(b"abc", np.uint8)
    codes = grams(data, np.array([0, 2, 2, 3]))
    assert len(codes) == 6 and (codes & 0xFF).tolist() == [97, 98, END, END, 99, END]
    assert [hex(int(c)) for c in codes[[1, 5]]] == ["0x61fefefefe62", "0x63fefefefeff"]
    a = np.array([0, 1, 5, 5000, 100_000])
    want = [math.lgamma(x + .5) + math.lgamma(y + .5) - math.lgamma(x + y + 1) - math.log(math.pi) for x, y in zip(a, a[::-1])]
    assert np.allclose(log_kt(a, a[::-1]), want, rtol=1e-10)


def test_edge_rows(spark):
    rows = spark.createDataFrame([(None, None, "x"), (1, "", "x"), (1, "", "y"), (2, "abc " * 50_000, None)],
                                 "doc_id long, text string, train string")
    got = sorted(((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens) for r in score_texts(rows, F.lit(None)).collect()))
    assert got == [(-1, 1, 0, 0), (1, 1, 0, 0), (1, 1, 0, 0), (2, 50_001, 0, 0)]
    r = [x for x in score_texts(rows, F.lit(False)).collect() if x.doc_id == 1][0]
    assert r.score == pytest.approx(8 * math.log10(0.5)) and r.base_score == 0.0
    assert score_texts(rows.limit(0), F.lit(True)).collect() == []
    long = {x.doc_id: x.bits_per_byte for x in score_texts(rows, F.col("doc_id") == 2).collect()}
    assert long[2] < 0.01
