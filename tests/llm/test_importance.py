"""Importance resampling against a plain version: counts, gains, weights, scores and the draw."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text, n, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n, buckets, percent, least, seed):
    s = Counter(b for _, t in docs for b in features(t, n, buckets))
    t = Counter(b for x in target for b in features(x, n, buckets))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
            for b in range(buckets)}
    rows = []
    for i, text in docs:
        f = features(text, n, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2], -r[3]))
    drawn = fit[:len(fit) * percent // 100]
    out = []
    for r in sorted(rows, key=str):
        out.append(r + ((drawn.index(r) + 1) if r in drawn else None,))
        if r in drawn:
            drawn[drawn.index(r)] = None
    return sorted(out, key=str)


def check(spark, docs, target, **kw):
    a = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, rank int")
    b = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.importance_sample(a, b, n=kw["n"], buckets=kw["buckets"], percent=kw["percent"], min_words=kw["least"],
                                       seed=7)
    assert got.columns == ["id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, seed=7, **kw)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aA bB\u00e9\u0130.1\x00\n", max_size=30)), max_size=6),
       st.integers(1, 4))
def test_features(texts, n):
    bucket, doc, n_words = importance.feature_buckets(pa.array(texts, pa.string()), n, 997)
    assert n_words.tolist() == [len(words(t)) for t in texts]
    assert sorted(zip(doc.tolist(), bucket.tolist())) == sorted((i, b) for i, t in enumerate(texts) for b in features(t, n, 997))
    assert doc.tolist() == sorted(doc.tolist())


def test_draw_matches_plain_version(spark):
    docs = [(i, " ".join(f"w{(i * j) % 17}" for j in range(i % 40))) for i in range(300)]
    docs += [(None, "w1 w2 w3 w4"), (None, "w1 w2 w3 w4"), (7, "W5 w6 w7 \u00c9t\u00e9"), (8, None), (9, ""), (10, "x " * 50_000)]
    target = ["w1 w2", "w5. W6", None, "", "w1 w2 w3"]
    for n, buckets, percent, least in ((1, 10_000, 10, 20), (3, 50, 37, 3), (2, 1000, 100, 0)):
        check(spark, docs, target, n=n, buckets=buckets, percent=percent, least=least)


def test_empty_tables(spark):
    kw = dict(n=1, buckets=100, percent=50, least=1)
    check(spark, [], ["a b"], **kw)
    check(spark, [(1, "a b"), (2, "c"), (3, None)], [], **kw)


def test_few_parts_or_many_give_the_same(spark):
    docs = spark.createDataFrame([(i, f"a{i % 7} b{i % 11} c") for i in range(500)], "doc_id long, text string")
    target = spark.createDataFrame([("a1 b2",)], "text string")
    draw = lambda df: sorted(map(tuple, importance.importance_sample(df, target, min_words=1).collect()), key=str)
    assert draw(docs.coalesce(1)) == draw(docs.repartition(9, "text"))
