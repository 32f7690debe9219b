"""Substring dedup against brute force: covers, hashes of runs, and the operator in small chunks and parts."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import repeats
from ledgerlens.session import scratch_path
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    """(id, n_words, n_removed, kept, spans) of every document."""
    words = [WORD.findall(t or "") for _, t in docs]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(docs, words):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if count[tuple(w[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        edges = [p for p in range(len(w) + 1) if (p < len(w) and gone[p]) != (p > 0 and gone[p - 1])]
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g),
                    [list(x) for x in zip(edges[::2], edges[1::2])]))
    return sorted(out, key=str)


def run(df, **kw):
    got = repeats.remove_repeats(df, **kw)
    assert got.columns == ["id", "n_words", "n_removed", "kept", "spans"]
    return sorted(((r.id, r.n_words, r.n_removed, r.kept, [list(x) for x in r.spans]) for r in got.collect()), key=str)


@pytest.mark.parametrize("period", repeats.COVERS)
def test_covers_have_every_shift(period):
    cover = repeats.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [1, 2, 3, 5, 12, 13, 35, 64, 100])
def test_equal_windows_share_an_anchor(window):
    period, cover, words = repeats.cover_for(window)
    assert words >= 1 and words + period - 1 == window
    for p in range(period):
        for q in range(period):
            assert any((p + d) % period in cover and (q + d) % period in cover for d in range(window - words + 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(1, 40))
def test_run_hashes_tell_runs_apart(values, n):
    words = repeats.mix64(np.array(values, np.uint64) + np.uint64(1))
    h = repeats.run_hashes(words, n)
    runs = [tuple(values[i:i + n]) for i in range(len(values) - n + 1)]
    assert len(h) == len(runs)
    assert len(set(h.tolist())) == len(set(runs)) == len(set(zip(h.tolist(), runs)))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\x0bé ", max_size=60), max_size=5), st.integers(1, 9), st.integers(1, 40))
def test_slices_find_every_window(texts, window, most):
    """Without Spark: windows around all anchors that stand twice hold all windows that stand twice."""
    parts = [s for _, _, s in repeats._slices(pa.array(texts, pa.string()), window, most)]
    count = Counter(h for s in parts for h in s.anchors()[1].tolist())
    found = []
    for s in parts:
        at, h = s.anchors()
        found.append(s.windows(at[np.array([count[x] > 1 for x in h.tolist()], bool)]))
    twice = Counter((a, b) for _, x, y in found for a, b in zip(x.tolist(), y.tolist()))
    got = []
    for s, (at, x, y) in zip(parts, found):
        gone = s.covered(at[np.array([twice[k] > 1 for k in zip(x.tolist(), y.tolist())], bool)])
        got += list(zip(s.sizes.tolist(), np.bincount(s.doc[gone], minlength=len(s.sizes)).tolist(), s.kept(gone)))
    assert sorted(got) == sorted((n, k, t) for _, n, k, t, _ in brute([(0, t) for t in texts], window))


def passages(seed=3):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(4000)}"
    shared = [[word() for _ in range(n)] for n in (35, 36, 34, 80, 400)]
    docs = []
    for i in range(160):
        text = [word() for _ in range(r.randrange(0, 120))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(text) + 1)
            text[at:at] = r.choice(shared)
        docs.append((i, " ".join(text)))
    docs += [docs[5], docs[5], (7, docs[9][1]), (None, docs[9][1]), (None, None), (501, None), (502, ""), (503, " \n "),
             (504, "x " * 200), (505, " ".join(["a", "b"] * 40)), (506, "\t".join(shared[3])), (507, " ".join(shared[0]).upper()),
             (508, " ".join(f"u{k}" for k in range(30_000)) + " " + " ".join(shared[4]))]
    return docs


@pytest.mark.parametrize("chunk_bytes, part_bytes", [(8 << 20, 16 << 20), (4000, 30_000)])
def test_against_brute_force(spark, chunk_bytes, part_bytes):
    docs = passages()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, chunk int, kept string")
    path = scratch_path(spark, "docs")
    df.repartition(3).write.parquet(path)
    want = brute(docs, 35)
    assert sum(x[2] > 0 for x in want) > 50
    for src in (df, spark.read.parquet(path)):
        assert run(src, chunk_bytes=chunk_bytes, part_bytes=part_bytes) == want


@pytest.mark.parametrize("window", [1, 2, 7, 50])
def test_other_windows(spark, window):
    docs = passages(4)[:60]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert run(df, window=window, chunk_bytes=20_000, part_bytes=20_000) == brute(docs, window)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert run(df) == []
    path = scratch_path(spark, "docs")
    df.write.parquet(path)
    assert run(spark.read.parquet(path)) == []
    assert run(spark.createDataFrame([(1, None)], "doc_id long, text string")) == [(1, 0, 0, "", [])]


def test_texts_are_shuffled_once(spark):
    got = repeats.remove_repeats(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1
