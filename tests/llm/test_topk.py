"""Top-k search against all inner products."""

import numpy as np
import pytest

from ledgerlens.llm import topk
from tests.conftest import SF_SMALL


def brute(ids, rows, query, own, k):
    s = sorted((-int(np.dot(query, r)), i) for i, r in zip(ids, rows) if i != own)[:k]
    return [(i, -x) for x, i in s]


@pytest.mark.parametrize("seed,low,high,zero", [(1, -5, 5, 0.5), (2, -200, 200, 0), (3, 0, 3, 0.9), (4, -9, 0, 0.3),
                                                (5, -1, 2, 0.8), (6, -10**9, 10**9, 0.1)])
def test_shard_equals_brute_force(seed, low, high, zero, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "FIRST", 10)
    r = np.random.default_rng(seed)
    rows = r.integers(low, high + 1, (700, 16)) * (r.random((700, 16)) >= zero)
    rows[100:140] = rows[7]
    ids = r.permutation(10_000)[:700]
    shard = topk.Shard(ids, list(rows))
    for q in [0, 7, 120, 333, 699]:
        for k in (1, 5, 900):
            got = shard.search(rows[q], ids[q], k)
            assert list(zip(got[0].tolist(), got[1].tolist())) == brute(ids, rows, rows[q], ids[q], k)


def test_shards_and_blocks_merge(spark):
    src = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    v = topk.floor_vectors(src, "vec_id", "embedding")
    got = topk.search(v, v.filter("vec_id % 50 = 0"), shard_rows=100, query_rows=4)
    rows = [(r.query_id, r["rank"], r.vec_id, r.score) for r in got.orderBy("query_id", "rank").collect()]
    data = {r.vec_id: np.array(r.vector) for r in v.collect()}
    want = [(q, n + 1, i, s) for q in sorted(data) if q % 50 == 0
            for n, (i, s) in enumerate(brute(data, data.values(), data[q], q, 5))]
    assert rows == want


def test_nulls_ties_repeats_empty(spark):
    rows = spark.createDataFrame(
        [(0, [1.0, None], 1), (50, None, 1), (100, [0.5, float("nan")], 1), (150, [0.5, 0.5], 1), (None, [1.0, 1.0], 1),
         (1, [0.25, 0.0], 1), (2, [0.25, 0.0], 1), (3, [0.0, 0.25], 1), (200, [], 1), (4, [float("inf"), 1.0], 1),
         (5, [-0.001, 0.0], 1)], "vec_id long, embedding array<double>, score int")
    v = topk.floor_vectors(rows, "vec_id", "embedding")
    got = topk.search(v, v.filter("vec_id % 50 = 0"), k=4).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got if r.query_id == 150] == [
        (150, 1, 1, 8192), (150, 2, 2, 8192), (150, 3, 3, 8192), (150, 4, 200, 0)]
    assert {r.query_id for r in got} == {150, 200}
    assert [r.vec_id for r in got if r.query_id == 200] == [1, 2, 3, 5]
    one = v.filter("vec_id = 150")
    assert topk.search(one, one).collect() == []
    assert topk.search(v.limit(0), v.limit(0)).collect() == []


@pytest.mark.parametrize("first", [16, 256])
def test_more_rows_of_the_query_s_id_than_k(monkeypatch, first):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "FIRST", first)
    ids = np.array([7] * 60 + list(range(100, 110)) + list(range(200, 300)))
    rows = np.array([[10, 10]] * 60 + [[5, 5]] * 10 + [[0, 1]] * 50 + [[1, 1]] * 50)
    for order in (np.arange(len(ids)), np.random.default_rng(1).permutation(len(ids))):
        got = topk.Shard(ids[order], list(rows[order])).search(np.array([10, 10]), 7, 5)
        assert list(zip(*(x.tolist() for x in got))) == [(100 + i, 100) for i in range(5)]


def test_scores_that_do_not_fit():
    rows = [np.array(v) for v in ([2**62, 1], [-2**63, 0], [4, 4], [2**62, 2])]
    got = topk.Shard(np.arange(4), rows).search(np.array([5, 1]), 9, 4)
    assert list(zip(*(x.tolist() for x in got))) == [(0, topk.TOP), (3, topk.TOP), (2, 24), (1, -topk.TOP)]
