"""Hard negatives: Strassen products against numpy and Python integers, heaps and the whole operator against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import hard_negatives as hn


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 70), st.integers(0, 70), st.integers(0, 70), st.integers(0, 2**32))
def test_strassen(m, k, n, seed):
    r = np.random.default_rng(seed)
    a, b = r.integers(-10**6, 10**6, (m, k)), r.integers(-10**6, 10**6, (k, n))
    assert (hn.strassen(a, b) == a @ b).all()
    assert (hn.products(a, b) == a @ b).all()


def test_results_that_just_fit_and_that_do_not():
    a = np.zeros((40, 40), np.int64)
    a[:, 0] = 2**61
    b = np.zeros((40, 40), np.int64)
    b[0], b[0, ::2] = 3, -3
    assert (hn.products(a, b) == np.array(a.astype(object) @ b.astype(object), np.int64)).all()
    assert (hn.strassen(a, b) == a @ b).all()                # sums inside wrap, the result doesn't
    b[0] = 5
    assert (hn.products(a, b) == hn.TOP).all() and (hn.products(-a, b) == -hn.TOP).all()
    assert (hn.products(np.full((1, 1), -2**63), np.full((1, 1), 1)) == -hn.TOP).all()


def brute(rows, anchors, positives=5, negatives=3):
    out = []
    for i, la, v in dict.fromkeys(a for a in anchors if None not in a):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, lb) for j, lb, w in
                        (r for r in rows if None not in r) if j != i)
        for place, (p, pid, _) in enumerate([s for s in scored if s[2] == la][:positives]):
            fit = [s for s in scored if s[2] != la and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out += [(i, pid, rank + 1, j, -p, -s, place + 1) for rank, (s, j, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block_rows, tile", [(40, 3, (2, 7)), (16384, 4096, (256, 4096))])
def test_against_brute_force(spark, monkeypatch, shard_rows, block_rows, tile):
    monkeypatch.setattr(hn, "TILE", tile)
    r = np.random.default_rng(5)
    rows = [(int(i), int(r.integers(0, 4)), tuple(int(x) for x in r.integers(-3, 8, int(r.integers(1, 20)))))
            for i in r.permutation(200)]
    rows += rows[:9] + [(rows[0][0], 1, (1, 2)), (None, 1, (5, 5)), (1000, None, (5, 5)), (1050, 1, None), (1100, 1, ()),
                        (50, 2, (9,) * 30), (50, 3, (9,) * 30)]
    df = spark.createDataFrame([(*x, 3) for x in rows], "vec_id long, label int, vector array<long>, rank int")
    got = hn.hard_negatives(df, df.filter("vec_id % 50 = 0"), shard_rows=shard_rows, block_rows=block_rows)
    want = brute(rows, [x for x in rows if x[0] is not None and x[0] % 50 == 0])
    assert len(want) > 20
    assert sorted(map(tuple, got.collect())) == want


def test_ties_go_to_the_smaller_id(spark):
    rows = [(50, 0, (10,)), (9, 0, (10,)), (3, 0, (10,))] + [(i, 1, (9,)) for i in range(500, 400, -1)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    got = sorted(map(tuple, hn.hard_negatives(df, df.filter("vec_id = 50"), shard_rows=30).collect()))
    assert got == [(50, p, k + 1, 401 + k, 100, 90, place) for place, p in ((1, 3), (2, 9)) for k in range(3)]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, label int, vector array<long>")
    assert hn.hard_negatives(df, df).collect() == []
    one = spark.createDataFrame([(50, 1, [1])], "vec_id long, label int, vector array<long>")
    assert hn.hard_negatives(one, one).collect() == [] and hn.hard_negatives(one, df).collect() == []
