"""Daily quantile sketches merged for ranges, against exact ranks."""

import datetime as dt

import numpy as np
import pytest

from ledgerlens.operators.sketches import day_sketches, range_quantiles

DAYS = 12


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(5)
    shapes = [lambda n: rng.lognormal(3, 2, n), lambda n: rng.integers(0, 4, n) * 1.0, lambda n: np.sort(rng.normal(size=n)),
              lambda n: np.full(n, 7.0)]
    return {d: shapes[d % 4](3000 if d % 5 else 40) for d in range(DAYS) if d != 6}   # a day without rows


def test_every_range_is_within_one_percent(spark, values):
    rows = [(dt.datetime(2024, 1, 1 + d, i % 24), float(v)) for d, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double").repartition(7)
    day = lambda d: dt.date(2024, 1, 1 + d)
    ranges = [(a, b) for a in range(DAYS) for b in range(a, DAYS)]
    asked = spark.createDataFrame([(day(a), day(b)) for a, b in ranges] * 2, "first_day date, last_day date")
    probs = {"p1": 0.01, "p50": 0.5, "p98": 0.98}
    got = {(r.first_day, r.last_day): r for r in range_quantiles(day_sketches(df, "ts", "v"), asked, probs).collect()}
    assert len(got) == len(ranges) - 1 and (day(6), day(6)) not in got
    for a, b in ranges:
        vs = np.concatenate([values[d] for d in range(a, b + 1) if d in values] or [[]])
        if len(vs):
            r = got[day(a), day(b)]
            assert r.n == len(vs)
            for name, p in probs.items():
                assert (vs < r[name]).mean() <= p + 0.01 and (vs <= r[name]).mean() >= p - 0.01


def test_values_without_a_rank_are_left_out(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), v) for v in (1.0, 2.0, 3.0, None, float("nan"), float("inf"))]
                               + [("b", dt.datetime(2024, 1, 1), None), ("c", None, 1.0)], "g string, ts timestamp_ntz, v double")
    s = day_sketches(df, "ts", "v", ["g"])
    asked = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "first_day date, last_day date")
    assert [(r.g, r.n, r.p) for r in range_quantiles(s, asked, {"p": 0.5}, ["g"]).collect()] == [("a", 3, 2.0)]
    assert range_quantiles(s.filter("g = 'z'"), asked, {"p": 0.5}, ["g"]).count() == 0
