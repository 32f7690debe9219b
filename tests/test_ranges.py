"""Range functions against plain versions: restarts, gaps, late and repeated samples, merged histograms."""

import math
import random

import pytest

from ledgerlens.operators import ranges as R

STEP = 60
MINUTE = "timestamp_seconds({})"


def plain(samples, seconds, kind):
    """{(key, step): (samples, result)} from every range by itself."""
    series = {}
    for k, t, v in samples:
        if t is not None and v is not None:
            series.setdefault(k, {})[t] = max(v, series.get(k, {}).get(t, v))
    last = max((math.ceil(t / STEP) for s in series.values() for t in s), default=0)
    out = {}
    for k, s in series.items():
        for b in range(math.ceil(min(s) / STEP), last + 1):
            seen = [v for t, v in sorted(s.items()) if b * STEP - seconds < t <= b * STEP]
            if seen:
                pairs = list(zip(seen, seen[1:]))
                out[k, b] = (len(seen), sum((n - p if n >= p else n) if kind == "increase" else n != p for p, n in pairs))
    return out


def frame(spark, samples):
    df = spark.createDataFrame(samples, "key string, t double, value double")
    return df.selectExpr("key", "timestamp_micros(cast(round(t * 1e6) AS bigint)) AS ts", "value")


def history(seed, n=400):
    r = random.Random(seed)
    rows = []
    for k in ("a", "b", None):
        t, v = r.uniform(0, 500), 0.0
        for _ in range(n):
            t += r.choice([0.5, 5, 20, 60, 61, 200, 3000]) if k != "a" else 7
            v = 0.0 if r.random() < 0.05 else v + r.choice([0, 0, 1, 5])
            if r.random() < 0.9:
                rows.append((k, t, v))
            if r.random() < 0.1:
                rows.append((k, t, v / 2))
    rows += [("a", None, 1.0), ("a", 40.0, None), ("only", 60.0, 3.0), ("edge", 120.0, 1.0), ("edge", 180.0, 4.0), ("edge", 240.0, 2.0)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seconds", [60, 300, 900])
@pytest.mark.parametrize("kind", ["increase", "changes"])
def test_ranges_equal_plain_ones(spark, seconds, kind):
    rows = history(seconds)
    got = R.over_range(frame(spark, rows), "ts", "value", ["key"], seconds, STEP, kind).selectExpr(
        "key", f"unix_seconds(CAST(evaluated_at AS timestamp)) div {STEP} AS b", "samples", kind).collect()
    assert {(r.key, r.b): (r.samples, r[kind]) for r in got} == plain(rows, seconds, kind)
    assert len(got) == len({(r.key, r.b) for r in got})


def test_rate_and_empty(spark):
    rows = [("a", 10.0, 5.0), ("a", 70.0, 11.0), ("a", 130.0, 2.0)]
    got = R.increase(frame(spark, rows), "ts", "value", ["key"], 120, STEP).orderBy("evaluated_at").collect()
    assert [(r.increase, r.rate_per_s) for r in got] == [(0, 0), (6, 0.05), (2, 2 / 120)]
    assert R.increase(frame(spark, rows).limit(0), "ts", "value", ["key"], 120, STEP).collect() == []
    with pytest.raises(ValueError):
        R.increase(frame(spark, rows), "ts", "value", ["key"], 90, STEP)


def test_share(spark):
    part = spark.sql("SELECT timestamp'2024-01-01' AS evaluated_at, 'x' AS k, 3.0D AS increase")
    whole = spark.sql("""SELECT * FROM VALUES (timestamp'2024-01-01', 'x', 4.0D), (timestamp'2024-01-01', 'x', 2.0D),
        (timestamp'2024-01-02', 'x', 0.0D), (timestamp'2024-01-03', 'x', 8.0D) AS t(evaluated_at, k, increase)""")
    got = R.share(part, whole, ["k"]).orderBy("evaluated_at").collect()
    assert [(r.part, r.whole, r.pct) for r in got] == [(3, 6, 50), (0, 0, None), (0, 8, 0)]


def quantile(spark, rows, q=0.95):
    df = spark.createDataFrame([(k, float(le), float(v)) for k, le, v in rows], "k string, le double, value double")
    return {r.k: (r.observations, r.quantile) for r in R.histogram_quantile(df, q, ["k"]).collect()}


def test_histogram_quantile_by_hand(spark):
    inf = float("inf")
    rows = [("mid", 1, 10), ("mid", 2, 100), ("mid", inf, 100), ("first", 1, 100), ("first", inf, 100), ("last", 1, 1), ("last", inf, 100),
            ("none", 1, 0), ("none", inf, 0), ("open", 1, 5), ("below", -1, 100), ("below", 1, 100), ("below", inf, 100),
            ("falls", 1, 50), ("falls", 2, 40), ("falls", 4, 100), ("falls", inf, 100), ("only", inf, 7),
            ("two", 1, 10), ("two", inf, 10), ("two", 1, 0), ("two", 2, 10), ("two", inf, 10)]
    got = quantile(spark, rows)
    assert got["mid"] == (100, pytest.approx(1 + 85 / 90)) and got["first"] == (100, pytest.approx(0.95))
    assert got["last"] == (100, 1) and got["none"] == (0, None) and got["open"] == (None, None) and got["below"] == (100, -1)
    assert got["falls"] == (100, pytest.approx(2 + 2 * 45 / 50)) and got["only"] == (7, 0)
    assert quantile(spark, [("m", 1, 10), ("m", 2, 10), ("m", 1, 0), ("m", 2, 10), ("m", inf, 20)], 0.75)["m"] == (20, pytest.approx(1.5))


def test_quantile_lies_in_the_bucket_of_the_exact_one(spark):
    """Raw durations of random windows, some on a bound, some above all, some windows empty."""
    r, bounds = random.Random(8), [0.1, 0.25, 0.5, 1.0, 2.5, 5.0, float("inf")]
    rows, exact = [], {}
    for w in range(60):
        raw = sorted(r.choice([r.expovariate(1.5), r.choice(bounds[:6]), 9.0]) for _ in range(r.choice([0, 1, 2, 7, 100])))
        for m in range(3):                                      # dealt to three machines, merged again
            rows += [(str(w), b, sum(x <= b for x in raw[m::3])) for b in bounds]
        exact[str(w)] = raw[math.ceil(0.95 * len(raw)) - 1] if raw else None
    for k, (n, q) in quantile(spark, rows).items():
        if exact[k] is None:
            assert (n, q) == (0, None)
            continue
        up = next(b for b in bounds if exact[k] <= b)
        low = ([0.0] + bounds)[bounds.index(up)]
        assert q == 5.0 if math.isinf(up) else low < q <= up


def test_a_window_that_fires_has_held_for_its_width(spark):
    from ledgerlens.operators.monitoring import sustained_alert
    rows = spark.sql("""SELECT * FROM VALUES ('w', timestamp_ntz'2024-01-01 00:00:00', true), ('w', timestamp_ntz'2024-01-01 00:05:00', false),
        ('p', timestamp_ntz'2024-01-01 00:00:00', true), ('p', timestamp_ntz'2024-01-01 00:01:00', false) AS t(metric, ts, firing)""")
    got = {r.metric: (r.duration_seconds, r.fired) for r in
           sustained_alert(rows, "ts", "metric", 120, 300, covers_seconds={"w": 300, "p": 0}).collect()}
    assert got == {"w": (300, True), "p": (0, False)}
