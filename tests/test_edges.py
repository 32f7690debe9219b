"""Hand-made edge cases (the fixtures' edge rows) and the reference's unit-test examples."""

import math
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scoring as S
from ledgerlens.functions.stats import t_quantile, t_two_sided_p
from ledgerlens.functions.timefix import fix_hour_24
from ledgerlens.operators import cleaning as C
from ledgerlens.operators import evaluation as EV
from ledgerlens.operators import labels as L
from ledgerlens.operators.joins import FeatureView, latest_per_key, point_in_time_join, broadcast_if_small
from ledgerlens.session import scratch_path
from ledgerlens.sources.files import read_transactions


def test_hour_24_on_month_end(spark):
    df = spark.createDataFrame([("2019-08-31 24:00:00",), ("2019-12-31 24:15:30",), ("2019-08-22 13:01:02",),
                                ("garbage",)], "s string")
    got = [r[0] for r in df.select(fix_hour_24("s")).collect()]
    assert got == [datetime(2019, 9, 1, 0, 0, 0), datetime(2020, 1, 1, 0, 15, 30), datetime(2019, 8, 22, 13, 1, 2), None]


def test_reader_header_short_line_and_empty_field(spark):
    path = scratch_path(spark, "edge-text")
    lines = ["# transaction_id | tx_datetime | customer_id",      # one-field header: malformed
             "transaction_id,tx_datetime,customer_id,terminal_id,tx_amount,tx_time_seconds,tx_time_days,tx_fraud,tx_fraud_scenario",
             "1,2019-08-22 06:51:03,0,711,70.91,24663,0,0,0",
             "2,2019-08-22 05:10:37,0,0,,18637,0,0,0",             # empty amount -> null
             "3,2019-08-22 07:21:33,1,0"]                           # short line
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    df = read_transactions(spark, path)
    rows = sorted(df.collect(), key=lambda r: r.transaction_id)
    assert [r.transaction_id for r in rows] == [1, 2]
    assert rows[1].tx_amount is None
    assert C.drop_na(df).count() == 1
    # the same answer whatever columns are read
    assert df.select("transaction_id").count() == 2


def test_sigma_zero_and_null_columns_are_skipped(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(20)] + [(1000.0, 5.0)], "x double, c double")
    kept = C.sigma_filter(df).collect()
    assert len(kept) == 20 and all(r.c == 5.0 for r in kept)
    one = spark.createDataFrame([(1.0, 2.0)], "x double, c double")   # sigma null with one row
    assert C.sigma_filter(one).count() == 1


def test_pit_edges(spark):
    t = datetime(2024, 1, 10, 12, 0, 0)
    feats = spark.createDataFrame([
        (1, t, 10.0, 1),                       # exactly at the event time: counts
        (1, t, 11.0, 2),                       # same time, larger tie-breaker wins
        (2, t - timedelta(days=2), 20.0, 3),   # exactly event time - TTL: counts
        (3, t - timedelta(days=2, seconds=1), 30.0, 4),  # older than TTL: null
        (4, t + timedelta(seconds=1), 40.0, 5),          # after the event: null
        (5, t - timedelta(days=1, hours=5), 50.0, 6),    # earlier bucket within TTL
    ], "customer_id int, ts timestamp_ntz, amount double, id int")
    ents = spark.createDataFrame([(k, t) for k in range(1, 7)], "customer_id int, event_timestamp timestamp_ntz")
    v = FeatureView("v", feats, ["customer_id"], "ts", ["amount"], ttl=timedelta(days=2), tie_breaker="id")
    got = {r.customer_id: r.amount for r in point_in_time_join(ents, [v]).collect()}
    assert got == {1: 11.0, 2: 20.0, 3: None, 4: None, 5: 50.0, 6: None}


def test_latest_per_key_window(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, 1.0, 1), (1, t + timedelta(hours=1), 2.0, 2), (1, t + timedelta(hours=2), 3.0, 3)],
                               "k int, ts timestamp_ntz, v double, id int")
    r = latest_per_key(df, ["k"], "ts", ["v"], "id", start=t, end=t + timedelta(hours=1)).collect()
    assert [(x.k, x.v) for x in r] == [(1, 2.0)]


def test_no_positive_labels_fall_back(spark):
    df = spark.createDataFrame([(i, float(i), 0, 0) for i in range(200)],
                               "transaction_id long, tx_amount double, tx_fraud int, tx_fraud_scenario int")
    out = L.prepare_labels(df, exact=True)
    srcs = {r.label_source for r in out.select("label_source").distinct().collect()}
    assert srcs == {"synthetic"}
    assert out.filter("tx_fraud = 1").count() >= 4          # the top 2 % by amount at least
    scen = df.withColumn("tx_fraud_scenario", (F.col("transaction_id") % 7 == 0).cast("int"))
    out2 = L.prepare_labels(scen)
    assert {r.label_source for r in out2.select("label_source").distinct().collect()} == {"scenario"}
    with pytest.raises(ValueError):
        L.check_labels(df)


def test_threshold_scorer_reference_examples(spark):
    df = spark.createDataFrame([("tx_1", 50.0, 0), ("tx_2", 5000.0, 1)], "transaction_id string, tx_amount double, s int")
    got = {r.transaction_id: (r.f, r.p) for r in df.select(
        "transaction_id", S.threshold_is_fraud("tx_amount", "s").alias("f"),
        S.threshold_probability(S.threshold_is_fraud("tx_amount", "s")).alias("p")).collect()}
    assert got == {"tx_1": (False, 0.2), "tx_2": (True, 0.8)}


def test_request_validation_rejects_bad_requests(spark):
    df = spark.createDataFrame([
        ("ok", 1, 2, 150.0, 10, 1, 0), ("no_terminal", 1, None, 150.0, 10, 1, 0),
        ("negative", 1, 2, -100.0, 10, 1, 0), ("zero", 1, 2, 0.0, 10, 1, 0)],
        "transaction_id string, customer_id int, terminal_id int, tx_amount double, tx_time_seconds int, "
        "tx_time_days int, tx_fraud_scenario int")
    got = {r.transaction_id: r.v for r in df.select("transaction_id", F.array_join(S.request_violations(), ",").alias("v")).collect()}
    assert got == {"ok": "", "no_terminal": "terminal_id:missing", "negative": "tx_amount:gt_0", "zero": "tx_amount:gt_0"}


def test_balance_and_reply_fields(spark):
    df = spark.createDataFrame([(2000.0, 3, 1000.0), (10.0, 12, 10000.0)], "a double, h int, b double")
    got = [round(r[0], 6) for r in df.select(S.balance_risk_score("a", "h", "b")).collect()]
    assert got == [0.95, 0.0]
    p = spark.createDataFrame([(0.75,), (0.4,), (0.1,), (1.3,)], "p double")
    bands = [r[0] for r in p.select(S.risk_band("p")).collect()]
    assert bands == ["high", "medium", "low", "high"]
    cb = p.select(S.confidence_binary("p").alias("c")).collect()
    assert cb[3].c.probability == 1.0 and cb[3].c.is_fraud and cb[3].c.confidence == 1.0


def _t_p_by_integration(t, v, n=20000):
    """Two-sided p by Simpson integration of the Student-t density (independent of the series)."""
    if t == 0:
        return 1.0
    c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    f = lambda x: c * (1 + x * x / v) ** (-(v + 1) / 2)
    h = t / n
    s = f(0) + f(t) + sum((4 if i % 2 else 2) * f(i * h) for i in range(1, n))
    return 1 - 2 * s * h / 3


def test_t_distribution_against_known_values(spark):
    df = spark.createDataFrame([(2.0, 10), (1.0, 1), (2.5, 3), (0.0, 198), (2.6, 198)], "t double, df int")
    got = [r[0] for r in df.select(t_two_sided_p(F.col("t"), F.col("df"))).collect()]
    want = [_t_p_by_integration(t, v) for t, v in [(2.0, 10), (1.0, 1), (2.5, 3), (0.0, 198), (2.6, 198)]]
    assert all(abs(a - b) < 1e-8 for a, b in zip(got, want)), (got, want)
    known = {1: 12.7062047362, 2: 4.3026527297, 3: 3.1824463053, 10: 2.2281388520, 30: 2.0422724563, 99: 1.9842169515}
    q = spark.createDataFrame([(v,) for v in known], "df int").select("df", t_quantile(0.975, F.col("df")).alias("t")).collect()
    assert all(abs(r.t - known[r.df]) < 1e-8 for r in q), q


def test_bootstrap_against_brute_force(spark):
    """Replicates from the drawn weight of each row: a cell's weight is drawn as one, its rows' cells are counted here."""
    from collections import Counter
    rows = [(i, int(i % 3 == 0), float(i % 4 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, y int, p double")
    got = {r.replicate: r for r in EV.bootstrap_metrics(df, "y", {"m": "p"}, n_iter=5, seed=7).collect()}
    cells = Counter((y, int(p >= 0.5)) for _, y, p in rows)
    drawn = spark.createDataFrame([(f"{y}{p}", n, r) for (y, p), n in cells.items() for r in range(5)], "c string, n long, r int")
    w = {(x.c, x.r): x.w for x in drawn.select("c", "r", EV.cell_weight(F.col("n"), F.col("c"), F.col("r"), 7).alias("w")).collect()}
    for rep in range(5):
        f1 = 2 * w["11", rep] / (2 * w["11", rep] + w["01", rep] + w["10", rep])
        assert abs(got[rep].f1 - f1) < 1e-12


def test_small_cells_add_up_single_draws(spark):
    import hashlib
    from ledgerlens.functions.hashing import SMALL_MEAN, poisson1_cdf
    cdf = poisson1_cdf()
    df = spark.createDataFrame([(n, r) for n in range(SMALL_MEAN) for r in range(20)], "n long, r int")
    for x in df.select("n", "r", EV.cell_weight(F.col("n"), F.lit("c"), F.col("r"), 7).alias("w")).collect():
        u = [int(hashlib.md5(f"c:{x.r}:{i}:7".encode()).hexdigest()[:8], 16) / 4294967296.0 for i in range(1, x.n + 1)]
        assert x.w == sum(next((i for i, c in enumerate(cdf[:-1]) if v < c), 20) for v in u)


@pytest.mark.parametrize("n", [1, 3, 9, 10, 11, 49, 50, 400, 10**6, 10**9])
def test_cell_weights_are_poisson(spark, n):
    """Mean, variance and tails of 20,000 draws, and for small means every probability (within 5 standard errors)."""
    from collections import Counter
    size = 20_000
    df = spark.range(size).withColumn("i", F.col("id").cast("int"))
    w = [r[0] for r in df.select(EV.cell_weight(F.lit(n).cast("bigint"), F.lit("c"), F.col("i"), 1)).collect()]
    mean = sum(w) / size
    var = sum((x - mean) ** 2 for x in w) / (size - 1)
    assert abs(mean - n) < 4 * (n / size) ** 0.5
    assert abs(var / n - 1) < 4 * ((2 + 1 / n) / size) ** 0.5
    log_p = lambda k: k * math.log(n) - n - math.lgamma(k + 1)
    if n <= 400:
        seen, p = Counter(w), {k: math.exp(log_p(k)) for k in range(n + 12 * int(n**0.5 + 2))}
        for cut in ([k for k in p if p[k] * size > 20] + [n - 2 * int(n**0.5), n + 2 * int(n**0.5)]):
            for got, want in ((seen[cut], p.get(cut, 0)), (sum(c for k, c in seen.items() if k > cut), sum(x for k, x in p.items() if k > cut))):
                assert abs(got / size - want) <= 5 * (want * (1 - want) / size) ** 0.5 + 1e-9, (cut, got, want * size)
    else:
        z = [(x - n) / n**0.5 for x in w]
        for cut, tail in ((1.0, 0.1586553), (2.0, 0.0227501), (3.0, 0.0013499)):
            for got in (sum(x > cut for x in z), sum(x < -cut for x in z)):
                assert abs(got / size - tail) < 5 * (tail / size) ** 0.5, (cut, got)


def test_auc_score_against_pairs(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = EV.eval_auc_score(df, "y", "s", levels=4).collect()[0][0]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y != 1]
    want = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-6


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    big = spark.range(10).withColumn("x", F.lit("x" * 100))
    assert "broadcast" in str(broadcast_if_small(small, 10**9)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(broadcast_if_small(big, 1)._jdf.queryExecution().logical()).lower()


def test_approx_percentile_rank_error_within_one_percent(spark):
    import random
    from ledgerlens.operators.aggregates import approx_percentile, exact_quantile
    rnd = random.Random(5)
    vals = [rnd.lognormvariate(3, 1) for _ in range(20000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = approx_percentile(df, "x", 0.98, 0.01).collect()[0][0]
    srt = sorted(vals)
    rank = sum(1 for v in srt if v <= a) / len(srt)
    assert abs(rank - 0.98) <= 0.01
    ex = exact_quantile(df, "x", 0.98).collect()[0][0]
    pos = 0.98 * (len(srt) - 1)
    lo, hi = int(pos), min(int(pos) + 1, len(srt) - 1)
    assert abs(ex - (srt[lo] + (srt[hi] - srt[lo]) * (pos - lo))) < 1e-9


def test_exact_quantile_groups_and_ties(spark):
    from ledgerlens.operators.aggregates import exact_quantile
    rows = [("a", float(v)) for v in [1, 1, 1, 2, 10]] + [("b", 5.0)] + [("c", float(v)) for v in range(100)]
    got = {r.g: r.q for r in exact_quantile(spark.createDataFrame(rows, "g string, v double"), "v", 0.5, ["g"],
                                             levels=2, name="q").collect()}
    assert got == {"a": 1.0, "b": 5.0, "c": 49.5}


def test_clustered_values_spread_over_buckets_and_stay_exact(spark):
    """Scores piled up near 0 plus one far outlier (a fraud model's shape): equal-width slices would put almost
    every distinct score into one slice; the equi-depth buckets keep each bucket small and results exact."""
    import random
    from ledgerlens.operators.aggregates import exact_quantile, quantile_edges, rank_buckets
    rnd = random.Random(11)
    rows = [(1 if rnd.random() < 0.1 else 0, rnd.random() * 1e-6) for _ in range(3000)] + [(1, 1e6)]
    df = spark.createDataFrame(rows, "y int, s double")
    edges = df.agg(quantile_edges(F.col("s"), 6).alias("e")).scalar()
    sizes = [r["count"] for r in rank_buckets(df, "s", edges, 6).groupBy("_bk").count().collect()]
    assert max(sizes) <= 4 * len(rows) / 64
    got = EV.eval_auc_score(df, "y", "s", levels=6).collect()[0][0]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y != 1]
    want = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(got - round(want, 6)) < 1e-9
    srt = sorted(s for _, s in rows)
    p = 0.5 * (len(srt) - 1)
    lo = int(p)
    want_q = srt[lo] + (srt[lo + 1] - srt[lo]) * (p - lo)
    assert abs(exact_quantile(df, "s", 0.5, levels=6).collect()[0][0] - want_q) < 1e-18


def test_exact_quantiles_in_one_pass_match_numpy(spark):
    import numpy as np
    from ledgerlens.operators.aggregates import exact_quantiles
    rng = np.random.default_rng(4)
    g = rng.choice(["hot", "b", "c"], size=5000, p=[0.8, 0.1, 0.1])
    v = np.round(rng.lognormal(2, 1.5, size=5000), 1)           # many ties
    df = spark.createDataFrame([(str(a), float(b)) for a, b in zip(g, v)], "g string, v double")
    qs = [(0.0, "q0"), (0.25, "q25"), (0.5, "q50"), (0.98, "q98"), (1.0, "q100")]
    got = {r.g: r for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    for key in ("hot", "b", "c"):
        vals = v[g == key]
        for q, name in qs:
            assert abs(got[key][name] - float(np.quantile(vals, q))) < 1e-9, (key, name)


def test_sample_n_is_the_top_n_of_the_draw(spark):
    from tests.conftest import SF_SMALL
    from ledgerlens.functions.hashing import uniform
    from ledgerlens.sources import testdata as T
    tx = T.transactions(spark, SF_SMALL)
    total = tx.count()
    for n in (0, 1, 37, 500, total, total + 10):
        want = {r.transaction_id for r in tx.orderBy(uniform("transaction_id", 42), "transaction_id").limit(n).collect()}
        for buckets in (2, 64, 1024):
            out = L.sample_n(tx, n, "transaction_id", 42, buckets=buckets)
            got = [r.transaction_id for r in out.collect()]
            assert len(got) == len(set(got)) == min(n, total) and set(got) == want
            assert out.columns == tx.columns


def test_reader_equals_drop_malformed(spark):
    from ledgerlens.schemas import TRANSACTION_SCHEMA
    path = scratch_path(spark, "malformed")
    good = '1,2019-08-22 06:51:03,0,711,70.91,24663,0,0,0'
    lines = [good, good.replace("70.91", "abc"), good.replace("2019-08-22 06:51:03", '"2019-08-22, 06:51:03"'), good + ",9",
             "1,2", "", good.replace("70.91", ""), "x" + good, good.replace("711", "7.5"), '"' + good + '"', good.replace("0,711", ",")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    want = spark.read.schema(TRANSACTION_SCHEMA).option("mode", "DROPMALFORMED").option(
        "columnPruning", "false").csv(path).filter("transaction_id IS NOT NULL")
    key = lambda r: str(tuple(r))
    got = read_transactions(spark, path)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == len(got.collect()) == got.select("tx_fraud").count() and key


def test_months_udf_matches_native_floor(spark):
    from ledgerlens.functions.timefix import to_months_native, to_months_udf
    df = spark.createDataFrame([(0,), (31536000000 * 12 - 1,), (31536000000 * 12,), (987654321012345,), (-5,)],
                               "ms long")
    got = df.select(to_months_udf()(F.col("ms")).alias("u"), to_months_native("ms").alias("n")).collect()
    assert all(r.u == r.n for r in got)
    assert [r.u for r in got] == [0, 0, 1, 987654321012345 // 31536000000 // 12, -1]
