"""As-of join against a brute-force answer on random inputs: a hot key holding most rows, many small buckets (so
answers often come from an earlier bucket), equal times broken by the tie-breaker, two views with different TTLs
and the inclusive TTL edge."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from ledgerlens.operators.joins import FeatureView, broadcast_limit, point_in_time_join, point_in_time_now

T0 = datetime(2024, 3, 1)


def _random_frames(seed: int):
    rng = np.random.default_rng(seed)
    n_feat, n_ent = 400, 150
    keys = rng.choice([1, 2, 3, 4], size=n_feat, p=[0.7, 0.1, 0.1, 0.1])     # key 1 is hot
    minutes = rng.integers(0, 48 * 60, size=n_feat)
    minutes[: n_feat // 8] = minutes[0]                                      # a block of equal times
    feats = pd.DataFrame({"customer_id": keys.astype("int32"),
                          "ts": [T0 + timedelta(minutes=int(m)) for m in minutes],
                          "amount": rng.normal(100, 30, size=n_feat).round(2),
                          "kind": rng.choice(["a", "b"], size=n_feat),
                          "fid": rng.permutation(n_feat).astype("int64")})
    ekeys = rng.choice([1, 2, 3, 4, 5], size=n_ent, p=[0.6, 0.1, 0.1, 0.1, 0.1])   # key 5 has no features
    emin = rng.integers(0, 50 * 60, size=n_ent)
    # some events exactly at a feature time and exactly at feature time + TTL
    emin[:10] = minutes[:10]
    emin[10:20] = minutes[10:20] + 180
    ents = pd.DataFrame({"event_id": np.arange(n_ent, dtype="int64"), "customer_id": ekeys.astype("int32"),
                         "event_timestamp": [T0 + timedelta(minutes=int(m)) for m in emin]})
    return feats, ents


def _brute(feats: pd.DataFrame, ents: pd.DataFrame, kind: str, ttl: timedelta | None, col: str):
    out = {}
    f = feats[feats["kind"] == kind]
    for e in ents.itertuples():
        c = f[(f["customer_id"] == e.customer_id) & (f["ts"] <= e.event_timestamp)]
        if ttl is not None:
            c = c[c["ts"] >= e.event_timestamp - ttl]
        out[e.event_id] = None if c.empty else float(c.sort_values(["ts", "fid"]).iloc[-1][col])
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_matches_brute_force(spark, seed):
    feats, ents = _random_frames(seed)
    f = spark.createDataFrame(feats, "customer_id int, ts timestamp_ntz, amount double, kind string, fid long")
    e = spark.createDataFrame(ents, "event_id long, customer_id int, event_timestamp timestamp_ntz")
    va = FeatureView("va", f.filter("kind = 'a'"), ["customer_id"], "ts", ["amount"], ttl=timedelta(hours=3),
                     tie_breaker="fid", rename={"amount": "amount_a"})
    vb = FeatureView("vb", f.filter("kind = 'b'"), ["customer_id"], "ts", ["amount", "fid"], ttl=None,
                     tie_breaker="fid", rename={"amount": "amount_b", "fid": "fid_b"})
    got = point_in_time_join(e, [va, vb], "event_timestamp", bucket_seconds=600).toPandas()
    assert len(got) == len(ents)
    assert list(got.columns) == ["event_id", "customer_id", "event_timestamp", "amount_a", "amount_b", "fid_b"]
    by_id = got.set_index("event_id")
    norm = lambda v: None if pd.isna(v) else float(v)
    for col, kind, ttl, src in (("amount_a", "a", timedelta(hours=3), "amount"), ("amount_b", "b", None, "amount"),
                                ("fid_b", "b", None, "fid")):
        want = _brute(feats, ents, kind, ttl, src)
        have = {i: norm(v) for i, v in by_id[col].items()}
        assert have == want, col


def test_null_keys_and_typed_tie_breakers(spark):
    f = spark.createDataFrame(
        [(None, T0, 7.0, T0), (1, T0, 1.0, T0), (1, T0, 2.0, T0 + timedelta(hours=1)), (2, T0, 3.0, T0), (2, T0, 4.0, T0)],
        "customer_id int, ts timestamp_ntz, amount double, created timestamp_ntz")
    e = spark.createDataFrame([(i, k, T0 + timedelta(minutes=m)) for i, (k, m) in enumerate(
        [(None, 5), (None, 90), (1, 0), (1, 90), (2, 1), (2, 90), (2, -1)])], "id int, customer_id int, event_timestamp timestamp_ntz")
    typed = FeatureView("v", f, ["customer_id"], "ts", ["amount"], tie_breaker="created")
    plain = FeatureView("w", f, ["customer_id"], "ts", ["amount"], rename={"amount": "largest"})
    got = {r.id: (r.amount, r.largest) for r in point_in_time_join(e, [typed, plain], bucket_seconds=600).collect()}
    assert got == {0: (None, None), 1: (None, None), 2: (2.0, 2.0), 3: (2.0, 2.0), 4: (4.0, 4.0), 5: (4.0, 4.0), 6: (None, None)}


def test_now_keeps_every_entity_row(spark):
    f = spark.createDataFrame([(1, T0, 1.0), (None, T0, 9.0)], "customer_id int, ts timestamp_ntz, amount double")
    e = spark.createDataFrame([("a", 1), ("b", 1), ("c", None), ("d", 3)], "id string, customer_id int")
    out = point_in_time_now(e, FeatureView("v", f, ["customer_id"], "ts", ["amount"]), as_of=T0 + timedelta(days=1))
    assert out.columns == ["id", "customer_id", "event_timestamp", "amount"]
    assert sorted((r.id, r.amount) for r in out.collect()) == [("a", 1.0), ("b", 1.0), ("c", None), ("d", None)]


def test_broadcast_threshold_spellings(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, n in (("50MB", 50 << 20), ("64m", 64 << 20), ("1024", 1024), ("-1", 0)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert broadcast_limit(spark.range(1)) == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
