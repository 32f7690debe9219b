"""Feature-store queries: point-in-time join, batch scoring at a time, latest values, lookup, push."""

from __future__ import annotations

import zlib
from datetime import timedelta

from pyspark.sql import functions as F

from ledgerlens.functions.scoring import is_large_tx
from ledgerlens.operators.joins import (FeatureView, latest_per_key, online_lookup, point_in_time_join,
                                        point_in_time_now, push_upsert)
from ledgerlens.operators.online import OnlineTable, bucketed_lookup, publish_buckets
from ledgerlens.plans.common import EVENTS_FEATURES_SQL, LARGE, D
from ledgerlens.plans.registry import register
from ledgerlens.session import scratch_path
from ledgerlens.sources import testdata as T

AS_OF = "2024-01-31 00:00:00"      # batch-scoring time just after the stand-in data ends
PUSH_FROM = "2024-01-20 00:00:00"  # rows from here on arrive as pushed rows


def _views(spark, sf):
    # some feature rows have no key: they belong to nobody
    f = T.events_features(spark, sf).withColumn("customer_id", F.when(F.col("event_id") % 50 != 0, F.col("customer_id")))
    tx = FeatureView("tx_features", f.filter(F.col("event_type").isin("view", "click")), ["customer_id"], "ts",
                     ["tx_amount", "tx_time_seconds"], ttl=timedelta(days=2), tie_breaker="event_id")
    lab = FeatureView("fraud_labels", f.filter(F.col("event_type").isin("error", "signup")), ["customer_id"], "ts",
                      ["tx_fraud"], ttl=timedelta(days=365), tie_breaker="event_id")
    return tx, lab


def _pit_view_sql(name, types, ttl_days, cols):
    sel = ", ".join(f"f.{c}" for c in cols)
    kinds = ", ".join(f"'{t}'" for t in types)
    return f"""{name} AS (SELECT * FROM (SELECT e.event_id, {sel},
        row_number() OVER (PARTITION BY e.event_id ORDER BY f.ts DESC, f.event_id DESC) AS rn
      FROM e JOIN f ON f.customer_id = e.customer_id AND f.ts <= e.event_timestamp
                   AND f.ts >= e.event_timestamp - INTERVAL {ttl_days} DAY
      WHERE f.event_type IN ({kinds})) WHERE rn = 1)"""


PIT_SQL = f"""
WITH f AS (SELECT * FROM ({EVENTS_FEATURES_SQL}) WHERE event_id % 50 <> 0),
e AS (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN user_id END AS customer_id, ts AS event_timestamp FROM events
      WHERE event_type = 'purchase'),
{_pit_view_sql('v1', ['view', 'click'], 2, ['tx_amount', 'tx_time_seconds'])},
{_pit_view_sql('v2', ['error', 'signup'], 365, ['tx_fraud'])}
SELECT e.event_id, e.customer_id, e.event_timestamp, v1.tx_amount, v1.tx_time_seconds, v2.tx_fraud,
       CAST(v1.tx_amount > {D(LARGE)} AS INTEGER) AS is_large_tx
FROM e LEFT JOIN v1 ON v1.event_id = e.event_id LEFT JOIN v2 ON v2.event_id = e.event_id"""


@register("point_in_time_join", PIT_SQL)
def q_point_in_time_join(spark, sf):
    ev = T.table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    ent = ev.select("event_id", F.when(F.col("event_id") % 50 != 0, F.col("user_id")).alias("customer_id"), F.col("ts").alias("event_timestamp"))
    out = point_in_time_join(ent, list(_views(spark, sf)), "event_timestamp")
    return out.withColumn("is_large_tx", is_large_tx("tx_amount", LARGE))   # on-demand feature


_LATEST_ALL_SQL = f"""
SELECT customer_id, ts, tx_amount, tx_time_seconds FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM ({EVENTS_FEATURES_SQL}) WHERE ts <= TIMESTAMP '{AS_OF}' AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY)
WHERE rn = 1"""

PIT_NOW_SQL = f"""
SELECT k.o_orderkey, k.customer_id, TIMESTAMP '{AS_OF}' AS event_timestamp, l.tx_amount, l.tx_time_seconds
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS customer_id FROM orders) k
LEFT JOIN ({_LATEST_ALL_SQL}) l ON l.customer_id = k.customer_id"""


def _pit_now(spark, sf):
    f = T.events_features(spark, sf)
    view = FeatureView("tx_features", f, ["customer_id"], "ts", ["tx_amount", "tx_time_seconds"],
                       ttl=timedelta(days=365), tie_breaker="event_id")
    # one entity row an order: customers come again and again, some orders have none
    keys = T.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey"))
                                               .alias("customer_id"))
    return point_in_time_now(keys, view, as_of=AS_OF)


@register("point_in_time_now", PIT_NOW_SQL)
def q_point_in_time_now(spark, sf):
    return _pit_now(spark, sf)


@register("sort_by_key", PIT_NOW_SQL + "\nORDER BY customer_id, o_orderkey")
def q_sort_by_key(spark, sf):
    return _pit_now(spark, sf).orderBy("customer_id", "o_orderkey")


def _latest_sql(where: str = "TRUE") -> str:
    return f"""
SELECT customer_id, ts, tx_amount, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM ({EVENTS_FEATURES_SQL}) WHERE {where}) WHERE rn = 1"""


@register("latest_per_key", _latest_sql(f"ts <= TIMESTAMP '{PUSH_FROM}'"))
def q_latest_per_key(spark, sf):
    return latest_per_key(T.events_features(spark, sf), ["customer_id"], "ts", ["tx_amount", "event_type"],
                          tie_breaker="event_id", end=PUSH_FROM)


@register("online_lookup", f"""
SELECT k.customer_id, l.ts, l.tx_amount, l.event_type
FROM (SELECT DISTINCT o_custkey AS customer_id FROM orders) k LEFT JOIN ({_latest_sql()}) l USING (customer_id)""")
def q_online_lookup(spark, sf):
    online = latest_per_key(T.events_features(spark, sf), ["customer_id"], "ts", ["tx_amount", "event_type"],
                            tie_breaker="event_id")
    keys = T.table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id")).distinct()
    return online_lookup(keys, online, ["customer_id"])


@register("push_upsert", _latest_sql())
def q_push_upsert(spark, sf):
    f = T.events_features(spark, sf).select("customer_id", "ts", "tx_amount", "event_type", "event_id")
    offline = f.filter(F.col("ts") < F.lit(PUSH_FROM).cast("timestamp_ntz"))
    pushed = f.filter(F.col("ts") >= F.lit(PUSH_FROM).cast("timestamp_ntz"))
    online = latest_per_key(offline, ["customer_id"], "ts", ["tx_amount", "event_type", "event_id"],
                            tie_breaker="event_id")
    _, new_online = push_upsert(offline, online, pushed, ["customer_id"], "ts", ["tx_amount", "event_type", "event_id"],
                                tie_breaker="event_id")
    return new_online.drop("event_id")


# ---- the online table by increments ---------------------------------------------------------------------------------

def _online(spark, name):
    return OnlineTable(spark, scratch_path(spark, name), ["customer_id"], "ts", ["tx_amount", "event_type"],
                       tie_breaker="event_id", buckets=16)


@register("push_incremental", _latest_sql())
def q_push_incremental(spark, sf):
    """The table up to PUSH_FROM, then the later rows by two pushes in the wrong order and one of them twice."""
    f, t = T.events_features(spark, sf), _online(spark, "push-incremental")
    start = F.lit(PUSH_FROM).cast("timestamp_ntz")
    t.push(f.filter(F.col("ts") < start), "load")
    late, later = F.col("ts") < start + F.expr("INTERVAL 3 DAYS"), F.col("ts") >= start + F.expr("INTERVAL 3 DAYS")
    for rows, push_id in ((later, "b"), (late, "a"), (later, "b")):
        t.push(f.filter((F.col("ts") >= start) & rows), push_id)
    return t.read().drop("event_id")


ARRIVED_SQL = "CAST(CAST(ts AS DATE) + CASE WHEN event_id % 20 = 0 THEN 3 ELSE 0 END AS DATE)"
INCREMENTS = ("2024-01-10", "2024-01-20", "2024-01-31")


def arrived_features(spark, sf):
    """The features in partitions by the day they arrived; every twentieth is three days late."""
    def build(path):
        day = F.date_add(F.to_date("ts"), F.when(F.col("event_id") % 20 == 0, 3).otherwise(0))
        f = T.events_features(spark, sf).withColumn("arrived", day)
        f.repartition("arrived", F.pmod(F.hash("event_id"), F.lit(4))).write.partitionBy("arrived").parquet(path)
    return spark.read.parquet(T.written(spark, sf, "features-by-arrival", build))


@register("materialize_incremental", _latest_sql(f"{ARRIVED_SQL} <= DATE '{INCREMENTS[-1]}'"))
def q_materialize_incremental(spark, sf):
    """Three increments by arrival, the last one asked for twice."""
    t = _online(spark, "materialize")
    for end in (*INCREMENTS, INCREMENTS[-1]):
        t.materialize(arrived_features(spark, sf), "arrived", end)
    return t.read().drop("event_id")


# requests: one an order; a third of them for one customer, some without a key, some for customers nobody knows
_REQUEST_SQL = """CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 50 = 1 THEN NULL
                       WHEN o_orderkey % 50 = 2 THEN -o_custkey ELSE o_custkey END"""


@register("online_lookup_buckets", f"""
SELECT k.customer_id, k.o_orderkey, l.ts, l.tx_amount, l.event_type
FROM (SELECT o_orderkey, {_REQUEST_SQL} AS customer_id FROM orders) k LEFT JOIN ({_latest_sql()}) l USING (customer_id)""")
def q_online_lookup_buckets(spark, sf):
    name = f"online_{zlib.crc32(sf.encode()):x}_{spark.sparkContext.applicationId}".replace("-", "_")
    T.written(spark, sf, "online-buckets", lambda path: publish_buckets(
        latest_per_key(T.events_features(spark, sf).dropna(subset=["customer_id"]), ["customer_id"], "ts",
                       ["tx_amount", "event_type"], tie_breaker="event_id"), name, path, ["customer_id"], 16))
    asked = T.table(spark, sf, "orders").select(F.expr(_REQUEST_SQL).alias("customer_id"), "o_orderkey")
    return bucketed_lookup(asked, name, ["customer_id"])
