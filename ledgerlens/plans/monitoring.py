"""Monitoring queries over the offsets table and the request log (events), plus label repair queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scoring as S
from ledgerlens.functions.hashing import sql_uniform
from ledgerlens.operators import labels as L
from ledgerlens.operators import monitoring as M
from ledgerlens.plans.common import LARGE, MEDIUM, OFFSETS_SQL, TX_SQL, RAW_TX_SQL, D, clean_sql
from ledgerlens.plans.registry import ORACLE, register
from ledgerlens.sources import testdata as T

# The stand-in stream carries about 3 messages per topic and hour at sf 0.01 (the reference loads carry hundreds
# per second), so the lag-health query uses a lag limit of 5 messages instead of the default 1000.
STANDIN_MAX_LAG = 5
TPS_TARGET = 50
# fixed values: limit of each gauge, seconds it must be exceeded; and the longest pause between its samples here
GAUGES = {"kafka_consumer_lag": (500.0, 120, 3600), "kafka_queue_length": (1000.0, 60, 3600),
          "ml_model_cpu_usage": (80.0, 300, 300), "ml_model_memory_usage": (70.0, 600, 300)}
GAUGE_LIMITS = {k: v[0] for k, v in GAUGES.items()}
# fixed values: seconds the windowed rules must fire; and their window
RULES = {"error_rate": (120, 300), "slow_response": (180, 300), "fraud_share": (300, 900), "no_predictions": (300, 600)}
AS_OF = "2024-01-31 06:00:00"      # time at which the rules about silence are asked: hours after the last event

_G_SQL = f"""
SELECT sampled_at, topic, count(*) AS partitions, CAST(sum(coalesce(committed, 0)) AS BIGINT) AS total_committed,
       CAST(sum("end") AS BIGINT) AS total_end,
       CAST(sum(CASE WHEN committed IS NOT NULL THEN "end" - committed ELSE 0 END) AS BIGINT) AS total_lag,
       bool_or(committed IS NOT NULL) AS consumer_group_exists
FROM ({OFFSETS_SQL}) GROUP BY sampled_at, topic"""


def _health_sql(max_lag=STANDIN_MAX_LAG, warn=0.7):
    return f"""
SELECT *, CASE max(CASE health_status WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) OVER (PARTITION BY sampled_at)
          WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'healthy' END AS overall_health
FROM (SELECT *, CASE WHEN NOT consumer_group_exists THEN
                       CASE WHEN total_end > 0 THEN 'pending_consumption' ELSE 'waiting_consumers' END
                     WHEN total_lag > {max_lag} THEN 'critical' WHEN total_lag > {D(max_lag * warn)} THEN 'warning'
                     ELSE 'healthy' END AS health_status FROM ({_G_SQL}))"""


@register("offsets_table", OFFSETS_SQL)
def q_offsets_table(spark, sf):
    return T.offsets(spark, sf)


@register("consumer_lag", f"""
WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY sampled_at DESC) AS rn
                          FROM ({OFFSETS_SQL})) WHERE rn = 1)
SELECT topic, count(*) AS partitions, CAST(sum(coalesce(committed, 0)) AS BIGINT) AS total_committed,
       CAST(sum("end") AS BIGINT) AS total_end,
       CAST(sum(CASE WHEN committed IS NOT NULL THEN "end" - committed ELSE 0 END) AS BIGINT) AS total_lag,
       bool_or(committed IS NOT NULL) AS consumer_group_exists,
       CASE WHEN bool_or(committed IS NOT NULL) THEN 'active_consumers' ELSE 'no_active_consumers' END AS status
FROM l GROUP BY topic""")
def q_consumer_lag(spark, sf):
    return M.consumer_lag(T.offsets(spark, sf))


def _health(spark, sf):
    return M.lag_health(T.offsets(spark, sf), STANDIN_MAX_LAG)


@register("lag_health", _health_sql())
def q_lag_health(spark, sf):
    return _health(spark, sf)


def _advice_sql(finding: str, detail: str, where: str) -> str:
    kind, priority, text = M.ADVICE[finding]
    return f"SELECT sampled_at, '{kind}' AS type, '{priority}' AS priority, '{text}' || {detail} AS message FROM c WHERE {where}"


@register("lag_advice", f"""
WITH h AS ({_health_sql()}),
c AS (SELECT sampled_at, any_value(overall_health) AS load,
             coalesce(string_agg(DISTINCT topic, ', ' ORDER BY topic) FILTER (WHERE NOT consumer_group_exists), '') AS idle,
             coalesce(string_agg(DISTINCT topic || '=' || total_end, ', ' ORDER BY topic || '=' || total_end)
                      FILTER (WHERE NOT consumer_group_exists AND total_end > 0), '') AS unread
      FROM h GROUP BY sampled_at)
""" + " UNION ALL ".join([
    _advice_sql("no_consumer", "idle", "idle <> ''"), _advice_sql("unread", "unread", "unread <> ''"),
    *(_advice_sql(k, "''", f"load = '{k}'") for k in ("critical", "warning")),
    _advice_sql("healthy", "''", "load = 'healthy' AND idle = ''")]))
def q_lag_advice(spark, sf):
    return M.lag_advice(_health(spark, sf))


@register("lag_summary", f"""
WITH h AS ({_health_sql()}), c AS (SELECT DISTINCT sampled_at, overall_health FROM h),
g AS (SELECT overall_health, count(*) AS checks FROM c GROUP BY overall_health)
SELECT overall_health, checks, CAST(sum(checks) OVER () AS BIGINT) AS total_checks, round(checks * 100.0 / sum(checks) OVER (), 6) AS pct,
       sum(CASE WHEN overall_health = 'critical' THEN checks ELSE 0 END) OVER () > sum(checks) OVER () * 0.1
         AS frequent_critical
FROM g""")
def q_lag_summary(spark, sf):
    return M.lag_summary(_health(spark, sf))


@register("lag_rate", f"""
WITH g AS (SELECT topic, sampled_at, CAST(sum("end") AS BIGINT) AS total_end FROM ({OFFSETS_SQL}) GROUP BY ALL),
l AS (SELECT *, lag(total_end) OVER (PARTITION BY topic ORDER BY sampled_at) AS pe,
             (epoch_us(sampled_at) - epoch_us(lag(sampled_at) OVER (PARTITION BY topic ORDER BY sampled_at))) / 1e6 AS secs
      FROM g)
SELECT topic, sampled_at, total_end,
       round(coalesce(CASE WHEN secs > 0 THEN (total_end - pe) / secs ELSE 0.0 END, 0.0), 6) AS estimated_tps FROM l""")
def q_lag_rate(spark, sf):
    return M.lag_rate(T.offsets(spark, sf))


@register("throughput_report", f"""
WITH g AS (SELECT count(*) FILTER (WHERE event_type <> 'error') AS messages_sent,
                  count(*) FILTER (WHERE event_type = 'error') AS messages_error,
                  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS runtime_seconds FROM events),
r AS (SELECT *, CASE WHEN messages_sent + messages_error > 0
                     THEN messages_sent * 100.0 / (messages_sent + messages_error) ELSE 0.0 END AS rate,
             CASE WHEN runtime_seconds > 0 THEN messages_sent / runtime_seconds ELSE 0.0 END AS tps FROM g)
SELECT messages_sent, messages_error, round(rate, 6) AS success_rate, round(tps, 6) AS avg_tps,
       round(runtime_seconds, 6) AS runtime_seconds, tps >= {TPS_TARGET} * 0.95 AS tps_achieved, rate >= 99 AS reliability_ok,
       tps >= {TPS_TARGET} * 0.95 AND rate >= 99 AS overall_success
FROM r""")
def q_throughput_report(spark, sf):
    ev = T.table(spark, sf, "events")
    return M.throughput_report(ev, "ts", F.col("event_type") != "error", TPS_TARGET)


def _phase_sql(phases=M.PHASES, tol=0.9, min_ok=3):
    total = float(sum(p[2] for p in phases))
    edges, acc = [], 0.0
    for _, _, d in phases[:-1]:
        acc += d / total
        edges.append(acc)
    case = "CASE " + " ".join(f"WHEN frac < {D(e)} THEN {i}" for i, e in enumerate(edges)) + f" ELSE {len(phases) - 1} END"
    spec = ", ".join(f"({i}, '{n}', {t}, {d})" for i, (n, t, d) in enumerate(phases))
    return f"""
WITH b AS (SELECT min(epoch_us(ts)) AS t0, max(epoch_us(ts)) AS t1 FROM events),
x AS (SELECT CASE WHEN t1 > t0 THEN (epoch_us(ts) - t0) / (t1 - t0) ELSE 0.0 END AS frac FROM events, b),
c AS (SELECT CAST({case} AS INTEGER) AS phase_index, count(*) AS rows FROM x GROUP BY 1),
s AS (SELECT * FROM (VALUES {spec}) t(phase_index, phase, target_tps, share_seconds)),
r AS (SELECT s.phase_index, s.phase, s.target_tps, coalesce(c.rows, 0) AS rows,
             (b.t1 - b.t0) / 1e6 * s.share_seconds / {D(total)} AS secs
      FROM s CROSS JOIN b LEFT JOIN c ON c.phase_index = s.phase_index),
q AS (SELECT phase_index, phase, target_tps, rows, CASE WHEN secs > 0 THEN rows / secs ELSE 0.0 END AS reached FROM r)
SELECT phase_index, phase, target_tps, rows, round(reached, 6) AS reached_tps, reached >= target_tps * {tol} AS ok,
       CAST(sum(CAST(reached >= target_tps * {tol} AS BIGINT)) OVER () AS BIGINT) AS phases_ok,
       sum(CAST(reached >= target_tps * {tol} AS BIGINT)) OVER () >= {min_ok} AS attack_success
FROM q"""


@register("phase_report", _phase_sql())
def q_phase_report(spark, sf):
    return M.phase_report(T.table(spark, sf, "events"), "ts")


def _bucket_sql(width_s: int) -> str:
    return f"make_timestamp(CAST(floor(epoch_us(ts) / {width_s * 1_000_000}) * {width_s * 1_000_000} AS BIGINT))"


@register("rate_per_window", f"""
SELECT w AS window_start, w + INTERVAL {300} SECOND AS window_end, count(*) AS requests,
       round(count(*) / 300.0, 6) AS rate_per_s
FROM (SELECT {_bucket_sql(300)} AS w FROM events) GROUP BY w""")
def q_rate_per_window(spark, sf):
    return M.rate_per_window(T.table(spark, sf, "events"), "ts", 300)


@register("error_rate_alert", f"""
SELECT w AS window_start, w + INTERVAL 300 SECOND AS window_end, count(*) AS requests,
       count(*) FILTER (WHERE event_type = 'error') AS errors,
       round(count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*), 6) AS error_pct,
       count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*) > 5.0 AS firing
FROM (SELECT {_bucket_sql(300)} AS w, event_type FROM events) GROUP BY w""")
def q_error_rate_alert(spark, sf):
    return M.error_rate_alert(T.table(spark, sf, "events"), "ts", F.col("event_type") == "error", 300, 5.0)


@register("latency_p95_alert", f"""
SELECT w AS window_start, w + INTERVAL 300 SECOND AS window_end, round(quantile_cont(lat, 0.95), 6) AS p95_latency,
       CAST((2 * sum(CAST(round(lat * 1e6) AS BIGINT)) + count(lat)) // (2 * count(lat)) AS BIGINT) / 1e6 AS mean_latency,
       quantile_cont(lat, 0.95) > 2.0 AS p95_alert,
       CAST((2 * sum(CAST(round(lat * 1e6) AS BIGINT)) + count(lat)) // (2 * count(lat)) AS BIGINT) / 1e6 > 1.0 AS mean_alert
FROM (SELECT {_bucket_sql(300)} AS w, value / 100.0 AS lat FROM events) GROUP BY w""")
def q_latency_p95_alert(spark, sf):
    log = T.table(spark, sf, "events").select("ts", (F.col("value") / 100.0).alias("latency_s"))
    return M.latency_alert(log, "ts", "latency_s", 300, 2.0, 1.0, exact=True)


_EV_P_SQL = S.request_risk_score_sql("value", "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))", "user_id",
                                     large=LARGE, medium=MEDIUM)


@register("fraud_share_alert", f"""
SELECT w AS window_start, w + INTERVAL 900 SECOND AS window_end, count(*) AS predictions,
       count(*) FILTER (WHERE p > 0.5) AS fraud, round(count(*) FILTER (WHERE p > 0.5) * 100.0 / count(*), 6) AS fraud_pct,
       count(*) FILTER (WHERE p > 0.5) * 100.0 / count(*) > 20.0 AS firing
FROM (SELECT {_bucket_sql(900)} AS w, {_EV_P_SQL} AS p FROM events) GROUP BY w""")
def q_fraud_share_alert(spark, sf):
    ev = T.table(spark, sf, "events")
    secs = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    p = S.request_risk_score(F.col("value"), secs, F.col("user_id"), large=LARGE, medium=MEDIUM)
    return M.fraud_share_alert(ev.withColumn("p", p), "ts", F.col("p") > 0.5, 900, 20.0)


@register("no_data_alert", """
WITH p AS (SELECT CAST(floor(epoch_us(ts) / 600000000) AS BIGINT) AS b FROM events WHERE event_type = 'purchase'),
c AS (SELECT b, count(*) AS n FROM p GROUP BY b),
s AS (SELECT range AS b FROM range((SELECT min(b) FROM p), CAST(floor(epoch_us(TIMESTAMP 'AS_OF') / 600000000) AS BIGINT) + 1))
SELECT make_timestamp(s.b * 600000000) AS window_start, make_timestamp(s.b * 600000000) + INTERVAL 600 SECOND AS window_end,
       coalesce(c.n, 0) AS predictions, coalesce(c.n, 0) = 0 AS no_data
FROM s LEFT JOIN c ON c.b = s.b""".replace("AS_OF", AS_OF))
def q_no_data_alert(spark, sf):
    ev = T.table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return M.no_data_alert(ev, "ts", 600, AS_OF)


@register("queue_stalled", f"""
WITH g AS (SELECT topic, sampled_at, CAST(sum(coalesce(committed, 0)) AS BIGINT) AS c,
                  CAST(sum("end" - coalesce(committed, 0)) AS BIGINT) AS queue
           FROM ({OFFSETS_SQL}) GROUP BY topic, sampled_at),
n AS (SELECT * FROM g UNION ALL
      SELECT topic, TIMESTAMP '{AS_OF}', arg_max(c, sampled_at), arg_max(queue, sampled_at) FROM g GROUP BY topic),
l AS (SELECT *, c - lag(c) OVER (PARTITION BY topic ORDER BY sampled_at) AS consumed FROM n)
SELECT topic, sampled_at, consumed, queue, coalesce(consumed, 0) = 0 AND queue > 0 AS stalled FROM l""")
def q_queue_stalled(spark, sf):
    return M.queue_stalled(T.offsets(spark, sf), as_of=AS_OF)


def _load_gauges(spark, sf):
    """CPU and memory gauges every 5 minutes: they start an hour at the mean (CPU) and a third of the largest (memory)
    amount of the hour's events, at most 100, and fall to zero over the hour."""
    per_hour = T.table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.avg("value").alias("ml_model_cpu_usage"), (F.max("value") / 3).alias("ml_model_memory_usage"))
    rows = per_hour.select("hour", F.explode(F.array(*(
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("v"), F.lit(k).alias("k"))
        for m in ("ml_model_cpu_usage", "ml_model_memory_usage") for k in range(12)))).alias("g"))
    at = F.col("hour") + F.make_dt_interval(mins=F.col("g.k") * 5)
    return rows.select(at.alias("sampled_at"), "g.metric",
                       F.round(F.least(F.col("g.v"), F.lit(100.0)) * (12 - F.col("g.k")) / 12, 6).alias("value"))


def _gauges(spark, sf):
    o = T.offsets(spark, sf)
    g = o.groupBy("sampled_at").agg(
        F.sum(F.when(F.col("committed").isNotNull(), F.col("end") - F.col("committed")).otherwise(0))
         .cast("double").alias("kafka_consumer_lag"),
        F.sum(F.col("end") - F.coalesce(F.col("committed"), F.lit(0))).cast("double").alias("kafka_queue_length"))
    kafka = g.select("sampled_at", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                                       for m in ("kafka_consumer_lag", "kafka_queue_length")))).alias("g"))
    return kafka.select("sampled_at", "g.metric", "g.value").unionByName(_load_gauges(spark, sf))


_GAUGE_SQL = f"""
SELECT sampled_at, 'kafka_consumer_lag' AS metric,
       CAST(sum(CASE WHEN committed IS NOT NULL THEN "end" - committed ELSE 0 END) AS DOUBLE) AS value
FROM ({OFFSETS_SQL}) GROUP BY sampled_at
UNION ALL
SELECT sampled_at, 'kafka_queue_length', CAST(sum("end" - coalesce(committed, 0)) AS DOUBLE)
FROM ({OFFSETS_SQL}) GROUP BY sampled_at
UNION ALL
SELECT hour + to_minutes(5 * k), metric, round(least(v, 100.0::DOUBLE) * (12 - k) / 12, 6)
FROM (SELECT date_trunc('hour', ts) AS hour, 'ml_model_cpu_usage' AS metric, avg(value) AS v FROM events GROUP BY 1
      UNION ALL SELECT date_trunc('hour', ts), 'ml_model_memory_usage', max(value) / 3 FROM events GROUP BY 1),
     (SELECT CAST(range AS INTEGER) AS k FROM range(12))"""

_THRESH_SQL = f"""
SELECT g.*, l.lim AS "limit", g.value > l.lim AS firing
FROM ({_GAUGE_SQL}) g JOIN (VALUES {', '.join(f"('{k}', {D(v)})" for k, v in GAUGE_LIMITS.items())}) l(metric, lim)
  ON g.metric = l.metric"""


@register("threshold_alert", _THRESH_SQL)
def q_threshold_alert(spark, sf):
    return M.threshold_alert(_gauges(spark, sf), GAUGE_LIMITS)


def _runs_sql(firing: str, key: str, ts: str, limits: dict, covers: dict | None = None) -> str:
    """``limits``: key -> (seconds it must fire, longest pause between its checks); ``covers``: seconds a check stands for."""
    rows = ", ".join(f"('{k}', {f}, {g}, {(covers or {}).get(k, 0)})" for k, (f, g) in limits.items())
    return f"""
WITH t AS (SELECT t.*, l.f, l.g, l.c FROM ({firing}) t JOIN (VALUES {rows}) l(key, f, g, c) ON t.{key} = l.key),
c AS (SELECT *, CASE WHEN lag(firing) OVER w IS NULL OR lag(firing) OVER w <> firing
                       OR (epoch_us({ts}) - lag(epoch_us({ts})) OVER w) / 1e6 > g THEN 1 ELSE 0 END AS chg
      FROM t WINDOW w AS (PARTITION BY {key} ORDER BY {ts})),
r AS (SELECT *, sum(chg) OVER (PARTITION BY {key} ORDER BY {ts} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM c),
i AS (SELECT {key}, run, f, c, min({ts}) AS start, max({ts}) AS "end", count(*) AS checks FROM r WHERE firing
      GROUP BY {key}, run, f, c)
SELECT {key}, start, "end", checks, (epoch_us("end") - epoch_us(start)) / 1e6 + c AS duration_seconds,
       (epoch_us("end") - epoch_us(start)) / 1e6 + c >= f AS fired
FROM i"""


@register("sustained_alert", _runs_sql(_THRESH_SQL, "metric", "sampled_at", {k: v[1:] for k, v in GAUGES.items()}))
def q_sustained_alert(spark, sf):
    return M.sustained_alert(M.threshold_alert(_gauges(spark, sf), GAUGE_LIMITS), "sampled_at", "metric",
                             {k: v[1] for k, v in GAUGES.items()}, {k: v[2] for k, v in GAUGES.items()})


_WINDOWED_SQL = f"""
SELECT 'error_rate' AS alert, window_start AS checked_at, firing FROM ({ORACLE["error_rate_alert"]})
UNION ALL SELECT 'slow_response', window_start, p95_alert FROM ({ORACLE["latency_p95_alert"]})
UNION ALL SELECT 'fraud_share', window_start, firing FROM ({ORACLE["fraud_share_alert"]})
UNION ALL SELECT 'no_predictions', window_start, no_data FROM ({ORACLE["no_data_alert"]})"""


@register("alert_runs", _runs_sql(_WINDOWED_SQL, "alert", "checked_at", RULES, {k: v[1] for k, v in RULES.items()}))
def q_alert_runs(spark, sf):
    """The windowed rules with the time each must hold before it fires; a window that fires has held for its width."""
    parts = [q_error_rate_alert(spark, sf).select(F.lit("error_rate").alias("alert"), "window_start", "firing"),
             q_latency_p95_alert(spark, sf).select(F.lit("slow_response"), "window_start", "p95_alert"),
             q_fraud_share_alert(spark, sf).select(F.lit("fraud_share"), "window_start", "firing"),
             q_no_data_alert(spark, sf).select(F.lit("no_predictions"), "window_start", "no_data")]
    rows = reduce(DataFrame.union, parts).withColumnRenamed("window_start", "checked_at")
    widths = {k: v[1] for k, v in RULES.items()}
    return M.sustained_alert(rows, "checked_at", "alert", {k: v[0] for k, v in RULES.items()}, widths, widths)


_REQ_P_SQL = S.request_risk_score_sql("tx_amount", "tx_time_seconds", "customer_id", large=LARGE, medium=MEDIUM)


@register("prediction_counters", f"""
WITH r AS (SELECT *, {S.request_violations_sql()} AS v FROM ({RAW_TX_SQL}))
SELECT 'ml_model_predictions_total' AS counter,
       'model_version=v' || CAST(customer_id % 2 + 1 AS VARCHAR) || ',prediction_result=' ||
         CASE WHEN {_REQ_P_SQL} > 0.5 THEN 'fraud' ELSE 'legitimate' END AS labels, count(*) AS value
FROM r WHERE v = '' GROUP BY 2
UNION ALL
SELECT 'ml_model_errors_total', 'error_type=' || split_part(v, ',', 1), count(*) FROM r WHERE v <> '' GROUP BY 2""")
def q_prediction_counters(spark, sf):
    raw = T.raw_transactions(spark, sf).withColumn("v", S.request_violations())
    ok = raw.filter(F.size("v") == 0)
    p = S.request_risk_score("tx_amount", "tx_time_seconds", "customer_id", large=LARGE, medium=MEDIUM)
    preds = ok.groupBy(F.concat(F.lit("model_version=v"), (F.pmod("customer_id", F.lit(2)) + 1).cast("string"),
                                F.lit(",prediction_result="),
                                F.when(p > 0.5, "fraud").otherwise("legitimate")).alias("labels")) \
              .agg(F.count(F.lit(1)).alias("value")).withColumn("counter", F.lit("ml_model_predictions_total"))
    errs = raw.filter(F.size("v") > 0).groupBy(F.concat(F.lit("error_type="), F.col("v")[0]).alias("labels")) \
              .agg(F.count(F.lit(1)).alias("value")).withColumn("counter", F.lit("ml_model_errors_total"))
    return preds.unionByName(errs).select("counter", "labels", "value")


# ============================================================================================ label repair

def _zeroed(spark, sf):
    tx = T.transactions(spark, sf)
    return tx.withColumn("tx_fraud_scenario", F.when(F.col("tx_fraud") == 1, 1)
                         .when(F.col("terminal_id") < 10, 2).otherwise(0)).withColumn("tx_fraud", F.lit(0))


@register("label_from_scenario", f"""
SELECT transaction_id, CASE WHEN (CASE WHEN tx_fraud = 1 THEN 1 WHEN terminal_id < 10 THEN 2 ELSE 0 END) > 0 THEN 1 ELSE 0 END
       AS tx_fraud FROM ({TX_SQL})""")
def q_label_from_scenario(spark, sf):
    return L.label_from_scenario(_zeroed(spark, sf)).select("transaction_id", "tx_fraud")


@register("synth_labels", f"""
SELECT transaction_id, CAST(tx_amount > (SELECT quantile_cont(tx_amount, 0.98) FROM ({TX_SQL}))
                            OR {sql_uniform('transaction_id', 42)} < {D(0.005)} AS INTEGER) AS tx_fraud
FROM ({TX_SQL})""")
def q_synth_labels(spark, sf):
    tx = T.transactions(spark, sf).withColumn("tx_fraud", F.lit(0))
    return L.synth_labels(tx, exact=True).select("transaction_id", "tx_fraud")


@register("prepare_labels", f"""
SELECT transaction_id, tx_fraud, 'given' AS label_source FROM ({clean_sql()})""")
def q_prepare_labels(spark, sf):
    return L.prepare_labels(T.clean_table(spark, sf), exact=True).select("transaction_id", "tx_fraud", "label_source")
