"""Rules over counters, gauges and histogram buckets at steps of a minute, and the time each must hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import monitoring as M
from ledgerlens.operators import ranges as R
from ledgerlens.plans.monitoring import _runs_sql
from ledgerlens.plans.registry import ORACLE, register
from ledgerlens.sources import testdata as T

STEP = 60
# fixed values: rule -> (range in seconds, limit, seconds it must hold)
RULES = {"error_rate": (300, 5.0, 120), "slow_response": (300, 2.0, 180), "fraud_share": (900, 20.0, 300),
         "no_predictions": (600, 0.0, 300)}
COUNTERS_SQL = T.counter_samples_sql()


def _samples(spark, sf, *metrics: str) -> DataFrame:
    return T.counter_samples(spark, sf).filter(F.col("metric").isin(*metrics))


def _range_sql(metrics: tuple[str, ...], seconds: int, kind: str = "increase") -> str:
    """Every range by itself: each sample is dealt to all steps that see it, and a range is the largest less the smallest of
    the counter without its restarts."""
    gain = ("CASE WHEN value >= before THEN value - before ELSE coalesce(value * 0 + CASE WHEN before IS NULL THEN 0 ELSE value END, 0) END"
            if kind == "increase" else "CASE WHEN before IS NULL OR value = before THEN 0 ELSE 1 END")
    names = ", ".join(f"'{m}'" for m in metrics)
    return f"""
WITH all_samples AS ({COUNTERS_SQL}),
one AS (SELECT instance, metric, le, read_at, max(value) AS value FROM all_samples WHERE metric IN ({names}) GROUP BY ALL),
step AS (SELECT *, CAST(ceil(epoch_us(read_at) / {STEP * 1_000_000}) AS BIGINT) AS b,
                lag(value) OVER (PARTITION BY instance, metric, le ORDER BY read_at) AS before FROM one),
run AS (SELECT *, sum({gain}) OVER (PARTITION BY instance, metric, le ORDER BY read_at) AS total FROM step),
dealt AS (SELECT instance, metric, le, total, unnest(range(b, least(b + {seconds // STEP}, (SELECT max(b) + 1 FROM step)))) AS t FROM run)
SELECT instance, metric, le, make_timestamp(t * {STEP * 1_000_000}) AS evaluated_at, count(*) AS samples,
       CAST(max(total) - min(total) AS DOUBLE) AS {kind} FROM dealt GROUP BY instance, metric, le, t"""


_COUNTERS = ("http_requests_total", "http_errors_total", "ml_model_predictions_fraud")
_KEYS = ["instance", "metric", "le"]


@register("counter_increase", " UNION ALL ".join(f"""
SELECT {r} AS range_seconds, instance, metric, evaluated_at, samples, increase, round(increase / {r}.0, 6) AS rate_per_s
FROM ({_range_sql(_COUNTERS, r)})""" for r in (300, 600, 900)))
def q_counter_increase(spark, sf):
    """Increase and rate of three counters over 5, 10 and 15 minutes at every minute."""
    src = _samples(spark, sf, *_COUNTERS)
    parts = [R.increase(src, "read_at", "value", ["instance", "metric"], r, STEP).withColumn("range_seconds", F.lit(r))
             for r in (300, 600, 900)]
    return reduce(DataFrame.unionByName, parts).select(
        "range_seconds", "instance", "metric", "evaluated_at", "samples", "increase", F.round("rate_per_s", 6).alias("rate_per_s"))


@register("gauge_changes", f"SELECT instance, evaluated_at, samples, changes, changes > 0 AS firing FROM ({_range_sql(('replicas',), 300, 'changes')})")
def q_gauge_changes(spark, sf):
    """How often the number of replicas changed within 5 minutes."""
    out = R.over_range(_samples(spark, sf, "replicas"), "read_at", "value", ["instance"], 300, STEP, "changes")
    return out.withColumn("firing", F.col("changes") > 0)


def _share_sql(part: str, rule: str) -> str:
    seconds, limit, _ = RULES[rule]
    return f"""
SELECT w.evaluated_at, coalesce(p.n, 0) AS part, w.n AS whole,
       round(CASE WHEN w.n > 0 THEN coalesce(p.n, 0) * 100.0 / w.n END, 6) AS pct,
       coalesce(w.n > 0 AND coalesce(p.n, 0) * 100.0 / w.n > {limit}, FALSE) AS firing
FROM (SELECT evaluated_at, sum(increase) AS n FROM ({_range_sql(("http_requests_total",), seconds)}) GROUP BY 1) w
LEFT JOIN (SELECT evaluated_at, sum(increase) AS n FROM ({_range_sql((part,), seconds)}) GROUP BY 1) p USING (evaluated_at)"""


def _share_rule(spark, sf, part: str, rule: str) -> DataFrame:
    """Share of one counter's increase in that of all requests, over all instances."""
    seconds, limit, _ = RULES[rule]
    grown = lambda m: R.increase(_samples(spark, sf, m), "read_at", "value", ["instance"], seconds, STEP)
    out = R.share(grown(part), grown("http_requests_total"), [])
    return out.select("evaluated_at", "part", "whole", F.round("pct", 6).alias("pct"),
                      F.coalesce(F.col("pct") > limit, F.lit(False)).alias("firing"))


@register("counter_error_rate", _share_sql("http_errors_total", "error_rate"))
def q_counter_error_rate(spark, sf):
    return _share_rule(spark, sf, "http_errors_total", "error_rate")


@register("counter_fraud_share", _share_sql("ml_model_predictions_fraud", "fraud_share"))
def q_counter_fraud_share(spark, sf):
    return _share_rule(spark, sf, "ml_model_predictions_fraud", "fraud_share")


@register("histogram_p95", f"""
WITH b AS (SELECT evaluated_at, le, sum(increase) AS n FROM ({_range_sql(("http_request_duration_seconds_bucket",), 300)}) GROUP BY 1, 2),
m AS (SELECT x.evaluated_at, x.le, max(y.n) AS n FROM b x JOIN b y ON x.evaluated_at = y.evaluated_at AND y.le <= x.le GROUP BY 1, 2),
t AS (SELECT evaluated_at, max(n) AS n, 0.95::DOUBLE * max(n) AS rank FROM m GROUP BY 1),
h AS (SELECT t.evaluated_at, t.n, rank, min(m.le) FILTER (WHERE m.n >= rank) AS up, max(m.le) FILTER (WHERE m.n < rank) AS low,
             min(m.n) FILTER (WHERE m.n >= rank) AS upto, max(m.n) FILTER (WHERE m.n < rank) AS below
      FROM t JOIN m USING (evaluated_at) GROUP BY 1, 2, 3),
q AS (SELECT evaluated_at, n, CASE WHEN n = 0 THEN NULL WHEN isinf(up) THEN low ELSE
        coalesce(low, 0) + (up - coalesce(low, 0)) * (rank - coalesce(below, 0)) / (upto - coalesce(below, 0)) END AS p95 FROM h)
SELECT evaluated_at, n AS observations, round(p95, 6) AS p95_latency, coalesce(p95 > 2.0, FALSE) AS firing FROM q""")
def q_histogram_p95(spark, sf):
    """p95 of the request durations of the last 5 minutes, over all instances, from bucket counters alone."""
    seconds, limit, _ = RULES["slow_response"]
    grown = R.increase(_samples(spark, sf, "http_request_duration_seconds_bucket"), "read_at", "value", ["instance", "le"], seconds, STEP)
    out = R.histogram_quantile(grown, 0.95, ["evaluated_at"], "le", "increase")
    return out.select("evaluated_at", "observations", F.round("quantile", 6).alias("p95_latency"),
                      F.coalesce(F.col("quantile") > limit, F.lit(False)).alias("firing"))


@register("counter_no_predictions", f"""
SELECT evaluated_at, sum(increase) AS predictions, sum(increase) = 0 AS firing
FROM ({_range_sql(("http_requests_total",), 600)}) GROUP BY 1""")
def q_counter_no_predictions(spark, sf):
    """Minutes in whose last ten no instance that is still read has served a request."""
    grown = R.increase(_samples(spark, sf, "http_requests_total"), "read_at", "value", ["instance"], RULES["no_predictions"][0], STEP)
    out = grown.groupBy("evaluated_at").agg(F.sum("increase").alias("predictions"))
    return out.withColumn("firing", F.col("predictions") == 0)


_CHECKS = {"error_rate": "counter_error_rate", "slow_response": "histogram_p95", "fraud_share": "counter_fraud_share",
           "no_predictions": "counter_no_predictions"}


@register("counter_alert_runs", _runs_sql(" UNION ALL ".join(
    f"SELECT '{rule}' AS alert, evaluated_at AS checked_at, firing FROM ({ORACLE[q]})" for rule, q in _CHECKS.items()),
    "alert", "checked_at", {rule: (hold, STEP) for rule, (_, _, hold) in RULES.items()}))
def q_counter_alert_runs(spark, sf):
    """Runs of minutes in which a rule over ranges holds, and whether it held as long as it must."""
    made = {"error_rate": q_counter_error_rate, "slow_response": q_histogram_p95, "fraud_share": q_counter_fraud_share,
            "no_predictions": q_counter_no_predictions}
    rows = reduce(DataFrame.unionByName, (q(spark, sf).select(F.lit(rule).alias("alert"), F.col("evaluated_at").alias("checked_at"), "firing")
                                          for rule, q in made.items()))
    return M.sustained_alert(rows, "checked_at", "alert", {rule: hold for rule, (_, _, hold) in RULES.items()}, STEP)
