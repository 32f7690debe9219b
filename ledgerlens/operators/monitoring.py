"""Monitoring over tables: consumer lag and health, throughput, windowed rates and alert rules.

The inputs are tables (an offsets table sampled per topic/partition, a request log), so every rule is a grouped
aggregate or a window over time-ordered checks: its size follows the number of checks, not the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.operators.joins import latest_per_key

def lag_by_check(offsets: DataFrame, ts: str = "sampled_at") -> DataFrame:
    """Per (check time, topic): totals over partitions; lag counts only partitions with a committed offset."""
    has = F.col("committed").isNotNull()
    return offsets.groupBy(ts, "topic").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum(F.coalesce(F.col("committed"), F.lit(0))).alias("total_committed"),
        F.sum("end").alias("total_end"),
        F.sum(F.when(has, F.col("end") - F.col("committed")).otherwise(0)).alias("total_lag"),
        F.max(has.cast("int")).cast("boolean").alias("consumer_group_exists"))


def consumer_lag(offsets: DataFrame, ts: str = "sampled_at") -> DataFrame:
    """Current lag per topic from the newest sample of each partition."""
    latest = latest_per_key(offsets, ["topic", "partition"], ts, ["committed", "end"])
    g = lag_by_check(latest.withColumn(ts, F.lit(0)), ts).drop(ts)
    return g.withColumn("status", F.when(F.col("consumer_group_exists"), "active_consumers")
                        .otherwise("no_active_consumers"))


def topic_health(lag: DataFrame, max_lag: int = 1000, warn_ratio: float = 0.7) -> Column:
    return (F.when(~F.col("consumer_group_exists"),
                   F.when(F.col("total_end") > 0, "pending_consumption").otherwise("waiting_consumers"))
            .when(F.col("total_lag") > max_lag, "critical")
            .when(F.col("total_lag") > max_lag * warn_ratio, "warning")
            .otherwise("healthy"))


def lag_health(offsets: DataFrame, max_lag: int = 1000, warn_ratio: float = 0.7, ts: str = "sampled_at") -> DataFrame:
    """Per check and topic: health; ``overall_health`` is the worst state among topics with consumers."""
    g = lag_by_check(offsets, ts).withColumn("health_status", topic_health(None, max_lag, warn_ratio))
    rank = (F.when(F.col("health_status") == "critical", 2).when(F.col("health_status") == "warning", 1)
            .otherwise(0))
    worst = F.max(rank).over(W.partitionBy(ts))
    overall = F.when(worst == 2, "critical").when(worst == 1, "warning").otherwise("healthy")
    return g.withColumn("overall_health", overall)


# fixed values: tag and priority of the advice for each finding; then our wording, followed by the finding's detail
ADVICE = {"critical": ("scaling", "high", "lag is above its limit: give the job more cores, or the topic more partitions"),
          "warning": ("monitoring", "medium", "lag comes near its limit: keep an eye on the rate of consumption"),
          "healthy": ("optimization", "low", "consumers keep up: batch size and trigger may be relaxed"),
          "unread": ("pending_processing", "medium", "messages that nobody reads, by topic: "),
          "no_consumer": ("consumer_setup", "high", "topics without a consumer: ")}


def lag_advice(health: DataFrame, ts: str = "sampled_at") -> DataFrame:
    """Recommendation rows per check: one for each finding of the check, worded by :data:`ADVICE`.

    Findings: topics without consumers, those of them that hold messages, and the worst health ('healthy' counts as a
    finding only if every topic has a consumer)."""
    unread = F.when(~F.col("consumer_group_exists"), F.col("topic"))
    amount = F.when(F.col("total_end") > 0, F.concat(unread, F.lit("="), F.col("total_end").cast("string")))
    found = health.groupBy(ts).agg(F.max("overall_health").alias("load"),
                                   F.array_join(F.array_sort(F.collect_set(unread)), ", ").alias("no_consumer"),
                                   F.array_join(F.array_sort(F.collect_set(amount)), ", ").alias("unread"))
    load = F.when((F.col("load") != "healthy") | (F.col("no_consumer") == ""), F.col("load"))
    finding = F.explode(F.map_from_arrays(
        F.array(F.coalesce(load, F.lit("-")), F.lit("no_consumer"), F.lit("unread")),
        F.array(F.lit(""), F.col("no_consumer"), F.col("unread")))).alias("finding", "detail")
    rows = found.select(ts, finding).filter(
        F.when(F.col("finding").isin("no_consumer", "unread"), F.col("detail") != "").otherwise(F.col("finding") != "-"))
    tags = F.create_map(*(x for k, v in ADVICE.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    tag = F.element_at(tags, F.col("finding"))
    return rows.select(ts, tag[0].alias("type"), tag[1].alias("priority"), F.concat(tag[2], F.col("detail")).alias("message"))


def lag_summary(health: DataFrame, critical_share: float = 0.1, ts: str = "sampled_at") -> DataFrame:
    """Share of checks per overall health; ``frequent_critical`` when critical checks exceed the share."""
    checks = health.select(ts, "overall_health").distinct()
    g = checks.groupBy("overall_health").agg(F.count(F.lit(1)).alias("checks"))
    total = F.sum("checks").over(W.partitionBy())
    crit = F.sum(F.when(F.col("overall_health") == "critical", F.col("checks")).otherwise(0)).over(W.partitionBy())
    return g.select("overall_health", "checks", total.alias("total_checks"),
                    F.round(F.col("checks") * 100.0 / total, 6).alias("pct"),
                    (crit > total * critical_share).alias("frequent_critical"))


def lag_rate(offsets: DataFrame, ts: str = "sampled_at") -> DataFrame:
    """Per topic and check: end offset growth per second since the previous check (0 for the first)."""
    g = offsets.groupBy("topic", ts).agg(F.sum("end").alias("total_end"))
    w = W.partitionBy("topic").orderBy(ts)
    prev_end, prev_ts = F.lag("total_end").over(w), F.lag(ts).over(w)
    secs = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(prev_ts.cast("timestamp"))) / 1e6
    rate = F.when(secs > 0, (F.col("total_end") - prev_end) / secs).otherwise(F.lit(0.0))
    return g.select("topic", ts, "total_end", F.round(F.coalesce(rate, F.lit(0.0)), 6).alias("estimated_tps"))


def throughput_report(log: DataFrame, ts: str, ok: Column, tps_target: float = 50.0) -> DataFrame:
    """Sent, failed, success %, mean TPS over the run, and whether targets were met."""
    span = (F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1e6
    g = log.agg(F.count_if(ok).alias("messages_sent"), F.count_if(~ok).alias("messages_error"), span.alias("runtime_seconds"))
    total = F.col("messages_sent") + F.col("messages_error")
    rate = F.when(total > 0, F.col("messages_sent") * 100.0 / total).otherwise(F.lit(0.0))
    tps = F.when(F.col("runtime_seconds") > 0, F.col("messages_sent") / F.col("runtime_seconds")).otherwise(F.lit(0.0))
    return g.select("messages_sent", "messages_error", F.round(rate, 6).alias("success_rate"),
                    F.round(tps, 6).alias("avg_tps"), F.round("runtime_seconds", 6).alias("runtime_seconds"),
                    (tps >= tps_target * 0.95).alias("tps_achieved"), (rate >= 99).alias("reliability_ok"),
                    ((tps >= tps_target * 0.95) & (rate >= 99)).alias("overall_success"))


# Load phases of the escalating replay (fixed values): name, target TPS, duration seconds
PHASES = [("phase_1", 500, 60), ("phase_2", 1000, 120), ("phase_3", 2000, 180), ("phase_4", 5000, 300)]


def phase_report(log: DataFrame, ts: str, phases=PHASES, tolerance: float = 0.9, min_ok: int = 3) -> DataFrame:
    """The run's time span is cut into consecutive phases in proportion to their durations; per phase the
    reached TPS (rows / phase seconds) is compared to the target.  ``attack_success`` when >= ``min_ok`` phases
    reach ``tolerance`` x target."""
    total = float(sum(p[2] for p in phases))
    from ledgerlens.operators.scalars import scalars
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    bd = scalars(log.agg(F.min(us).alias("_t0"), F.max(us).alias("_t1")))
    t0, t1 = bd["_t0"], bd["_t1"]
    frac = F.when(t1 > t0, (us - t0) / (t1 - t0)).otherwise(F.lit(0.0))
    edges, acc = [], 0.0
    for _, _, d in phases[:-1]:
        acc += d / total
        edges.append(acc)
    idx = F.lit(len(phases) - 1)
    for i in range(len(edges) - 1, -1, -1):
        idx = F.when(frac < edges[i], F.lit(i)).otherwise(idx)
    counts = log.groupBy(idx.alias("phase_index")).agg(F.count(F.lit(1)).alias("rows"))
    spec = log.sparkSession.createDataFrame([(i, n, t, d) for i, (n, t, d) in enumerate(phases)],
                                            "phase_index int, phase string, target_tps int, share_seconds int")
    r = spec.join(F.broadcast(counts), "phase_index", "left").fillna(0, ["rows"])
    secs = ((t1 - t0) / 1e6) * F.col("share_seconds") / F.lit(total)
    reached = F.when(secs > 0, F.col("rows") / secs).otherwise(F.lit(0.0))
    r = r.select("phase_index", "phase", "target_tps", "rows", F.round(reached, 6).alias("reached_tps"),
                 (reached >= F.col("target_tps") * tolerance).alias("ok"))
    n_ok = F.sum(F.col("ok").cast("int")).over(W.partitionBy())
    return r.withColumn("phases_ok", n_ok).withColumn("attack_success", n_ok >= min_ok)


def _windowed(df: DataFrame, ts: str, width: str, *aggs: Column) -> DataFrame:
    g = df.groupBy(F.window(F.col(ts), width).alias("w")).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


def rate_per_window(df: DataFrame, ts: str, width_seconds: int = 300) -> DataFrame:
    g = _windowed(df, ts, f"{width_seconds} seconds", F.count(F.lit(1)).alias("requests"))
    return g.withColumn("rate_per_s", F.round(F.col("requests") / F.lit(float(width_seconds)), 6))


def error_rate_alert(df: DataFrame, ts: str, is_error: Column, width_seconds: int = 300,
                     limit_pct: float = 5.0) -> DataFrame:
    g = _windowed(df, ts, f"{width_seconds} seconds", F.count(F.lit(1)).alias("requests"),
                  F.count_if(is_error).alias("errors"))
    pct = F.col("errors") * 100.0 / F.col("requests")
    return g.select("window_start", "window_end", "requests", "errors", F.round(pct, 6).alias("error_pct"),
                    (pct > limit_pct).alias("firing"))


def latency_alert(df: DataFrame, ts: str, latency: str, width_seconds: int = 300, p95_limit: float = 2.0,
                  mean_limit: float = 1.0, exact: bool = False) -> DataFrame:
    """p95 and mean latency (seconds) per window.

    The mean is computed in integer microseconds (exact sum, half-up integer division), so it does not depend
    on the order partial sums arrive in and is identical across re-runs and retries.  The default p95 is the
    bounded-memory GK sketch; ``exact`` computes the exact interpolated quantile per window with
    :func:`exact_quantile` (no group is buffered whole)."""
    win = df.select(F.window(F.col(ts), f"{width_seconds} seconds").alias("w"), latency) \
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), latency)
    keys = ["window_start", "window_end"]
    us = F.round(F.col(latency) * F.lit(1e6)).cast("long")
    agg = win.groupBy(*keys).agg(F.sum(us).alias("_sum_us"), F.count(latency).alias("_n"),
                                 *([] if exact else [F.percentile_approx(latency, F.lit(0.95), F.lit(1000)).alias("p95")]))
    agg = agg.withColumn("mean", F.expr("((2 * _sum_us + _n) div (2 * _n)) / 1e6"))
    if exact:
        from ledgerlens.operators.aggregates import exact_quantile
        agg = agg.join(exact_quantile(win, latency, 0.95, keys, name="p95"), keys)
    return agg.select(*keys, F.round("p95", 6).alias("p95_latency"), F.col("mean").alias("mean_latency"),
                      (F.col("p95") > p95_limit).alias("p95_alert"), (F.col("mean") > mean_limit).alias("mean_alert"))


def fraud_share_alert(df: DataFrame, ts: str, is_fraud: Column, width_seconds: int = 900,
                      limit_pct: float = 20.0) -> DataFrame:
    g = _windowed(df, ts, f"{width_seconds} seconds", F.count(F.lit(1)).alias("predictions"),
                  F.count_if(is_fraud).alias("fraud"))
    pct = F.col("fraud") * 100.0 / F.col("predictions")
    return g.select("window_start", "window_end", "predictions", "fraud", F.round(pct, 6).alias("fraud_pct"),
                    (pct > limit_pct).alias("firing"))


def _time_us(t) -> Column:
    return F.unix_micros((t if isinstance(t, Column) else F.lit(t)).cast("timestamp_ntz").cast("timestamp"))


def no_data_alert(df: DataFrame, ts: str, width_seconds: int = 600, as_of=None) -> DataFrame:
    """Every window from the first event to ``as_of`` (the time the rule is asked; default: the last event), with its
    count; windows without rows fire.

    So a stream that has died fires from its last event on, and one that never had an event fires in the window of
    ``as_of``.  The spine comes from one row of bounds."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    w_us = width_seconds * 1_000_000
    seen = df if as_of is None else df.filter(us <= _time_us(as_of))
    b = F.floor(us / F.lit(w_us))
    counts = seen.groupBy(b.alias("_b")).agg(F.count(F.lit(1)).alias("predictions"))
    # bounds of the per-window counts: the events are read once more for them, as one partial aggregate
    now = F.max("_b") if as_of is None else F.floor(_time_us(as_of) / F.lit(w_us))
    bounds = counts.agg(F.coalesce(F.min("_b"), now).alias("_b0"), now.alias("_b1")).filter("_b0 IS NOT NULL")
    spine = bounds.select(F.explode(F.sequence("_b0", "_b1")).alias("_b"))
    start = F.timestamp_micros(F.col("_b") * F.lit(w_us)).cast("timestamp_ntz")
    return (spine.join(counts, "_b", "left")
            .select(start.alias("window_start"), (start + F.make_dt_interval(secs=F.lit(width_seconds))).alias("window_end"),
                    F.coalesce(F.col("predictions"), F.lit(0)).alias("predictions"))
            .withColumn("no_data", F.col("predictions") == 0))


def queue_stalled(offsets: DataFrame, ts: str = "sampled_at", as_of=None) -> DataFrame:
    """Per topic and check: messages consumed since the previous check (committed offset growth) and waiting
    messages; ``stalled`` when nothing was consumed while messages wait.  A topic never committed consumes 0.

    ``as_of`` adds a check at that time with the last offsets known: nothing was seen to be consumed since."""
    g = offsets.groupBy("topic", ts).agg(F.sum(F.coalesce(F.col("committed"), F.lit(0))).alias("_c"),
                                         F.sum(F.col("end") - F.coalesce(F.col("committed"), F.lit(0))).alias("queue"))
    if as_of is not None:
        now = F.lit(as_of).cast("timestamp_ntz")
        g = g.filter(F.col(ts) <= now)
        last = g.groupBy("topic").agg(F.max(F.struct(ts, "_c", "queue")).alias("x"))
        g = g.unionByName(last.filter(F.col(f"x.{ts}") < now).select("topic", now.alias(ts), "x._c", "x.queue"))
    w = W.partitionBy("topic").orderBy(ts)
    g = g.withColumn("consumed", F.col("_c") - F.lag("_c").over(w))
    return g.select("topic", ts, "consumed", "queue",
                    ((F.coalesce(F.col("consumed"), F.lit(0)) == 0) & (F.col("queue") > 0)).alias("stalled"))


def threshold_alert(gauges: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Gauge samples (ts, metric, value) with their limit and whether they exceed it."""
    lim = F.lit(None).cast("double")
    for m, v in limits.items():
        lim = F.when(F.col("metric") == m, F.lit(float(v))).otherwise(lim)
    return gauges.withColumn("limit", lim).filter(F.col("limit").isNotNull()) \
                 .withColumn("firing", F.col("value") > F.col("limit"))


def _by_key(key: str, values) -> Column:
    """A number for each key of a dict, or the one number for all."""
    if not isinstance(values, dict):
        return F.lit(values).cast("double")
    out = F.lit(None).cast("double")
    for k, v in values.items():
        out = F.when(F.col(key) == k, F.lit(float(v))).otherwise(out)
    return out


def sustained_alert(firing: DataFrame, ts: str, key: str = "metric", for_seconds: int | dict = 120,
                    max_gap_seconds: int | dict | None = None, covers_seconds: int | dict = 0) -> DataFrame:
    """Gaps-and-islands over time-ordered checks per alert: each run of consecutive firing checks is one island; the alert
    fires when the run lasts at least ``for_seconds`` (one number or one a key).  A pause between two checks of more
    than ``max_gap_seconds`` ends a run: nothing is known of the time between.  ``covers_seconds``: time that a check at its
    ``ts`` stands for (the width of a window that starts there; 0 for a check at one moment); it counts to the run."""
    w = W.partitionBy(key).orderBy(ts)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = F.lit(False) if max_gap_seconds is None else (us - F.lag(us).over(w)) / 1e6 > _by_key(key, max_gap_seconds)
    change = F.when(F.lag("firing").over(w).isNull() | (F.lag("firing").over(w) != F.col("firing")) | gap, 1).otherwise(0)
    runs = firing.withColumn("_chg", change).withColumn("_run", F.sum("_chg").over(w.rowsBetween(W.unboundedPreceding, 0)))
    isl = runs.filter("firing").groupBy(key, "_run").agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
                                                        F.count(F.lit(1)).alias("checks"))
    dur = ((F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))) / 1e6
           + _by_key(key, covers_seconds))
    return isl.select(key, "start", "end", "checks", dur.alias("duration_seconds"),
                      (dur >= _by_key(key, for_seconds)).alias("fired")).drop("_run")
