"""Sources, cleaning, aggregates, top-k and scalar scorers over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import scoring as S
from ledgerlens.functions.hashing import sql_uniform, uniform
from ledgerlens.functions.timefix import MS_PER_YEAR, fix_hour_24, hour24_text, to_months_native, to_months_udf
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import cleaning as C
from ledgerlens.operators import labels as L
from ledgerlens.operators.joins import broadcast_if_small, left_equi_join
from ledgerlens.operators.sketches import day_sketches, range_quantiles
from ledgerlens.plans.common import (ALL_RAW, ANSWERS_SQL, EVAL_SQL, HUGE, LARGE, LECTURES_SQL, MEDIUM, NUMERIC_RAW,
                                     RANGE_COND_SQL, RAW_TX_SQL, TX_SQL, URLS_SQL, D, clean_sql, nonnull_sql,
                                     sigma_cond_sql, stats_sql)
from ledgerlens.plans.registry import register
from ledgerlens.session import scratch_path
from ledgerlens.sources import files as SRC
from ledgerlens.sources import testdata as T
from ledgerlens.streaming.jobs import to_envelope, unwrap_envelope, well_formed

# ============================================================================================ sources and sinks

@register("read_transactions", RAW_TX_SQL)
def q_read_transactions(spark, sf):
    return T.raw_transactions(spark, sf)


@register("drop_header", RAW_TX_SQL)
def q_drop_header(spark, sf):
    parsed = SRC.read_transactions(spark, T.raw_transaction_dir(spark, sf), drop_header_rows=False)
    return SRC.drop_header(parsed, "transaction_id")


@register("read_csv_inferred", f"""
SELECT CAST(transaction_id AS INTEGER) AS transaction_id, tx_datetime, CAST(customer_id AS INTEGER) AS customer_id,
       CAST(terminal_id AS INTEGER) AS terminal_id, tx_amount, tx_time_seconds, tx_time_days, tx_fraud,
       tx_fraud_scenario
FROM ({TX_SQL})""")
def q_read_csv_inferred(spark, sf):
    df = SRC.read_csv_inferred(spark, T.csv_with_header_dir(spark, sf))
    # the datetime text is inferred as a timestamp; render it back to the source text for comparison
    return df.withColumn("tx_datetime", F.date_format(F.col("tx_datetime"), "yyyy-MM-dd HH:mm:ss"))


@register("read_csv_comment", "SELECT CAST(event_id % 100 AS INTEGER) AS field FROM events")
def q_read_csv_comment(spark, sf):
    return SRC.read_csv_comment(spark, T.sum_input_dir(spark, sf))


@register("global_sum", "SELECT CAST(sum(event_id % 100) AS BIGINT) AS result FROM events")
def q_global_sum(spark, sf):
    return A.global_sum(SRC.read_csv_comment(spark, T.sum_input_dir(spark, sf)), "field", "result")


@register("write_read_parquet", TX_SQL)
def q_write_read_parquet(spark, sf):
    path = scratch_path(spark, "tx-parquet")
    SRC.write_parquet(T.transactions(spark, sf), path)
    return SRC.read_parquet(spark, path)


@register("repartition_convert", RAW_TX_SQL)
def q_repartition_convert(spark, sf):
    return SRC.repartition_convert(spark, T.raw_transaction_dir(spark, sf), scratch_path(spark, "tx-converted"))


@register("copy_dataset", "SELECT * FROM lineitem")
def q_copy_dataset(spark, sf):
    return SRC.copy_dataset(spark, f"{sf.rstrip('/')}/lineitem.parquet", scratch_path(spark, "lineitem-copy"))


@register("count_rows", f"SELECT count(*) AS n_rows FROM ({RAW_TX_SQL})")
def q_count_rows(spark, sf):
    return A.count_rows(T.raw_transactions(spark, sf))


# ============================================================================================ cleaning

@register("drop_na", nonnull_sql(RAW_TX_SQL))
def q_drop_na(spark, sf):
    return C.drop_na(T.raw_transactions(spark, sf))


def _facts(df, names, out):
    """One row per column: its name and how many rows have a value, from one pass over the table."""
    facts = F.explode(F.array(*(F.struct(F.lit(c).alias(out), F.col(c).alias("n_values")) for c in names))).alias("x")
    return df.agg(*(F.count(c).alias(c) for c in names)).select(facts).select("x.*")


def _facts_sql(out, cols, src):
    return " UNION ALL ".join(f"SELECT '{c}' AS {out}, count({c}) AS n_values FROM ({src})" for c in cols)


@register("numeric_columns", _facts_sql("column_name", NUMERIC_RAW, RAW_TX_SQL))
def q_numeric_columns(spark, sf):
    raw = T.raw_transactions(spark, sf)
    return _facts(raw, C.numeric_columns(raw), "column_name")


@register("column_stats", "SELECT " + ", ".join(
    [f"round({c}_mean, 6) AS {c}_mean" for c in NUMERIC_RAW] + [f"round({c}_std, 6) AS {c}_std" for c in NUMERIC_RAW])
    + f" FROM ({stats_sql(nonnull_sql(RAW_TX_SQL))})")
def q_column_stats(spark, sf):
    st = C.column_stats(C.drop_na(T.raw_transactions(spark, sf)))
    return st.select(*[F.round(c, 6).alias(c) for c in st.columns])


@register("sigma_filter", f"""
SELECT {', '.join('t.' + c for c in ALL_RAW)} FROM ({nonnull_sql(RAW_TX_SQL)}) t, ({stats_sql(nonnull_sql(RAW_TX_SQL))}) s
WHERE {sigma_cond_sql()}""")
def q_sigma_filter(spark, sf):
    return C.sigma_filter(C.drop_na(T.raw_transactions(spark, sf)))


@register("range_rules", f"SELECT * FROM ({nonnull_sql(RAW_TX_SQL)}) WHERE {RANGE_COND_SQL}")
def q_range_rules(spark, sf):
    return C.range_rules(C.drop_na(T.raw_transactions(spark, sf)))


def _clean_report_sql():
    nn = " AND ".join(f"{c} IS NOT NULL" for c in ALL_RAW)
    stats = ", ".join([f"avg(CASE WHEN nn THEN {c} END) AS {c}_mean" for c in NUMERIC_RAW] +
                      [f"stddev_samp(CASE WHEN nn THEN {c} END) AS {c}_std" for c in NUMERIC_RAW])
    return f"""
WITH r AS (SELECT *, ({nn}) AS nn FROM ({RAW_TX_SQL})), s AS (SELECT {stats} FROM r),
f AS (SELECT r.nn, r.nn AND {sigma_cond_sql('r', 's')} AS sig, r.* FROM r, s)
SELECT count(*) AS rows_read, count(*) FILTER (WHERE nn) AS rows_after_drop_na,
       count(*) FILTER (WHERE sig) AS rows_after_sigma,
       count(*) FILTER (WHERE sig AND {RANGE_COND_SQL}) AS rows_after_range
FROM f"""


@register("clean_report", _clean_report_sql())
def q_clean_report(spark, sf):
    return C.clean_report(T.raw_transactions(spark, sf))


@register("clean_transactions", clean_sql())
def q_clean_transactions(spark, sf):
    return C.clean_transactions(T.raw_transactions(spark, sf))


@register("class_balance", f"""
SELECT positives, negatives, total, round(CAST(positives AS DOUBLE) * 100.0 / total, 6) AS positive_pct,
       round(CAST(negatives AS DOUBLE) * 100.0 / total, 6) AS negative_pct
FROM (SELECT count(*) FILTER (WHERE tx_fraud = 1) AS positives, count(*) FILTER (WHERE tx_fraud = 0) AS negatives,
             count(*) AS total FROM ({clean_sql()}))""")
def q_class_balance(spark, sf):
    return L.class_balance(C.clean_transactions(T.raw_transactions(spark, sf)))


@register("fix_hour_24", """
SELECT event_id AS transaction_id,
       CASE WHEN hour(ts) = 0 THEN strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') || ' 24:' || strftime(ts, '%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS tx_datetime_raw,
       date_trunc('second', ts) AS tx_datetime
FROM events""")
def q_fix_hour_24(spark, sf):
    ev = T.table(spark, sf, "events")
    raw = ev.select(F.col("event_id").alias("transaction_id"), hour24_text("ts").alias("tx_datetime_raw"))
    return raw.withColumn("tx_datetime", fix_hour_24("tx_datetime_raw"))


@register("encode_label", f"""
SELECT page_id, url, label, CASE label WHEN 'bad' THEN 1 WHEN 'good' THEN 0 END AS label_enc FROM ({URLS_SQL})""")
def q_encode_label(spark, sf):
    u = T.labelled_urls(spark, sf)
    return u.withColumn("label_enc", L.encode_label("label"))


@register("select_features", _facts_sql("feature", [c for c in NUMERIC_RAW if c not in ("tx_fraud", "transaction_id")],
                                       RAW_TX_SQL))
def q_select_features(spark, sf):
    raw = T.raw_transactions(spark, sf)
    return _facts(raw, L.select_features(raw, target="tx_fraud"), "feature")


@register("find_label_columns", f"""
SELECT 'tx_fraud' AS column_name, CAST(v AS VARCHAR) AS value
FROM (SELECT DISTINCT tx_fraud AS v FROM ({RAW_TX_SQL}) ORDER BY v NULLS FIRST LIMIT 10)
UNION ALL
SELECT 'tx_fraud_scenario', CAST(v AS VARCHAR)
FROM (SELECT DISTINCT tx_fraud_scenario AS v FROM ({RAW_TX_SQL}) ORDER BY v NULLS FIRST LIMIT 10)""")
def q_find_label_columns(spark, sf):
    return L.find_label_columns(T.raw_transactions(spark, sf))


@register("distinct_values", f"""
SELECT DISTINCT terminal_id FROM ({TX_SQL}) ORDER BY terminal_id LIMIT 10""")
def q_distinct_values(spark, sf):
    return L.distinct_values(T.transactions(spark, sf), "terminal_id", 10)


@register("sample_frac", f"SELECT * FROM ({TX_SQL}) WHERE {sql_uniform('transaction_id', 42)} < {D(0.1)}")
def q_sample_frac(spark, sf):
    return L.sample_frac(T.transactions(spark, sf), 0.1, "transaction_id", 42)


@register("sample_n", f"""
SELECT * FROM ({TX_SQL}) ORDER BY {sql_uniform('transaction_id', 42)}, transaction_id LIMIT 1000""")
def q_sample_n(spark, sf):
    return L.sample_n(T.transactions(spark, sf), 1000, "transaction_id", 42)


@register("random_split", f"""
SELECT *, CASE WHEN {sql_uniform('transaction_id', 42)} < {D(0.8)} THEN 0 ELSE 1 END AS split FROM ({TX_SQL})""")
def q_random_split(spark, sf):
    return L.with_split(T.transactions(spark, sf), "transaction_id", (0.8, 0.2), 42)


# ============================================================================================ joins and aggregates

_LEC_JOIN_SQL = f"""
SELECT a.*, l.* FROM ({ANSWERS_SQL}) a LEFT JOIN ({LECTURES_SQL}) l ON a.content_id = l.lecture_id
WHERE a.content_type_id = 1"""


def _lecture_join(spark, sf):
    return left_equi_join(T.answers(spark, sf), T.lectures(spark, sf), "content_id", "lecture_id", "left",
                          F.col("content_type_id") == 1)


@register("left_equi_join", _LEC_JOIN_SQL)
def q_left_equi_join(spark, sf):
    return _lecture_join(spark, sf)


@register("group_count", f"SELECT tag, count(*) AS count FROM ({_LEC_JOIN_SQL}) GROUP BY tag")
def q_group_count(spark, sf):
    return A.group_count(_lecture_join(spark, sf), "tag")


@register("top_k_tags", f"""
SELECT tag, count(*) AS count FROM ({_LEC_JOIN_SQL}) GROUP BY tag ORDER BY count DESC, tag NULLS FIRST LIMIT 10""")
def q_top_k_tags(spark, sf):
    g = A.group_count(_lecture_join(spark, sf), "tag")
    return A.top_k(g, [F.col("count").desc(), F.col("tag").asc_nulls_first()], 10)


@register("group_mean_content", f"""
SELECT content_id, avg(answered_correctly) AS avg_answered_correctly FROM ({ANSWERS_SQL}) GROUP BY content_id""")
def q_group_mean_content(spark, sf):
    return A.group_mean(T.answers(spark, sf), "content_id", "answered_correctly")


@register("group_mean_user", f"""
SELECT user_id, avg(answered_correctly) AS avg_answered_correctly FROM ({ANSWERS_SQL}) GROUP BY user_id""")
def q_group_mean_user(spark, sf):
    return A.group_mean(T.answers(spark, sf), "user_id", "answered_correctly")


@register("top_k_users", f"""
SELECT user_id, avg(answered_correctly) AS avg_answered_correctly FROM ({ANSWERS_SQL}) GROUP BY user_id
ORDER BY avg_answered_correctly DESC, user_id LIMIT 10""")
def q_top_k_users(spark, sf):
    g = A.group_mean(T.answers(spark, sf), "user_id", "answered_correctly")
    return A.top_k(g, [F.col("avg_answered_correctly").desc(), F.col("user_id")], 10)


@register("top_k_worst_content", f"""
SELECT content_id, avg(answered_correctly) AS avg_answered_correctly FROM ({ANSWERS_SQL})
WHERE answered_correctly >= 0 GROUP BY content_id ORDER BY avg_answered_correctly, content_id LIMIT 10""")
def q_top_k_worst_content(spark, sf):
    g = A.group_mean(T.answers(spark, sf).filter(F.col("answered_correctly") >= 0), "content_id", "answered_correctly")
    return A.top_k(g, [F.col("avg_answered_correctly").asc(), F.col("content_id")], 10)


@register("limit_rows", f"SELECT * FROM ({TX_SQL}) ORDER BY transaction_id LIMIT 10")
def q_limit_rows(spark, sf):
    return A.top_k(T.transactions(spark, sf), [F.col("transaction_id")], 10)


@register("to_months_udf", f"""
SELECT content_id, avg(timestamp // {MS_PER_YEAR} // 12) AS avg_months FROM ({ANSWERS_SQL}) GROUP BY content_id""")
def q_to_months_udf(spark, sf):
    a = T.answers(spark, sf)
    return a.select("content_id", to_months_udf()(F.col("timestamp")).alias("months")) \
            .groupBy("content_id").agg(F.avg("months").alias("avg_months"))


@register("months_native", f"""
SELECT content_id, avg(timestamp / {MS_PER_YEAR} / 12) AS avg_months FROM ({ANSWERS_SQL}) GROUP BY content_id""")
def q_months_native(spark, sf):
    a = T.answers(spark, sf)
    return a.select("content_id", to_months_native("timestamp", integer=False).alias("months")) \
            .groupBy("content_id").agg(F.avg("months").alias("avg_months"))


@register("equal_width_histogram", f"""
WITH x AS (SELECT timestamp / {MS_PER_YEAR} / 12 AS v FROM ({ANSWERS_SQL})),
m AS (SELECT min(v) AS mn, max(v) AS mx FROM x),
c AS (SELECT CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((v - mn) / (mx - mn) * 100), 99) END AS INTEGER) AS bucket,
             count(*) AS frequency FROM x, m GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS bucket, round(mn + CAST(r.range AS INTEGER) * ((mx - mn) / {D(100.0)}), 6) AS lo,
       round(CASE WHEN r.range = 99 THEN mx ELSE mn + (CAST(r.range AS INTEGER) + 1) * ((mx - mn) / {D(100.0)}) END, 6) AS hi,
       coalesce(c.frequency, 0) AS frequency
FROM range(100) r CROSS JOIN m LEFT JOIN c ON c.bucket = r.range""")
def q_equal_width_histogram(spark, sf):
    a = T.answers(spark, sf).select(to_months_native("timestamp", integer=False).alias("months"))
    return A.equal_width_histogram(a, "months", 100)


@register("approx_percentile", "SELECT TRUE AS within_error, count(*) AS n FROM events")
def q_approx_percentile(spark, sf):
    """The approximate quantile is a value whose rank is within 1 % of the rows of the one asked for."""
    tx = T.transactions(spark, sf)
    p = A.approx_percentile(tx, "tx_amount", 0.98, 0.01).select("p98").scalar()
    below = tx.agg(F.count_if(F.col("tx_amount") < p).alias("lt"), F.count_if(F.col("tx_amount") <= p).alias("le"),
                   F.count(F.lit(1)).alias("n"))
    return below.select(((F.col("lt") <= 0.99 * F.col("n")) & (F.col("le") >= 0.97 * F.col("n"))).alias("within_error"), "n")


SKETCH_DAYS = 7


@register("sketch_percentile", f"""
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(value) AS n FROM events GROUP BY ALL HAVING count(value) > 0)
SELECT CAST(r.day - {SKETCH_DAYS - 1} AS TIMESTAMP) AS first_day, CAST(r.day AS TIMESTAMP) AS last_day, CAST(sum(d.n) AS BIGINT) AS n,
       TRUE AS p50_within, TRUE AS p98_within
FROM d r JOIN d ON d.day BETWEEN r.day - {SKETCH_DAYS - 1} AND r.day GROUP BY ALL""")
def q_sketch_percentile(spark, sf):
    """Trailing weeks from daily sketches; the exact ranks of both quantiles lie within 1 % of those asked for."""
    ev = T.table(spark, sf, "events").select("ts", "value")
    path = scratch_path(spark, "day-sketches")
    day_sketches(ev, "ts", "value").write.parquet(path)
    daily = spark.read.parquet(path)
    weeks = daily.select(F.date_sub("day", SKETCH_DAYS - 1).alias("first_day"), F.col("day").alias("last_day"))
    q = range_quantiles(daily, weeks, {"p50": 0.5, "p98": 0.98})
    # the check: every value under the at most seven weeks it counts for, which differ from day to day
    ends = q.select("first_day", "last_day", "p50", "p98", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    rows = ev.filter("value IS NOT NULL").select(F.to_date("ts").alias("day"), "value").join(broadcast_if_small(ends), "day")
    ranks = rows.groupBy("first_day", "last_day").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(f"value {op} {p}")).alias(f"{p}_{name}")
                                        for p in ("p50", "p98") for name, op in (("lt", "<"), ("le", "<="))])
    within = [((F.col(f"{p}_lt") <= (w + 0.01) * F.col("n")) & (F.col(f"{p}_le") >= (w - 0.01) * F.col("n"))).alias(f"{p}_within")
              for p, w in (("p50", 0.5), ("p98", 0.98))]
    out = q.select("first_day", "last_day", "n").join(
        ranks.select("first_day", "last_day", *within), ["first_day", "last_day"], "left")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_day", "last_day")})


@register("exact_percentile", f"SELECT quantile_cont(tx_amount, 0.98) AS p98 FROM ({TX_SQL})")
def q_exact_percentile(spark, sf):
    return A.exact_percentile(T.transactions(spark, sf), "tx_amount", 0.98)


# duration buckets of the prediction-time histogram (fixed values)
DURATION_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]


def _fixed_hist_sql():
    vals = ", ".join(f"({i}, '{repr(float(b))}', {D(b)})" for i, b in enumerate(DURATION_BUCKETS))
    return f"""
WITH x AS (SELECT value / 100.0 AS latency_s FROM events),
b AS (SELECT * FROM (VALUES {vals}, ({len(DURATION_BUCKETS)}, '+Inf', 'inf'::DOUBLE)) t(i, le, bound)),
tot AS (SELECT count(latency_s) AS n, round(sum(latency_s), 6) AS s FROM x)
SELECT 'latency_s' AS metric, b.le,
       (SELECT count(*) FROM x WHERE x.latency_s <= b.bound) AS cumulative_count, tot.s AS sum, tot.n AS count
FROM b, tot"""


@register("fixed_bucket_histogram", _fixed_hist_sql())
def q_fixed_bucket_histogram(spark, sf):
    log = T.table(spark, sf, "events").select((F.col("value") / 100.0).alias("latency_s"))
    return A.fixed_bucket_histogram(log, "latency_s", DURATION_BUCKETS)


@register("confusion_matrix", f"""
SELECT y_test, y_pred_base, count(*) AS count FROM ({EVAL_SQL}) GROUP BY ALL""")
def q_confusion_matrix(spark, sf):
    return A.confusion_matrix(T.evaluation(spark, sf), "y_test", "y_pred_base")


# ============================================================================================ scalar scorers

def _request_scored(spark, sf):
    tx = T.transactions(spark, sf)
    p = S.request_risk_score("tx_amount", "tx_time_seconds", "customer_id", large=LARGE, medium=MEDIUM)
    return tx.withColumn("fraud_probability", p)


_REQ_P_SQL = S.request_risk_score_sql("tx_amount", "tx_time_seconds", "customer_id", large=LARGE, medium=MEDIUM)


@register("request_risk_score", f"""
SELECT transaction_id, round({_REQ_P_SQL}, 6) AS fraud_probability FROM ({TX_SQL})""")
def q_request_risk_score(spark, sf):
    return _request_scored(spark, sf).select("transaction_id", F.round("fraud_probability", 6).alias("fraud_probability"))


@register("risk_band", f"""
SELECT transaction_id, {S.risk_band_sql(_REQ_P_SQL)} AS risk_level FROM ({TX_SQL})""")
def q_risk_band(spark, sf):
    return _request_scored(spark, sf).select("transaction_id", S.risk_band("fraud_probability").alias("risk_level"))


@register("confidence", f"""
SELECT transaction_id, round({S.confidence_sql(_REQ_P_SQL)}, 6) AS confidence_score FROM ({TX_SQL})""")
def q_confidence(spark, sf):
    return _request_scored(spark, sf).select(
        "transaction_id", F.round(S.confidence("fraud_probability"), 6).alias("confidence_score"))


@register("confidence_binary", f"""
SELECT transaction_id, round(greatest(0.0, least(1.0, p)), 6) AS probability,
       greatest(0.0, least(1.0, p)) >= 0.5 AS is_fraud,
       round(abs(greatest(0.0, least(1.0, p)) - 0.5) * 2.0, 6) AS confidence
FROM (SELECT transaction_id, {_REQ_P_SQL} AS p FROM ({TX_SQL}))""")
def q_confidence_binary(spark, sf):
    r = _request_scored(spark, sf).select("transaction_id", S.confidence_binary("fraud_probability").alias("c"))
    return r.select("transaction_id", F.round("c.probability", 6).alias("probability"), "c.is_fraud",
                    F.round("c.confidence", 6).alias("confidence"))


_BAL_SRC_SQL = """
SELECT o.o_orderkey, o.o_totalprice / 100.0 AS amount, o.o_orderkey % 24 AS hour, c.c_acctbal AS account_balance
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


@register("balance_risk_score", f"""
SELECT o_orderkey, round(s, 6) AS fraud_score, s > 0.5 AS is_fraud
FROM (SELECT o_orderkey, {S.balance_risk_score_sql('amount', 'hour', 'account_balance')} AS s FROM ({_BAL_SRC_SQL}))""")
def q_balance_risk_score(spark, sf):
    o = T.table(spark, sf, "orders")
    c = T.table(spark, sf, "customer")
    j = o.join(broadcast_if_small(c), o.o_custkey == c.c_custkey)
    s = S.balance_risk_score(F.col("o_totalprice") / 100.0, F.pmod(F.col("o_orderkey"), F.lit(24)), F.col("c_acctbal"))
    return j.select("o_orderkey", s.alias("s")).select(
        "o_orderkey", F.round("s", 6).alias("fraud_score"), (F.col("s") > 0.5).alias("is_fraud"))


@register("threshold_score", f"""
SELECT transaction_id, {S.threshold_is_fraud_sql('tx_amount', 'tx_fraud_scenario', LARGE)} AS is_fraud,
       CASE WHEN {S.threshold_is_fraud_sql('tx_amount', 'tx_fraud_scenario', LARGE)} THEN {D(0.8)} ELSE {D(0.2)} END
         AS fraud_probability,
       {D(0.9)} AS confidence
FROM ({TX_SQL})""")
def q_threshold_score(spark, sf):
    tx = T.transactions(spark, sf)
    f = S.threshold_is_fraud("tx_amount", "tx_fraud_scenario", LARGE)
    return tx.select("transaction_id", f.alias("is_fraud"), S.threshold_probability(f).alias("fraud_probability"),
                     F.lit(0.9).alias("confidence"))


_HEUR_PRED_SQL, _HEUR_PROB_SQL = S.stream_heuristic_sql("tx_amount", "transaction_id", HUGE)


def _heuristic(spark, sf):
    tx = T.transactions(spark, sf)
    return tx.withColumn("ml_result", S.stream_heuristic("tx_amount", "transaction_id", HUGE))


@register("stream_heuristic", f"""
SELECT transaction_id, {_HEUR_PRED_SQL} AS fraud_prediction, {_HEUR_PROB_SQL} AS fraud_probability,
       CASE WHEN {_HEUR_PRED_SQL} >= 0.5 THEN 'FRAUD' ELSE 'NORMAL' END AS fraud_label
FROM ({TX_SQL})""")
def q_stream_heuristic(spark, sf):
    h = _heuristic(spark, sf)
    return h.select("transaction_id", F.col("ml_result.prediction").alias("fraud_prediction"),
                    F.col("ml_result.probability").alias("fraud_probability"),
                    S.fraud_label(F.col("ml_result.prediction")).alias("fraud_label"))


@register("fraud_label", f"""
SELECT transaction_id, CASE WHEN {_HEUR_PRED_SQL} >= 0.5 THEN 'FRAUD' ELSE 'NORMAL' END AS fraud_label,
       CASE WHEN {_HEUR_PRED_SQL} = 1.0 THEN 'FRAUD' ELSE 'NORMAL' END AS fraud_label_exact
FROM ({TX_SQL})""")
def q_fraud_label(spark, sf):
    h = _heuristic(spark, sf)
    p = F.col("ml_result.prediction")
    return h.select("transaction_id", S.fraud_label(p).alias("fraud_label"),
                    S.fraud_label(p, exact_one=True).alias("fraud_label_exact"))


@register("map_get", f"""
SELECT transaction_id, {_HEUR_PRED_SQL} AS fraud_prediction, {_HEUR_PROB_SQL} AS fraud_probability FROM ({TX_SQL})""")
def q_map_get(spark, sf):
    h = _heuristic(spark, sf)
    m = F.create_map(F.lit("prediction"), F.col("ml_result.prediction"),
                     F.lit("probability"), F.col("ml_result.probability"))
    return h.select("transaction_id", m.alias("ml_result")).select(
        "transaction_id", F.col("ml_result").getItem("prediction").alias("fraud_prediction"),
        F.col("ml_result").getItem("probability").alias("fraud_probability"))


@register("label_share", f"""
SELECT fraud_label, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share
FROM (SELECT CASE WHEN {_HEUR_PRED_SQL} >= 0.5 THEN 'FRAUD' ELSE 'NORMAL' END AS fraud_label, count(*) AS n
      FROM ({TX_SQL}) GROUP BY 1)""")
def q_label_share(spark, sf):
    h = _heuristic(spark, sf).withColumn("fraud_label", S.fraud_label(F.col("ml_result.prediction")))
    return A.label_share(h, "fraud_label")


@register("is_large_tx", f"""
SELECT transaction_id, CAST(tx_amount > {D(LARGE)} AS INTEGER) AS is_large_tx FROM ({TX_SQL})""")
def q_is_large_tx(spark, sf):
    tx = T.transactions(spark, sf)
    return tx.select("transaction_id", S.is_large_tx("tx_amount", LARGE).alias("is_large_tx"))


@register("validate_request", f"""
SELECT transaction_id, v AS violations, v = '' AS is_valid
FROM (SELECT transaction_id, {S.request_violations_sql()} AS v FROM ({RAW_TX_SQL}))""")
def q_validate_request(spark, sf):
    raw = T.raw_transactions(spark, sf)
    v = S.request_violations()
    return raw.select("transaction_id", F.array_join(v, ",").alias("violations"), (F.size(v) == 0).alias("is_valid"))


# ============================================================================================ JSON envelope

SENT = "2024-02-01 00:00:00"


def _sent(raw):
    return raw.select(to_envelope(raw, sent_at=F.lit(SENT).cast("timestamp_ntz")).alias("value"))


def _raw_json_sql():
    """The envelope's text, field by field; null fields are left out."""
    text = lambda c: f"CASE WHEN {c} IS NULL THEN NULL ELSE '\"{c}\":\"' || {c} || '\"' END"
    number = lambda c: f"'\"{c}\":' || CAST({c} AS VARCHAR)"
    fields = ", ".join(text(c) if c == "tx_datetime" else number(c) for c in ALL_RAW)
    micros = f"CAST(epoch_us(TIMESTAMP '{SENT}') AS VARCHAR)"
    return (f"'{{\"transaction_id\":\"tx_' || {micros} || '_' || transaction_id || '\",\"stream_timestamp\":\"{SENT.replace(' ', 'T')}"
            f".000000\",\"producer_id\":\"replay\",\"producer_config\":{{\"tps_target\":50,\"topic\":\"transactions-input\"}},"
            f"\"data\":{{' || concat_ws(',', {fields}) || '}}}}'")


@register("drop_nulls_to_envelope", f"""
SELECT replace(v, '.0,', ',') AS value FROM (SELECT {_raw_json_sql()} AS v FROM ({RAW_TX_SQL}))""")
def q_drop_nulls_to_envelope(spark, sf):
    # whole amounts are written as 12.0 by one engine and 12.0 or 12 by the other
    return _sent(T.raw_transactions(spark, sf)).select(F.replace("value", F.lit(".0,"), F.lit(",")).alias("value"))


@register("unwrap_envelope", f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, tx_datetime, CAST(customer_id AS BIGINT) AS customer_id,
       CAST(terminal_id AS BIGINT) AS terminal_id, tx_amount, tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario
FROM ({RAW_TX_SQL})""")
def q_unwrap_envelope(spark, sf):
    return well_formed(unwrap_envelope(_sent(T.raw_transactions(spark, sf))))


@register("json_roundtrip", TX_SQL)
def q_json_roundtrip(spark, sf):
    tx = T.transactions(spark, sf)
    schema = tx.schema
    js = tx.select(F.to_json(F.struct(*tx.columns)).alias("value"))
    return js.select(F.from_json("value", schema).alias("r")).select("r.*")
