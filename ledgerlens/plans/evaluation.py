"""Evaluation queries: metrics from confusion counts, AUC, bootstrap, intervals, t-test, decision, model table."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import functions as F

from ledgerlens.functions import scoring as S
from ledgerlens.functions.hashing import sql_poisson
from ledgerlens.functions.stats import t_quantile_sql, t_two_sided_p_sql
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import evaluation as E
from ledgerlens.plans.common import EVAL_SQL, LARGE, MEDIUM, TX_SQL, D
from ledgerlens.plans.registry import register
from ledgerlens.sources import testdata as T

N_ITER = 100
SEED = 42
PREDICTIONS = {"base": "y_pred_base", "cand": "y_pred_cand"}
METRICS = ("f1", "precision", "recall", "auc")


def _metrics_sql(src: str, keep: str, digits: int | None = 6) -> str:
    r = (lambda e: f"round({e}, {digits})") if digits is not None else (lambda e: e)
    return f"""
SELECT {keep}, tp, fp, fn, tn,
       {r("CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END")} AS precision,
       {r("CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END")} AS recall,
       {r("CASE WHEN 2 * tp + fp + fn <> 0 THEN CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0.0 END")} AS f1,
       {r("((CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END) + (CASE WHEN tn + fp <> 0 THEN CAST(tn AS DOUBLE) / CAST(tn + fp AS DOUBLE) END)) / 2")} AS auc
FROM ({src})"""


def _cells_sql(src: str, pred: str, w: str = "1", by: str = "", model: str | None = None) -> str:
    sel = (f"'{model}' AS model, " if model else "") + (f"{by}, " if by else "")
    grp = f" GROUP BY {by}" if by else ""
    return f"""
SELECT {sel}CAST(sum(CASE WHEN y_test = 1 AND {pred} >= 0.5 THEN {w} ELSE 0 END) AS BIGINT) AS tp,
       CAST(sum(CASE WHEN y_test <> 1 AND {pred} >= 0.5 THEN {w} ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN y_test = 1 AND {pred} < 0.5 THEN {w} ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN y_test <> 1 AND {pred} < 0.5 THEN {w} ELSE 0 END) AS BIGINT) AS tn
FROM {src}{grp}"""


def _eval(spark, sf):
    return T.evaluation(spark, sf)


@register("eval_binary", _metrics_sql(_cells_sql(f"({EVAL_SQL})", "y_pred_base"), "1 AS _one").replace(
    "SELECT 1 AS _one, ", "SELECT "))
def q_eval_binary(spark, sf):
    return E.eval_binary(_eval(spark, sf), "y_test", "y_pred_base")


@register("eval_auc_label", "SELECT auc FROM (" + _metrics_sql(_cells_sql(f"({EVAL_SQL})", "y_pred_base"),
                                                               "1 AS _one") + ")")
def q_eval_auc_label(spark, sf):
    return E.eval_auc_label(_eval(spark, sf), "y_test", "y_pred_base")


@register("eval_weighted", f"""
WITH e AS ({EVAL_SQL}),
c AS (SELECT CAST(y_test AS DOUBLE) AS y, CAST(y_pred_base AS DOUBLE) AS p, count(*) AS n FROM e GROUP BY ALL),
l AS (SELECT y, sum(n) AS n_label, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM c GROUP BY y),
pr AS (SELECT p AS y, sum(n) AS n_pred FROM c GROUP BY p),
cls AS (SELECT coalesce(l.n_label, 0) AS n_label, coalesce(l.tp, 0) AS tp, coalesce(pr.n_pred, 0) AS n_pred
        FROM l FULL JOIN pr ON l.y = pr.y),
m AS (SELECT *, CASE WHEN n_pred <> 0 THEN CAST(tp AS DOUBLE) / CAST(n_pred AS DOUBLE) ELSE 0.0 END AS prec,
             CASE WHEN n_label <> 0 THEN CAST(tp AS DOUBLE) / CAST(n_label AS DOUBLE) ELSE 0.0 END AS rec FROM cls)
SELECT round(sum(tp) / sum(n_label), 6) AS accuracy, round(sum(n_label * prec) / sum(n_label), 6) AS weighted_precision,
       round(sum(n_label * rec) / sum(n_label), 6) AS weighted_recall,
       round(sum(n_label * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) / sum(n_label), 6)
         AS weighted_f1
FROM m""")
def q_eval_weighted(spark, sf):
    return E.eval_weighted(_eval(spark, sf), "y_test", "y_pred_base")


_REQ_P_SQL = S.request_risk_score_sql("tx_amount", "tx_time_seconds", "customer_id", large=LARGE, medium=MEDIUM)


@register("eval_auc_score", f"""
WITH s AS (SELECT tx_fraud AS y, {_REQ_P_SQL} AS s FROM ({TX_SQL})),
r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar FROM s),
c AS (SELECT CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS np, CAST(count(*) FILTER (WHERE y <> 1) AS DOUBLE) AS nn FROM s)
SELECT round((sum(ar) FILTER (WHERE y = 1) - max(np) * (max(np) + 1) / 2) / (max(np) * max(nn)), 6) AS auc FROM r, c""")
def q_eval_auc_score(spark, sf):
    tx = T.transactions(spark, sf)
    p = S.request_risk_score("tx_amount", "tx_time_seconds", "customer_id", large=LARGE, medium=MEDIUM)
    return E.eval_auc_score(tx.withColumn("score", p), "tx_fraud", "score")


# ---- bootstrap ------------------------------------------------------------------------------------------------

def _boot_sql():
    name = "concat_ws(':', cell, CAST(replicate AS VARCHAR))"
    cells = " UNION ALL ".join(
        f"SELECT '{m}' AS model, replicate, " + ", ".join(
            f"CAST(sum(CASE WHEN cell[1] = '{y}' AND cell[{k}] = '{p}' THEN w ELSE 0 END) AS BIGINT) AS {c}"
            for c, y, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))) + " FROM drawn GROUP BY replicate"
        for k, m in enumerate(PREDICTIONS, 2))
    flags = " || ".join(f"CASE WHEN {c} >= 0.5 THEN '1' ELSE '0' END" for c in PREDICTIONS.values())
    cells = f"""
WITH cells AS (SELECT CASE WHEN y_test = 1 THEN '1' ELSE '0' END || {flags} AS cell, count(*) AS n FROM ({EVAL_SQL}) GROUP BY 1),
rep AS (SELECT cell, n, CAST(g.range AS INTEGER) AS replicate FROM cells CROSS JOIN range({N_ITER}) g),
drawn AS (SELECT *, {sql_poisson("n", name, SEED)} AS w FROM rep)
{cells}"""
    metrics = _metrics_sql(cells, "model, replicate", None)
    return f"SELECT model, replicate, f1, precision, recall, auc FROM ({metrics}) WHERE tp + fn > 0 AND tn + fp > 0"


# full-precision replicate metrics feed the comparisons; only the bootstrap query itself shows rounded values
BOOT_SQL = _boot_sql()
BOOT_SQL_ROUNDED = ("SELECT model, replicate, round(f1, 6) AS f1, round(precision, 6) AS precision, "
                    f"round(recall, 6) AS recall, round(auc, 6) AS auc FROM ({BOOT_SQL})")


def _boot(spark, sf):
    return E.bootstrap_metrics(_eval(spark, sf), "y_test", PREDICTIONS, N_ITER, SEED)


@register("bootstrap_metrics", BOOT_SQL_ROUNDED)
def q_bootstrap_metrics(spark, sf):
    b = _boot(spark, sf)
    return b.select("model", "replicate", *[F.round(m, 6).alias(m) for m in METRICS])


def _long_sql(metrics=METRICS, model_filter: str = "TRUE"):
    return " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS v FROM b WHERE {model_filter}" for m in metrics)


@register("describe", "WITH b AS (" + BOOT_SQL + ")\n" + " UNION ALL ".join(
    f"SELECT '{name}' AS statistic, " + ", ".join(f"round({expr.format(m)}, 6) AS {m}" for m in METRICS) +
    " FROM b WHERE model = 'base'"
    for name, expr in [("count", "CAST(count({}) AS DOUBLE)"), ("mean", "avg({})"), ("std", "stddev_samp({})"),
                       ("min", "CAST(min({}) AS DOUBLE)"), ("25%", "quantile_cont({}, 0.25)"),
                       ("50%", "quantile_cont({}, 0.5)"), ("75%", "quantile_cont({}, 0.75)"),
                       ("max", "CAST(max({}) AS DOUBLE)")]))
def q_describe(spark, sf):
    return A.describe(_boot(spark, sf).filter(F.col("model") == "base"), list(METRICS))


def _interval_sql(conf=0.95):
    z = NormalDist().inv_cdf(0.5 + conf / 2)
    tq = t_quantile_sql(0.5 + conf / 2, "n - 1")
    g = f"""SELECT model, metric, n, mean, std, mean - {D(z)} * std AS norm_lo, mean + {D(z)} * std AS norm_hi,
       mean - {tq} * std / sqrt(CAST(n AS DOUBLE)) AS t_lo, mean + {tq} * std / sqrt(CAST(n AS DOUBLE)) AS t_hi
FROM (SELECT model, metric, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS std FROM l GROUP BY model, metric)"""
    cols = ["n", "mean", "std", "norm_lo", "norm_hi", "t_lo", "t_hi"]
    sel = ", ".join([f"round(b.{c}, 6) AS base_{c}" for c in cols] + [f"round(c.{c}, 6) AS cand_{c}" for c in cols])
    return f"""WITH b AS ({BOOT_SQL}), l AS ({_long_sql()}), g AS ({g})
SELECT b.metric, {sel}, NOT (b.t_hi < c.t_lo OR c.t_hi < b.t_lo) AS t_overlap
FROM (SELECT * FROM g WHERE model = 'base') b JOIN (SELECT * FROM g WHERE model = 'cand') c ON b.metric = c.metric"""


@register("metric_interval", _interval_sql())
def q_metric_interval(spark, sf):
    return E.metric_interval(_boot(spark, sf), METRICS)


def _ttest_sql(metrics=("f1", "precision"), alpha=0.01):
    p_expr = t_two_sided_p_sql("t", "df")
    return f"""WITH b AS ({BOOT_SQL}), l AS ({_long_sql(metrics)}),
g AS (SELECT metric,
             count(v) FILTER (WHERE model = 'base') AS n1, avg(v) FILTER (WHERE model = 'base') AS m1,
             var_samp(v) FILTER (WHERE model = 'base') AS v1,
             count(v) FILTER (WHERE model = 'cand') AS n2, avg(v) FILTER (WHERE model = 'cand') AS m2,
             var_samp(v) FILTER (WHERE model = 'cand') AS v2
      FROM l GROUP BY metric),
s AS (SELECT *, n1 + n2 - 2 AS df,
             sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS se FROM g),
t AS (SELECT *, CASE WHEN se > 0 THEN (m1 - m2) / se WHEN m1 - m2 = 0 THEN 0.0
                     ELSE sign(m1 - m2) * 'inf'::DOUBLE END AS t FROM s),
p AS (SELECT *, CASE WHEN NOT (se > 0) AND t = 0 THEN 1.0 WHEN NOT (se > 0) THEN 0.0 ELSE {p_expr} END AS p FROM t)
SELECT metric, round(t, 6) AS t_statistic, df, round(p, 6) AS p_value,
       round(CASE WHEN sqrt((v1 + v2) / 2) > 0 THEN abs(m2 - m1) / sqrt((v1 + v2) / 2) ELSE 0.0 END, 6) AS effect_size,
       p < {alpha} AS is_significant, round(m1, 6) AS base_mean, round(m2, 6) AS candidate_mean,
       round(m2 - m1, 6) AS improvement
FROM p"""


TTEST_SQL = _ttest_sql()


@register("t_test", TTEST_SQL)
def q_t_test(spark, sf):
    return E.t_test(_boot(spark, sf), ("f1", "precision"), 0.01)


@register("cohens_d", f"""WITH b AS ({BOOT_SQL}), l AS ({_long_sql()}),
g AS (SELECT metric, avg(v) FILTER (WHERE model = 'base') AS m1, var_samp(v) FILTER (WHERE model = 'base') AS v1,
             avg(v) FILTER (WHERE model = 'cand') AS m2, var_samp(v) FILTER (WHERE model = 'cand') AS v2
      FROM l GROUP BY metric),
d AS (SELECT metric, CASE WHEN sqrt((v1 + v2) / 2) > 0 THEN abs(m2 - m1) / sqrt((v1 + v2) / 2) ELSE 0.0 END AS d FROM g)
SELECT metric, round(d, 6) AS cohens_d,
       CASE WHEN d > 0.8 THEN 'large' WHEN d > 0.5 THEN 'medium' ELSE 'small' END AS effect FROM d""")
def q_cohens_d(spark, sf):
    return E.cohens_d(_boot(spark, sf), METRICS)


def _sample_size_sql(delta=0.01, alpha=0.05, power=0.8):
    zs = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    return f"""WITH b AS ({BOOT_SQL}), l AS ({_long_sql(METRICS, "model = 'base'")})
SELECT metric, round(sigma, 6) AS sigma, CAST(ceil({D(2 * zs * zs)} * pow(sigma, 2) / {D(delta * delta)}) AS BIGINT) AS n_required
FROM (SELECT metric, stddev_samp(v) AS sigma FROM l GROUP BY metric)"""


@register("sample_size", _sample_size_sql())
def q_sample_size(spark, sf):
    return E.sample_size(_boot(spark, sf), METRICS, delta=0.01)


@register("deploy_decision", f"""WITH tt AS ({TTEST_SQL})
SELECT metric, is_significant, improvement > 0 AS improved, is_significant AND improvement > 0 AS should_deploy,
       CASE WHEN is_significant AND improvement > 0 THEN 'significant improvement'
            WHEN NOT (improvement > 0) THEN 'no improvement' ELSE 'improvement not significant' END AS reason
FROM tt WHERE metric = 'f1'""")
def q_deploy_decision(spark, sf):
    return E.deploy_decision(E.t_test(_boot(spark, sf), ("f1", "precision"), 0.01), "f1")


RUN_TIMES = {"base": "2024-02-01 00:00:00", "cand": "2024-02-02 00:00:00"}


@register("model_table", f"""
WITH m AS ({_metrics_sql(" UNION ALL ".join(_cells_sql(f"({EVAL_SQL})", p, model=m) for m, p in PREDICTIONS.items()), "model")}),
r AS (SELECT 'fraud_detection_model' AS model_name, CASE WHEN model = 'base' THEN 1 ELSE 2 END AS version,
             CASE WHEN model = 'base' THEN TIMESTAMP '{RUN_TIMES['base']}' ELSE TIMESTAMP '{RUN_TIMES['cand']}' END AS created_at,
             f1, precision, recall, auc FROM m)
SELECT *, CASE WHEN row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, version DESC) = 1
               THEN 'Production' ELSE 'Archived' END AS stage,
       row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, version DESC) = 1 AS champion
FROM r""")
def q_model_table(spark, sf):
    from functools import reduce
    from pyspark.sql import DataFrame
    ev = _eval(spark, sf)
    long = reduce(DataFrame.unionByName, [ev.select(F.lit(m).alias("model"), "y_test", F.col(p).alias("pred"))
                                          for m, p in PREDICTIONS.items()])
    m = E.binary_metrics(E.confusion_cells(long, "y_test", "pred", by=["model"]))
    runs = m.select(F.lit("fraud_detection_model").alias("model_name"),
                    F.when(F.col("model") == "base", 1).otherwise(2).alias("version"),
                    F.when(F.col("model") == "base", F.lit(RUN_TIMES["base"]))
                     .otherwise(F.lit(RUN_TIMES["cand"])).cast("timestamp_ntz").alias("created_at"),
                    "f1", "precision", "recall", "auc")
    return E.model_table(runs)
