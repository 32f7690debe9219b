"""Model evaluation as Spark aggregations: confusion cells, AUC, bootstrap, t-test, effect size, decision.

Everything is computed from aggregated counts, so the evaluated table never leaves the executors.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import poisson
from ledgerlens.functions.stats import t_quantile, t_two_sided_p


def _safe_div(a: Column, b: Column, default: float | None = 0.0) -> Column:
    d = F.lit(default) if default is not None else F.lit(None).cast("double")
    return F.when(b != 0, a.cast("double") / b.cast("double")).otherwise(d)


def confusion_cells(df: DataFrame, label: str, prediction: str, weight: Column | None = None,
                    by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn (optionally weighted) for binary labels; prediction >= 0.5 counts as positive."""
    w = weight if weight is not None else F.lit(1)
    y = F.col(label) == 1
    p = F.col(prediction) >= 0.5
    aggs = [F.sum(F.when(y & p, w).otherwise(0)).alias("tp"), F.sum(F.when(~y & p, w).otherwise(0)).alias("fp"),
            F.sum(F.when(y & ~p, w).otherwise(0)).alias("fn"), F.sum(F.when(~y & ~p, w).otherwise(0)).alias("tn")]
    return df.groupBy(*(by or [])).agg(*aggs)


def binary_metrics(cells: DataFrame, digits: int | None = 6) -> DataFrame:
    """precision, recall, F1 of class 1 (0 when undefined, as the reference's defaults) and hard-label AUC
    (TPR + TNR) / 2 (null when a class is missing).  ``digits=None`` keeps full precision (for values that are
    aggregated further, so no rounding happens before the last step)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    tpr = _safe_div(tp, tp + fn, None)
    tnr = _safe_div(tn, tn + fp, None)
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return cells.select(
        *[c for c in cells.columns if c not in ("tp", "fp", "fn", "tn")], "tp", "fp", "fn", "tn",
        r(_safe_div(tp, tp + fp)).alias("precision"),
        r(_safe_div(tp, tp + fn)).alias("recall"),
        r(_safe_div(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        r((tpr + tnr) / 2).alias("auc"))


def eval_binary(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return binary_metrics(confusion_cells(df, label, prediction))


def eval_auc_label(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """AUC from hard 0/1 predictions = (TPR + TNR) / 2."""
    return eval_binary(df, label, prediction).select("auc")


def eval_weighted(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """accuracy and label-frequency-weighted precision, recall and F1 over all classes (multiclass form).  ``weight``:
    how many rows a row stands for."""
    conf = df.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")) \
             .agg(F.sum(F.col(weight) if weight else F.lit(1)).alias("n"))
    per_label = conf.groupBy("y").agg(F.sum("n").alias("n_label"),
                                       F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    per_pred = conf.groupBy(F.col("p").alias("y")).agg(F.sum("n").alias("n_pred"))
    cls = per_label.join(per_pred, "y", "full").fillna(0, ["n_label", "tp", "n_pred"])
    prec = _safe_div(F.col("tp"), F.col("n_pred"))
    rec = _safe_div(F.col("tp"), F.col("n_label"))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    total = F.sum("n_label")
    return (cls.agg((F.sum("tp") / total).alias("accuracy"),
                    (F.sum(F.col("n_label") * prec) / total).alias("weighted_precision"),
                    (F.sum(F.col("n_label") * rec) / total).alias("weighted_recall"),
                    (F.sum(F.col("n_label") * f1) / total).alias("weighted_f1"))
            .select(*[F.round(c, 6).alias(c) for c in
                      ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")]))


def eval_auc_score(df: DataFrame, label: str, score: str, levels: int | None = None, weight: str | None = None) -> DataFrame:
    """ROC AUC of raw scores, exact (ties count one half), without a global sort.

    Rows are first reduced to one row per distinct score (positive and negative counts).  The distinct scores are
    cut into ``2**levels`` buckets at approximate equi-depth cut points, so scores clustered near one value (as a
    fraud model's tiny probabilities are) still spread over all buckets.  The negatives below a score are the
    negatives of all lower buckets (a prefix sum over at most ``2**levels`` rows) plus those below it inside its
    own bucket (a window per bucket)."""
    from ledgerlens.operators.aggregates import quantile_edges, rank_buckets, rank_levels
    levels = levels or rank_levels(df)
    one = F.col(weight) if weight else F.lit(1)
    by_score = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, one).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) != 1, one).otherwise(0)).alias("neg"))
    # written once: cut points, bucket sums and ranks below all read the grouped scores, not the table
    from ledgerlens.session import scratch_path
    path = scratch_path(df.sparkSession, "auc-scores")
    by_score.write.parquet(path)
    by_score = df.sparkSession.read.parquet(path)
    edges = by_score.agg(quantile_edges(F.col("s"), levels).alias("_e")).scalar()
    scored = rank_buckets(by_score, "s", edges, levels)
    per_bucket = scored.groupBy("_bk").agg(F.sum("neg").alias("_bneg"))
    before = per_bucket.withColumn(
        "_neg_before", F.coalesce(F.sum("_bneg").over(W.orderBy("_bk").rowsBetween(W.unboundedPreceding, -1)),
                                  F.lit(0))).select("_bk", "_neg_before")
    w_in = W.partitionBy("_bk").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    local = scored.withColumn("_neg_in", F.coalesce(F.sum("neg").over(w_in), F.lit(0)))
    contrib = (local.join(F.broadcast(before), "_bk")
               .select((F.col("pos").cast("double") * ((F.col("_neg_before") + F.col("_neg_in")).cast("double")
                                                        + F.col("neg").cast("double") / 2)).alias("c"),
                       "pos", "neg"))
    return contrib.agg(F.round(F.sum("c") / (F.sum("pos").cast("double") * F.sum("neg").cast("double")), 6)
                       .alias("auc"))


# ---- bootstrap and comparison ------------------------------------------------------------------------------

def cell_weight(n: Column, cell: Column, replicate: Column, seed: int) -> Column:
    """A Poisson(n) draw: what the Poisson(1) weights of the n rows of a cell add up to in a replicate.  Exact for any n, at
    a cost that doesn't grow with it; a stable function of cell, replicate and seed."""
    return poisson(n, F.concat_ws(":", cell, replicate.cast("string")), seed)


def bootstrap_metrics(df: DataFrame, label: str, predictions: dict[str, str], n_iter: int = 100,
                      seed: int = 42, digits: int | None = None) -> DataFrame:
    """Per model and replicate: F1, precision, recall, hard-label AUC under Poisson(1) resampling weights.

    The table is grouped once into its cells (label x hard prediction of every model); a replicate draws the sum of each
    cell's weights (:func:`cell_weight`), so all the work behind the grouping is on a handful of rows, however many
    were evaluated.  Models share a cell's draw: a replicate resamples the same rows for all of them.  Replicates that
    miss a class are dropped (the metrics are undefined there), as the reference skips such iterations."""
    flag = lambda c: F.coalesce(c.cast("int").cast("string"), F.lit("n"))
    cols = {m: flag(F.col(c) >= 0.5).alias(f"_p_{m}") for m, c in predictions.items()}
    cells = (df.groupBy(flag(F.col(label) == 1).alias("_y"), *cols.values()).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_y") != "n"))
    rep = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_iter - 1))).alias("replicate"))
    name = F.concat_ws("", F.col("_y"), *(F.col(f"_p_{m}") for m in predictions))
    rep = rep.withColumn("_w", cell_weight(F.col("_n"), name, F.col("replicate"), seed))
    aggs = []
    for m in predictions:
        for cell, y, p in (("tp", "1", "1"), ("fp", "0", "1"), ("fn", "1", "0"), ("tn", "0", "0")):
            cond = (F.col("_y") == y) & (F.col(f"_p_{m}") == p)
            aggs.append(F.sum(F.when(cond, F.col("_w")).otherwise(0)).alias(f"{m}__{cell}"))
    sums = rep.groupBy("replicate").agg(*aggs)
    # unpivot models with a Generate (one lineage) rather than a union of per-model selects
    per_model = F.explode(F.array(*[F.struct(F.lit(m).alias("model"),
                                             *[F.col(f"{m}__{c}").alias(c) for c in ("tp", "fp", "fn", "tn")])
                                    for m in predictions])).alias("_m")
    long = sums.select("replicate", per_model).select("_m.model", "replicate", "_m.tp", "_m.fp", "_m.fn", "_m.tn")
    valid = long.filter((F.col("tp") + F.col("fn") > 0) & (F.col("tn") + F.col("fp") > 0))
    return binary_metrics(valid, digits).select("model", "replicate", "f1", "precision", "recall", "auc")


METRICS = ("f1", "precision", "recall", "auc")


def _long(reps: DataFrame, metrics, keep=("model",)) -> DataFrame:
    """(model, metric, v) rows from the wide replicate table via one Generate."""
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])
    return reps.select(*keep, F.explode(arr).alias("_x")).select(*keep, "_x.metric", "_x.v")


def metric_interval(reps: DataFrame, metrics=METRICS, confidence: float = 0.95, base: str = "base",
                    cand: str = "cand") -> DataFrame:
    """Per metric and model: mean, std, normal interval mean +- z*std, t interval of the mean; plus whether the
    two models' t intervals overlap."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    long = _long(reps, metrics)
    g = long.groupBy("model", "metric").agg(F.count("v").alias("n"), F.avg("v").alias("mean"),
                                            F.stddev_samp("v").alias("std"))
    tq = t_quantile(0.5 + confidence / 2, F.col("n") - 1)
    half = tq * F.col("std") / F.sqrt(F.col("n").cast("double"))
    g = g.select("model", "metric", "n", "mean", "std",
                 (F.col("mean") - z * F.col("std")).alias("norm_lo"), (F.col("mean") + z * F.col("std")).alias("norm_hi"),
                 (F.col("mean") - half).alias("t_lo"), (F.col("mean") + half).alias("t_hi"))
    b = g.filter(F.col("model") == base).drop("model")
    c = g.filter(F.col("model") == cand).drop("model")
    j = b.alias("b").join(c.alias("c"), "metric")
    overlap = ~((F.col("b.t_hi") < F.col("c.t_lo")) | (F.col("c.t_hi") < F.col("b.t_lo")))
    cols = ["n", "mean", "std", "norm_lo", "norm_hi", "t_lo", "t_hi"]
    return j.select("metric", *[F.round(F.col(f"b.{x}"), 6).alias(f"base_{x}") for x in cols],
                    *[F.round(F.col(f"c.{x}"), 6).alias(f"cand_{x}") for x in cols], overlap.alias("t_overlap"))


def t_test(reps: DataFrame, metrics=("f1", "precision"), alpha: float = 0.01, base: str = "base",
           cand: str = "cand") -> DataFrame:
    """Pooled two-sample t-test (base vs candidate) per metric, with Cohen's d and improvement.
    A 0/0 statistic (no spread, equal means) gives t = 0 and p = 1."""
    long = _long(reps, metrics)
    g = long.groupBy("metric").agg(
        F.count(F.when(F.col("model") == base, F.col("v"))).alias("n1"),
        F.avg(F.when(F.col("model") == base, F.col("v"))).alias("m1"),
        F.var_samp(F.when(F.col("model") == base, F.col("v"))).alias("v1"),
        F.count(F.when(F.col("model") == cand, F.col("v"))).alias("n2"),
        F.avg(F.when(F.col("model") == cand, F.col("v"))).alias("m2"),
        F.var_samp(F.when(F.col("model") == cand, F.col("v"))).alias("v2"))
    dfree = F.col("n1") + F.col("n2") - 2
    sp2 = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / dfree
    se = F.sqrt(sp2 * (F.lit(1.0) / F.col("n1") + F.lit(1.0) / F.col("n2")))
    diff = F.col("m1") - F.col("m2")
    t = (F.when(se > 0, diff / se)
         .when(diff == 0, F.lit(0.0))
         .otherwise(F.signum(diff) * F.lit(float("inf"))))
    g = g.withColumn("t_statistic", t).withColumn("df", dfree)
    p = F.when(F.col("se_zero") & (F.col("t_statistic") == 0), F.lit(1.0)) \
         .when(F.col("se_zero"), F.lit(0.0)) \
         .otherwise(t_two_sided_p(F.col("t_statistic"), F.col("df")))
    g = g.withColumn("se_zero", ~(se > 0)).withColumn("p_value", p)
    pooled_sd = F.sqrt((F.col("v1") + F.col("v2")) / 2)
    d = F.when(pooled_sd > 0, F.abs(F.col("m2") - F.col("m1")) / pooled_sd).otherwise(F.lit(0.0))
    return g.select("metric", F.round("t_statistic", 6).alias("t_statistic"), "df",
                    F.round("p_value", 6).alias("p_value"), F.round(d, 6).alias("effect_size"),
                    (F.col("p_value") < alpha).alias("is_significant"),
                    F.round("m1", 6).alias("base_mean"), F.round("m2", 6).alias("candidate_mean"),
                    F.round(F.col("m2") - F.col("m1"), 6).alias("improvement"))


def effect_band(d: Column, medium: float = 0.5, large: float = 0.8) -> Column:
    return F.when(d > large, "large").when(d > medium, "medium").otherwise("small")


def cohens_d(reps: DataFrame, metrics=METRICS, base: str = "base", cand: str = "cand") -> DataFrame:
    """|mean difference| / sqrt(mean of the two variances); 0 without spread; size band."""
    long = _long(reps, metrics)
    g = long.groupBy("metric").agg(
        F.avg(F.when(F.col("model") == base, F.col("v"))).alias("m1"),
        F.var_samp(F.when(F.col("model") == base, F.col("v"))).alias("v1"),
        F.avg(F.when(F.col("model") == cand, F.col("v"))).alias("m2"),
        F.var_samp(F.when(F.col("model") == cand, F.col("v"))).alias("v2"))
    sd = F.sqrt((F.col("v1") + F.col("v2")) / 2)
    d = F.when(sd > 0, F.abs(F.col("m2") - F.col("m1")) / sd).otherwise(F.lit(0.0))
    return g.select("metric", F.round(d, 6).alias("cohens_d"), effect_band(d).alias("effect"))


def sample_size(reps: DataFrame, metrics=METRICS, delta: float = 0.01, alpha: float = 0.05, power: float = 0.8,
                model: str = "base") -> DataFrame:
    """n = 2 (z_{1-alpha/2} + z_power)^2 sigma^2 / delta^2 per metric, sigma from the bootstrap spread."""
    zs = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    long = _long(reps.filter(F.col("model") == model), metrics, keep=())
    g = long.groupBy("metric").agg(F.stddev_samp("v").alias("sigma"))
    n = F.lit(2 * zs * zs) * F.pow(F.col("sigma"), 2) / F.lit(delta * delta)
    return g.select("metric", F.round("sigma", 6).alias("sigma"), F.ceil(n).cast("long").alias("n_required"))


def deploy_decision(tests: DataFrame, metric: str = "f1") -> DataFrame:
    """Deploy when the metric's difference is significant and the candidate improves it."""
    r = tests.filter(F.col("metric") == metric)
    improved = F.col("improvement") > 0
    deploy = F.col("is_significant") & improved
    reason = (F.when(deploy, "significant improvement").when(~improved, "no improvement")
              .otherwise("improvement not significant"))
    return r.select("metric", "is_significant", improved.alias("improved"), deploy.alias("should_deploy"),
                    reason.alias("reason"))


def model_table(runs: DataFrame, name: str = "model_name", created: str = "created_at",
                version: str = "version") -> DataFrame:
    """Versioned runs: the newest run of each model is Production (champion), older ones Archived."""
    w = W.partitionBy(name).orderBy(F.col(created).desc(), F.col(version).desc())
    rn = F.row_number().over(w)
    return runs.withColumn("stage", F.when(rn == 1, "Production").otherwise("Archived")) \
               .withColumn("champion", rn == 1)
