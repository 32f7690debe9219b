"""Range functions over counters, gauges and histogram buckets, evaluated at steps of time.

A sample is (series, time, value).  At every step t a function sees the samples of the last ``range_seconds``, (t - range, t].
Samples are first reduced to one row a series and step: what changed inside the step, its first and its last value.  A
running sum over those rows gives the counter without its restarts, so a range is the difference of two such sums and no
window ever holds samples: its size is that of the time span, not of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _gain(kind: str, now: Column, before: Column) -> Column:
    """What a sample adds to the one before it; a counter that falls has been restarted from 0."""
    if kind == "increase":
        return F.when(now >= before, now - before).when(now < before, now)
    if kind == "changes":
        return F.when(before.isNotNull(), (now != before).cast("double"))
    raise ValueError(kind)


def over_range(samples: DataFrame, ts: str, value: str, keys: list[str], range_seconds: int, step_seconds: int = 60,
               kind: str = "increase") -> DataFrame:
    """(keys, evaluated_at, samples, ``kind``) for each series and step whose range holds a sample.

    ``increase``: what a counter grew between the first and the last sample of the range, restarts taken out; ``changes``:
    how often a gauge had another value than in the sample before.  Nothing is extrapolated to the edges of the range.
    Steps run to the last sample of all.  Samples may come late and in any order; of samples of one time the largest
    counts; null values and times are left out; null keys are a series.  ``range_seconds`` is a multiple of the step.
    """
    if range_seconds % step_seconds:
        raise ValueError("the range must be a multiple of the step")
    steps, step_us = range_seconds // step_seconds, step_seconds * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = (samples.select(*keys, us.alias("_us"), F.col(value).cast("double").alias("_v"))
            .filter("_us IS NOT NULL AND _v IS NOT NULL")
            .withColumn("_b", F.ceil(F.col("_us") / F.lit(step_us))).repartition(*keys, "_b")
            .groupBy(*keys, "_b", "_us").agg(F.max("_v").alias("_v")))
    inside = W.partitionBy(*keys, "_b").orderBy("_us")
    parts = (rows.withColumn("_g", _gain(kind, F.col("_v"), F.lag("_v").over(inside))).groupBy(*keys, "_b")
             .agg(F.coalesce(F.sum("_g"), F.lit(0.0)).alias("_own"), F.min_by("_v", "_us").alias("_first"),
                  F.max_by("_v", "_us").alias("_last"), F.count(F.lit(1)).alias("_n")))
    series = W.partitionBy(*keys).orderBy("_b")
    joint = F.coalesce(_gain(kind, F.col("_first"), F.lag("_last").over(series)), F.lit(0.0))
    upto = F.sum(F.col("_own") + F.col("_joint")).over(series.rowsBetween(W.unboundedPreceding, 0))
    end = samples.agg(F.max(F.ceil(F.when(F.col(value).isNotNull(), us) / F.lit(step_us)))).scalar()
    to = F.least(F.coalesce(F.lead("_b").over(series) - 1, end), F.col("_b") + (steps - 1), end)
    sums = (parts.withColumn("_joint", joint).withColumn("_to", to).withColumn("_upto", upto)
            .select(*keys, F.col("_b").alias("_at"), "_upto", (F.col("_upto") - F.col("_own")).alias("_from"), "_n",
                    F.explode(F.sequence("_b", "_to")).alias("_b")))
    fresh = F.col("_at") == F.col("_b")
    window = W.partitionBy(*keys).orderBy("_b").rangeBetween(-(steps - 1), 0)
    # the sums never fall, so the smallest in the range is that of its first sample
    out = sums.select(*keys, F.timestamp_micros(F.col("_b") * F.lit(step_us)).cast("timestamp_ntz").alias("evaluated_at"),
                      F.sum(F.when(fresh, F.col("_n")).otherwise(0)).over(window).alias("samples"),
                      (F.col("_upto") - F.min(F.when(fresh, F.col("_from"))).over(window)).alias(kind))
    return out


def increase(samples: DataFrame, ts: str, value: str, keys: list[str], range_seconds: int, step_seconds: int = 60) -> DataFrame:
    """:func:`over_range` of a counter, with ``rate_per_s``."""
    out = over_range(samples, ts, value, keys, range_seconds, step_seconds)
    return out.withColumn("rate_per_s", F.col("increase") / F.lit(float(range_seconds)))


def share(part: DataFrame, whole: DataFrame, keys: list[str], name: str = "pct") -> DataFrame:
    """(keys, evaluated_at, part, whole, pct) from two increases, summed over all series with the same keys; a part without
    samples counts as 0, and a whole that didn't grow has no share."""
    on = [*keys, "evaluated_at"]
    total = lambda df, alias: df.groupBy(*on).agg(F.sum("increase").alias(alias))
    both = total(whole, "whole").join(total(part, "part"), on, "left").withColumn("part", F.coalesce("part", F.lit(0.0)))
    return both.select(*on, "part", "whole", F.when(F.col("whole") > 0, F.col("part") * 100.0 / F.col("whole")).alias(name))


def histogram_quantile(buckets: DataFrame, q: float, keys: list[str], le: str = "le", value: str = "value") -> DataFrame:
    """(keys, observations, quantile) from cumulative bucket counts, by interpolation inside the bucket of the quantile.

    ``le`` is the upper bound of a bucket, infinity for the last; buckets of several series are first added up, so
    histograms of any windows or machines merge.  The lowest bucket starts at 0 (or has no width, if its bound isn't
    positive); a quantile in the last bucket is the largest finite bound.  Counts that fall from one bound to the next
    (samples of different times) are lifted to the one before.  Without an infinite bucket or any observation it is null.
    """
    merged = buckets.groupBy(*keys, F.col(le).alias("_le")).agg(F.sum(value).alias("_v"))
    w = W.partitionBy(*keys).orderBy("_le")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy(*keys)
    infinite = F.col("_le") == F.lit(float("inf"))
    r = merged.withColumn("_c", F.max("_v").over(upto))
    r = (r.withColumn("_below", F.coalesce(F.lag("_c").over(w), F.lit(0.0)))
         .withColumn("_low", F.coalesce(F.lag("_le").over(w), F.least(F.col("_le"), F.lit(0.0))))
         .withColumn("_all", F.max(F.when(infinite, F.col("_c"))).over(everything)))
    rank = F.lit(q) * F.col("_all")
    hit = (F.col("_all") > 0) & (F.col("_c") >= rank) & ((F.col("_below") < rank) | ((rank == 0) & (F.col("_below") == 0) & (F.col("_c") > 0)))
    at = F.when(infinite, F.col("_low")).otherwise(
        F.col("_low") + (F.col("_le") - F.col("_low")) * (rank - F.col("_below")) / (F.col("_c") - F.col("_below")))
    return r.groupBy(*keys).agg(F.max("_all").alias("observations"), F.min(F.when(hit, at)).alias("quantile"))
