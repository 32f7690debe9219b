"""Quantiles from mergeable sketches: one KLL sketch a group and day, merged for any range of days without reading the
rows again.  The rank error of a sketch with k = 200 is about 1.3 %, with k = 800 about 0.4 %, and merging keeps it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_sketches(rows: DataFrame, ts: str, value: str, keys: list[str] = (), k: int = 800) -> DataFrame:
    """(keys, day, n, sketch) of the finite values; nulls, NaN and infinities have no rank and are left out, days
    without a value have no row.  Each task sends one sketch (a few KB) a group and day."""
    v = F.col(value).cast("double")
    finite = rows.filter(F.col(ts).isNotNull() & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return finite.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"),
                                                                 F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def range_sketches(sketches: DataFrame, ranges: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Merge the days of each range (``first_day`` <= day <= ``last_day``): (keys, first_day, last_day, n, sketch).  A
    range is dealt to its days, so the join is on equal days and moves sketches, no rows."""
    days = ranges.select("first_day", "last_day").distinct().withColumn(
        "day", F.explode(F.sequence("first_day", "last_day")))
    return (sketches.join(days, "day").groupBy(*keys, "first_day", "last_day")
            .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")))


def range_quantiles(sketches: DataFrame, ranges: DataFrame, probs: dict[str, float], keys: list[str] = ()) -> DataFrame:
    """(keys, first_day, last_day, n, one column a name in ``probs``) for every range with a value in it."""
    merged = range_sketches(sketches, ranges, keys)
    return merged.select(*keys, "first_day", "last_day", "n", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in probs.items()])
