"""Cleaning chain: drop nulls, 3-sigma outliers, range rules, and the per-step report.

Statistics are computed in one aggregate pass and used as scalar subqueries (one job, values handed to the tasks),
so the filter stays a single codegen stage with no join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerlens.operators.scalars import scalars


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def drop_na(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=subset)


def column_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: ``<c>_mean`` and ``<c>_std`` (sample) for every numeric column, in one pass."""
    cols = columns if columns is not None else numeric_columns(df)
    return df.agg(*[F.avg(c).alias(f"{c}_mean") for c in cols],
                  *[F.stddev_samp(c).alias(f"{c}_std") for c in cols])


def _within(c: str, k: float, skip_zero: bool, st: dict) -> Column:
    mu, sd = st[f"{c}_mean"], st[f"{c}_std"]
    inside = (F.col(c) >= mu - F.lit(k) * sd) & (F.col(c) <= mu + F.lit(k) * sd)
    skip = sd.isNull() | (sd == 0) if skip_zero else sd.isNull()
    return skip | inside


def sigma_filter(df: DataFrame, columns: list[str] | None = None, k: float = 3.0, skip_zero: bool = True,
                 stats: DataFrame | None = None) -> DataFrame:
    """Keep rows within mean +- k*sigma on every listed column (default: all numeric columns).

    Columns whose sigma is null (and, by default, 0) are skipped.  ``skip_zero=False`` is the older variant.
    """
    cols = columns if columns is not None else numeric_columns(df)
    if not cols:
        return df
    st = scalars(stats if stats is not None else column_stats(df, cols))
    cond = reduce(lambda a, b: a & b, [_within(c, k, skip_zero, st) for c in cols])
    return df.filter(cond)


# Logical range rules (fixed values): column -> condition; a rule applies only if its column exists.
RANGE_RULES = [
    ("tx_amount", lambda c: c >= 0),
    ("tx_time_seconds", lambda c: (c >= 0) & (c <= 86400)),
    ("customer_id", lambda c: c.isNotNull()),
    ("terminal_id", lambda c: c.isNotNull()),
]


def range_condition(columns: list[str], rules=RANGE_RULES) -> Column:
    conds = [rule(F.col(name)) for name, rule in rules if name in columns]
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def range_rules(df: DataFrame, rules=RANGE_RULES) -> DataFrame:
    return df.filter(range_condition(df.columns, rules))


def clean_transactions(df: DataFrame, columns: list[str] | None = None, k: float = 3.0,
                       skip_zero: bool = True) -> DataFrame:
    """drop_na -> sigma_filter -> range_rules (the reader already removed malformed and header lines)."""
    no_na = drop_na(df)
    return range_rules(sigma_filter(no_na, columns, k, skip_zero))


def clean_report(df: DataFrame, columns: list[str] | None = None, k: float = 3.0,
                 skip_zero: bool = True) -> DataFrame:
    """Row counts after each step in one pass over the data (plus the stats pass)."""
    cols = columns if columns is not None else numeric_columns(df)
    no_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in df.columns])
    # stats over the rows that survive drop_na, computed with conditional aggregates in one pass
    st = scalars(df.agg(*[F.avg(F.when(no_null, F.col(c))).alias(f"{c}_mean") for c in cols],
                        *[F.stddev_samp(F.when(no_null, F.col(c))).alias(f"{c}_std") for c in cols]))
    in_sigma = no_null & reduce(lambda a, b: a & b, [_within(c, k, skip_zero, st) for c in cols], F.lit(True))
    in_range = in_sigma & range_condition(df.columns)
    return (df
            .agg(F.count(F.lit(1)).alias("rows_read"),
                 F.count_if(no_null).alias("rows_after_drop_na"),
                 F.count_if(in_sigma).alias("rows_after_sigma"),
                 F.count_if(in_range).alias("rows_after_range")))
