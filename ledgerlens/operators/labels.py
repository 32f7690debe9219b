"""Label handling: encoding, feature choice, repeatable sampling and splits, label repair."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from ledgerlens.functions.hashing import uniform


def encode_label(label, positive: str = "bad", negative: str = "good") -> Column:
    c = label if isinstance(label, Column) else F.col(label)
    return F.when(c == positive, F.lit(1)).when(c == negative, F.lit(0)).otherwise(F.lit(None).cast("int"))


def select_features(df: DataFrame, target: str = "tx_fraud", drop: tuple = ("transaction_id", "tx_datetime"),
                    exclude: tuple = ()) -> list[str]:
    """All columns except the target, ids/datetime and string columns.  ``exclude`` removes more (e.g. the
    scenario column, which leaks the label)."""
    return [f.name for f in df.schema.fields
            if f.name != target and f.name not in drop and f.name not in exclude
            and not isinstance(f.dataType, StringType)]


LABEL_NAME_HINTS = ("fraud", "label", "class")  # fixed values: substrings that mark label-like columns


def find_label_columns(df: DataFrame, hints=LABEL_NAME_HINTS, n: int = 10) -> DataFrame:
    """(column_name, value): up to ``n`` smallest distinct values of each column named like a label."""
    cols = [c for c in df.columns if any(h in c.lower() for h in hints)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, value string")
    # one pass: (column, value) pairs, distinct by a partial aggregate, then the n smallest of each column.  Values sort
    # as in their own type: numbers and dates by a number, the rest as text
    number = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)

    def order(c):
        kind = df.schema[c].dataType
        if not isinstance(kind, number):
            return F.lit(None).cast("double")
        v = F.col(c) if isinstance(kind, (NumericType, BooleanType)) else F.unix_micros(F.col(c).cast("timestamp"))
        return v.cast("double")

    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                                         order(c).alias("_o")) for c in cols))).alias("x")
    values = df.select(pairs).select("x.*").distinct()
    rank = F.row_number().over(W.partitionBy("column_name").orderBy(
        F.col("_o").asc_nulls_first(), F.col("value").asc_nulls_first()))
    return values.withColumn("_r", rank).filter(F.col("_r") <= n).select("column_name", "value")


def distinct_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Up to ``n`` distinct values (the smallest, so the answer is repeatable)."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first()).limit(n)


def sample_frac(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    """Bernoulli sample by a stable hash of the key: repeatable across runs, engines and task retries."""
    return df.filter(uniform(key, seed) < fraction)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42, buckets: int = 1024) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: the n smallest hash draws of a per-row unique ``key``.

    No task holds n rows, whatever n is: the draws are uniform, so equal-width buckets of the draw are balanced.  Bucket
    counts and their prefix sum (``buckets`` rows) locate the bucket that holds the n-th draw; it is cut into as many
    again; buckets below the cut are taken whole, and only the fine bucket at the cut (about rows / ``buckets``**2
    rows) is ranked."""
    from ledgerlens.operators.scalars import scalars
    if n <= 0:
        return df.limit(0)
    d = df.withColumn("_u", uniform(key, seed))
    fine = buckets * buckets

    def cut(rows: DataFrame, width: int, taken: Column) -> tuple[Column, Column]:
        """The bucket of that width in which the n-th draw lies, and the draws before it (n or more rows needed)."""
        per = rows.groupBy(F.floor(F.col("_u") * F.lit(width)).cast("long").alias("_bk")).agg(F.count(F.lit(1)).alias("_c"))
        before = F.coalesce(F.sum("_c").over(W.orderBy("_bk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + taken
        at = scalars(per.withColumn("_before", before).filter((F.col("_before") < n) & (F.col("_before") + F.col("_c") >= n))
                     .select(F.col("_bk").alias("_cb"), F.col("_before").alias("_cbefore")))
        return F.coalesce(at["_cb"], F.lit(width)), F.coalesce(at["_cbefore"], F.lit(0))

    coarse, taken = cut(d, buckets, F.lit(0))
    edge, before = cut(d.filter(F.floor(F.col("_u") * F.lit(buckets)) == coarse), fine, taken)
    d = d.withColumn("_bk", F.floor(F.col("_u") * F.lit(fine)).cast("long"))
    whole = d.filter(F.col("_bk") < edge)                # fewer than n rows: every bucket is below the cut
    rest = (d.filter(F.col("_bk") == edge)
            .withColumn("_r", F.row_number().over(W.orderBy("_u", key)))
            .filter(F.col("_r") <= F.lit(n) - before).drop("_r"))
    return whole.unionByName(rest).drop("_u", "_bk")


def with_split(df: DataFrame, key: str, weights=(0.8, 0.2), seed: int = 42, name: str = "split") -> DataFrame:
    """Adds the split index (0 = first weight) from a stable hash of the key."""
    total = float(sum(weights))
    u = uniform(key, seed)
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        edges.append(acc)
    expr = F.lit(len(weights) - 1)
    for i in range(len(edges) - 1, -1, -1):
        expr = F.when(u < edges[i], F.lit(i)).otherwise(expr)
    return df.withColumn(name, expr)


def random_split(df: DataFrame, key: str, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    s = with_split(df, key, weights, seed, "_split")
    return [s.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def class_balance(df: DataFrame, target: str = "tx_fraud") -> DataFrame:
    t = F.col(target)
    return (df.agg(F.count_if(t == 1).alias("positives"), F.count_if(t == 0).alias("negatives"),
                   F.count(F.lit(1)).alias("total"))
            .withColumn("positive_pct", F.round(F.col("positives").cast("double") * 100.0 / F.col("total"), 6))
            .withColumn("negative_pct", F.round(F.col("negatives").cast("double") * 100.0 / F.col("total"), 6)))


def label_from_scenario(df: DataFrame, target: str = "tx_fraud", scenario: str = "tx_fraud_scenario") -> DataFrame:
    return df.withColumn(target, F.when(F.col(scenario) > 0, 1).otherwise(0))


def _amount_quantile(df: DataFrame, col: str, q: float, rel_error: float, exact: bool) -> DataFrame:
    """One-row table ``_pq``: the approximate (GK sketch) or exact quantile of the column."""
    if exact:
        from ledgerlens.operators.aggregates import exact_quantile
        return exact_quantile(df, col, q, name="_pq")
    return df.agg(F.percentile_approx(F.col(col), F.lit(q), F.lit(int(round(1.0 / rel_error)))).alias("_pq"))


def synth_labels(df: DataFrame, target: str = "tx_fraud", amount: str = "tx_amount", key: str = "transaction_id",
                 q: float = 0.98, rel_error: float = 0.01, random_rate: float = 0.005, seed: int = 42,
                 exact: bool = False) -> DataFrame:
    """label = amount above the q-quantile, or a stable 0.5 % draw.  The quantile is a one-row aggregate
    used as a scalar subquery (no join, no hand-made driver round trip); ``exact`` switches to the exact percentile."""
    pq = _amount_quantile(df, amount, q, rel_error, exact).select("_pq").scalar()
    lab = ((F.col(amount) > pq) | (uniform(key, seed) < random_rate)).cast("int")
    return df.withColumn(target, lab)


def prepare_labels(df: DataFrame, target: str = "tx_fraud", scenario: str = "tx_fraud_scenario",
                   amount: str = "tx_amount", key: str = "transaction_id", q: float = 0.98,
                   rel_error: float = 0.01, random_rate: float = 0.005, seed: int = 42,
                   exact: bool = False) -> DataFrame:
    """Three-way fallback: keep the labels if any positive exists, else use scenario > 0 if any, else synthesise (amount
    quantile or stable draw).  Adds ``label_source``.  One row of flags decides, so the quantile is only computed
    where it is used."""
    has = df.agg(F.max((F.col(target) == 1).cast("int")).alias("pos"),
                 F.max((F.col(scenario) > 0).cast("int")).alias("scen")).first()
    if has["pos"] == 1:
        return df.withColumn("label_source", F.lit("given"))
    if has["scen"] == 1:
        return label_from_scenario(df, target, scenario).withColumn("label_source", F.lit("scenario"))
    return (synth_labels(df, target, amount, key, q, rel_error, random_rate, seed, exact)
            .withColumn("label_source", F.lit("synthetic")))


def check_labels(df: DataFrame, target: str = "tx_fraud", warn_below: int = 100) -> int:
    """Action: number of positives; raises if none remain, warns below ``warn_below``."""
    n = df.agg(F.count_if(F.col(target) == 1).alias("n")).first()["n"]
    if n == 0:
        raise ValueError("no positive labels remain; cannot train a fraud model")
    if n < warn_below:
        warnings.warn(f"only {n} positive labels; model quality may be poor")
    return n
