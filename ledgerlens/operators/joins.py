"""Joins: size-checked broadcast equi-join and the feature-store joins (as-of, latest, lookup, push).

The as-of ("point-in-time") join has no built-in Spark operator.  It is composed of windows and aggregates that
stay bounded when one entity holds a large share of the rows:

* features and entity rows are bucketed by (key, time bucket of ``bucket_seconds``); inside a bucket a window
  ``last(feature, ignorenulls)`` ordered by time finds the latest feature at or before each event;
* for events whose bucket has no earlier feature, the answer is the newest feature of an earlier bucket: each
  bucket is first reduced to its newest feature (a partial aggregate), and a window over the per-key bucket
  summaries (one row per bucket, so its size is bounded by time span, not by row count) carries it forward;
* the TTL is checked last.

No task ever holds more than one key's rows of one time bucket.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# ---- broadcast with a size check ------------------------------------------------------------------------------

def estimated_size_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan (file sizes x projection), or None when unknown."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(v if isinstance(v, int) else v.toString())
    except Exception:  # pragma: no cover - plan stats unavailable (e.g. Spark Connect)
        return None


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes, in any of the spellings the engine takes; 0 if it is off."""
    n = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return n if n > 0 else 0


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only when the estimated size is within ``max_bytes`` (default: the session's
    broadcast threshold); otherwise leave the side to a shuffle join (AQE may still switch at runtime using
    measured sizes)."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    size = estimated_size_bytes(df)
    if size is not None and limit > 0 and size <= limit:
        return F.broadcast(df)
    return df


def left_equi_join(fact: DataFrame, dim: DataFrame, left_on: str, right_on: str, how: str = "left",
                   fact_filter: Column | None = None, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Filtered fact joined to a dimension on differently named keys; the filter is pushed to the fact scan."""
    f = fact.where(fact_filter) if fact_filter is not None else fact
    d = broadcast_if_small(dim, max_broadcast_bytes)
    return f.join(d, f[left_on] == d[right_on], how)


# ---- feature views ----------------------------------------------------------------------------------------------

@dataclass
class FeatureView:
    """A named set of feature columns over a source with an event-time column and a TTL."""

    name: str
    source: DataFrame
    keys: list[str]
    ts: str
    features: list[str]
    ttl: timedelta | None = timedelta(days=365)
    tie_breaker: str | None = None   # second order key for rows with the same time (larger wins)
    rename: dict = field(default_factory=dict)


def _micros(c) -> Column:
    col = c if isinstance(c, Column) else F.col(c)
    return F.unix_micros(col.cast("timestamp"))


def _feature_struct(view: FeatureView) -> Column:
    tb = F.col(view.tie_breaker) if view.tie_breaker else F.lit(0)
    return F.struct(F.col(view.ts).cast("timestamp_ntz").alias("_fts"), tb.alias("_ftb"),
                    *[F.col(f).alias(f) for f in view.features])


def point_in_time_join(entities: DataFrame, views: list[FeatureView], event_ts: str = "event_timestamp",
                       bucket_seconds: int = 3600, full_feature_names: bool = False) -> DataFrame:
    """For each entity row: per view, the newest feature row with ts <= event time and ts >= event time - TTL
    (inclusive at both ends); none -> nulls.  Ties on time go to the larger ``tie_breaker`` (of any type that has an
    order), then to the larger feature values, in the order they are named.  A null key matches nothing.

    Views that share their key columns are answered in one pass: one shuffle and sort of entities plus all their
    feature rows by (key, time bucket)."""
    by_keys: dict[tuple, list[FeatureView]] = {}
    for v in views:
        by_keys.setdefault(tuple(v.keys), []).append(v)
    out = entities
    for keys, vs in by_keys.items():
        out = _pit_pass(out, list(keys), vs, event_ts, bucket_seconds, full_feature_names)
    return out


def _pit_pass(ent_df: DataFrame, keys: list[str], views: list[FeatureView], event_ts: str, bucket_seconds: int,
              full_feature_names: bool) -> DataFrame:
    b_us = int(bucket_seconds) * 1_000_000
    ent_cols = ent_df.columns
    other = [c for c in ent_cols if c not in set(keys)]
    structs = [_feature_struct(v) for v in views]
    # a null key matches nothing; features outside [first event - TTL, last event] answer nothing and stay in their files
    from ledgerlens.operators.scalars import scalars
    span = scalars(ent_df.agg(F.min(F.col(event_ts).cast("timestamp_ntz")).alias("lo"),
                              F.max(F.col(event_ts).cast("timestamp_ntz")).alias("hi")))

    def bounded(v: FeatureView) -> DataFrame:
        t = F.col(v.ts)
        src = v.source.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).filter(t <= span["hi"])
        return src if v.ttl is None else src.filter(t >= span["lo"] - F.make_dt_interval(secs=F.lit(v.ttl.total_seconds())))

    srcs = [bounded(v).select(*keys, s.alias("_f")) for v, s in zip(views, structs)]
    ftypes = [src.schema["_f"].dataType for src in srcs]
    n = len(views)
    null_f = [F.lit(None).cast(t) for t in ftypes]

    def fcols(i: int | None, value=None):
        return [(value if j == i else null_f[j]).alias(f"_f{j}") for j in range(n)]

    # entities with a null key have no neighbours to look at: they are dealt by time, not kept together
    alone = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bucket = F.floor(_micros(event_ts) / F.lit(b_us))
    ent_side = ent_df.select(*keys, F.when(alone, F.xxhash64(event_ts, *other)).otherwise(bucket).alias("_b"),
                             F.lit(1).alias("_kind"), F.col(event_ts).cast("timestamp_ntz").alias("_ets"), *fcols(None), *other)
    sides = [ent_side]
    for i, src in enumerate(srcs):
        sides.append(src.select(*keys, F.floor(_micros(F.col("_f._fts")) / F.lit(b_us)).alias("_b"),
                                F.lit(0).alias("_kind"), F.col("_f._fts").alias("_ets"),
                                *fcols(i, F.col("_f")),
                                *[F.lit(None).cast(ent_df.schema[c].dataType).alias(c) for c in other]))
    rows = sides[0]
    for s_ in sides[1:]:
        rows = rows.unionByName(s_)

    # (1) bucket summaries: newest feature of each view per (key, bucket), a grouped max over the feature struct
    #     (time, tie-breaker, values), so the map side sends one row per (key, bucket) and task into the shuffle.
    #     Entity rows contribute their bucket (with null features), so every bucket that needs an answer has a row.
    summary = rows.groupBy(*keys, "_b").agg(*[F.max(f"_f{j}").alias(f"_s{j}") for j in range(n)],
                                            F.max("_kind").alias("_has_ent"))

    # (2) newest feature of earlier buckets: per-key window over bucket summaries (one row per bucket, so its size
    #     follows the time span, not the row count)
    w_prev = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    prior = (summary.select(*keys, "_b", "_has_ent",
                            *[F.last(f"_s{j}", ignorenulls=True).over(w_prev).alias(f"_p{j}") for j in range(n)])
             .filter(F.col("_has_ent") == 1).drop("_has_ent"))   # only buckets holding entity rows are joined

    # (3) one window per (key, bucket): newest feature of each view at or before every entity row.  This is the only
    #     shuffle and sort of the full rows.
    #     Rows of one time are in the order of the whole feature struct, as the maximum of the summaries is.
    order = [F.col("_ets"), F.col("_kind"), *[F.col(f"_f{j}") for j in range(n)]]
    w_run = W.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.select(*keys, "_b", "_kind", "_ets", *other,
                       *[F.last(f"_f{j}", ignorenulls=True).over(w_run).alias(f"_in{j}") for j in range(n)])

    joined = rows.filter(F.col("_kind") == 1).join(broadcast_if_small(prior), [*keys, "_b"], "left")
    feats = []
    for j, v in enumerate(views):
        best = F.coalesce(F.col(f"_in{j}"), F.col(f"_p{j}"))
        if v.ttl is not None:
            ttl_us = int(v.ttl.total_seconds() * 1_000_000)
            best = F.when(_micros(best["_fts"]) >= _micros("_ets") - F.lit(ttl_us), best)
        for f in v.features:
            nm = f"{v.name}__{f}" if full_feature_names else v.rename.get(f, f)
            feats.append(best[f].alias(nm))
    return joined.select(*[F.col(c) for c in ent_cols if c in keys or c in other], *feats).select(*ent_cols, *[
        c for c in [f"{v.name}__{f}" if full_feature_names else v.rename.get(f, f) for v in views for f in v.features]])


def latest_per_key(df: DataFrame, keys: list[str], ts: str, columns: list[str], tie_breaker: str | None = None,
                   start=None, end=None) -> DataFrame:
    """Newest row per key with ``start < ts <= end`` (either bound optional).

    A grouped max over a (ts, tie) struct: partial aggregation on the map side, so a hot key costs one row per
    partition in the shuffle, unlike a ``row_number`` window."""
    d = df
    if start is not None:
        d = d.filter(F.col(ts) > F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        d = d.filter(F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    tb = F.col(tie_breaker) if tie_breaker else F.lit(0)
    s = F.struct(F.col(ts).alias("_ts"), tb.alias("_tb"), *[F.col(c).alias(c) for c in columns])
    return d.groupBy(*keys).agg(F.max(s).alias("_r")).select(*keys, F.col("_r._ts").alias(ts),
                                                               *[F.col(f"_r.{c}").alias(c) for c in columns])


def point_in_time_now(entity_keys: DataFrame, view: FeatureView, as_of=None, event_ts: str = "event_timestamp"
                      ) -> DataFrame:
    """Batch scoring: every entity row, with all its columns, gets the time ``as_of`` and the view's newest feature with
    as_of - TTL <= ts <= as_of."""
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    src = view.source.filter(F.col(view.ts) <= now)
    if view.ttl is not None:
        src = src.filter(F.col(view.ts) >= now - F.make_dt_interval(secs=F.lit(view.ttl.total_seconds())))
    latest = latest_per_key(src, view.keys, view.ts, view.features, view.tie_breaker).drop(view.ts)
    latest = latest.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(view.keys)),
                           *(F.col(f).alias(view.rename.get(f, f)) for f in view.features))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(view.keys)])
    rows = entity_keys.withColumn(event_ts, now)
    return rows.join(broadcast_if_small(latest), on, "left").drop(*(f"_k{i}" for i in range(len(view.keys))))


def online_lookup(keys: DataFrame, online: DataFrame, key_cols: list[str]) -> DataFrame:
    """Current feature values for the given keys (left join to the one-row-per-key online table)."""
    return keys.join(broadcast_if_small(online), on=key_cols, how="left")


def push_upsert(offline: DataFrame, online: DataFrame | None, pushed: DataFrame, keys: list[str], ts: str,
                columns: list[str], tie_breaker: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Append pushed rows to the offline table and replace online values where the pushed row is newer."""
    new_offline = offline.unionByName(pushed)
    base = online if online is not None else offline
    cols = list(dict.fromkeys([*keys, ts, *columns, *([tie_breaker] if tie_breaker else [])]))
    new_online = latest_per_key(base.select(*cols).unionByName(pushed.select(*cols)), keys, ts,
                                [c for c in columns if c not in keys and c != ts], tie_breaker)
    return new_offline, new_online
