"""Mixing sources to target weights: Pareto order sampling after certain whole copies.

Per source: size = words; the targets share all words by weight, capped at ``cap`` times the source's size, the excess
shared again by weight (water-filling, solved in closed form by one pass over the sources in order of cap / weight).
Each document of a source with ratio r = target / size gets floor(r) certain copies.  The rest of the target is met by
a Pareto order sample: documents are ranked by (u / (1 - u)) / (p / (1 - p)), u a repeatable draw of the document and
p its inclusion probability, and taken in rank order until the words left over are used up; the document at the edge is
taken if that lands nearer.

Within a source p is proportional to a weight: the number of binary digits of the document's size, so long documents
are likelier but not by their whole length, or a given column.  Documents whose p would pass 1 are certain, and the
factor of the others is solved again without them, over the distinct weights of the source.

Everything is DataFrame expressions.  The running sum over a source never sorts the source in one task: ranks are
cut into buckets of about ``bucket_rows`` rows by the draw's known distribution, bucket sums are scanned per source,
and only rows of the bucket that holds the edge are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.registry import register, table
from ledgerlens.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
CAP = 3
FEW_SOURCES = 50_000
ROUNDS = 3                           # passes over the edge bucket
TWO_52 = 4503599627370496.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(key: Column, seed: str) -> Column:
    """A uniform number in (0, 1) from 52 bits of md5(key:seed); the same in every run."""
    digits = F.substring(F.md5(F.concat_ws(":", key, F.lit(seed))), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(TWO_52)


def source_targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """One row per source (source, n, total) -> with weight (1, 2, 3, repeating by code point, null last) and target.

    One row per source in one window: as many rows as sources, each task having summed its own rows before.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("bigint"))
    # sources are full in order of (cap * total / weight); t_k is the water level if the first k are full
    order = Window.orderBy((F.col("total") * cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    # a source is never full after one that is not, and with cap > 1 the last one never is (or there are no words)
    w = (w.withColumn("level", (F.sum("total").over(whole) - cap * F.coalesce(F.sum("total").over(upto), F.lit(0)))
                      / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0))))
         .withColumn("full", F.col("level") * F.col("weight") >= F.col("total") * cap))
    # the level that holds is that of the first source that is not full: of sources that tie, the highest one
    w = w.withColumn("level", -F.min(F.when(~F.col("full"), F.struct(F.col("total") * cap / F.col("weight"),
                                                                     (-F.col("level")).alias("minus")))).over(whole)["minus"])
    return w.select(*sizes.columns, "weight", F.coalesce(F.least(
        F.col("weight") * F.col("level"), (F.col("total") * cap).cast("double")),
        F.lit(0.0)).alias("target"))


def five_digits(weight: Column) -> Column:
    """A weight cut to its first five binary digits after the leading one, so a source has few distinct ones; whole
    numbers below 64 stay.  Null or NaN is 1; at most 1e200, and 0 below 1e-200."""
    w = F.least(F.coalesce(F.nanvl(weight.cast("double"), F.lit(1.0)), F.lit(1.0)), F.lit(1e200))
    unit = F.pow(F.lit(2.0), F.floor(F.log2(w)) - 5)
    return F.when(w >= 1e-200, F.floor(w / unit) * unit).otherwise(F.lit(0.0))


def factor(classes: Column, rest: Column, total: Column) -> Column:
    """p0 such that documents taken with p = min(1, p0 * weight) hold ``rest`` words on average.

    ``classes``: (boost, words) of a source's distinct weights, ascending.  If the classes after the k-th are certain,
    p0 is what is left of ``rest`` by the weighted words of the first k; it holds for the largest k that stays below 1.
    """
    def step(acc, x):
        words, weighted = acc["words"] + x["words"], acc["weighted"] + x["boost"] * x["words"]
        level = (rest - (total - words).cast("double")) / F.when(weighted > 0, weighted)
        return F.struct(words.alias("words"), weighted.alias("weighted"),
                        F.when((x["words"] > 0) & (level * x["boost"] < 1), level).otherwise(acc["p0"]).alias("p0"))

    start = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0.0).alias("weighted"),
                     F.lit(None).cast("double").alias("p0"))
    return F.aggregate(classes, start, step, lambda acc: F.coalesce(
        acc["p0"], F.when(acc["weighted"] > 0, F.lit(1e300)).otherwise(F.lit(0.0))))


def mix(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source",
        weight_col: str | None = None, cap: int = CAP, seed: str = "mix", bucket_rows: int = 1000) -> DataFrame:
    """The rows of ``df`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (= copies * size).

    Null text: size 0, never taken beyond its certain copies.  Null source: a source of its own.  Null or repeated
    ids: rows with the same id and text draw the same number and stay in a fixed order only up to exchange of equal
    rows.  ``weight_col``: inclusion weights within a source (first binary digits count, see ``five_digits``), else by
    size; documents of weight 0 come last.  A source without words has target 0.  Columns of ``df`` with the added names are replaced.
    """
    spark = df.sparkSession
    keep = [c for c in df.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                      F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    drawn = {"_source": F.col(source_col), "_size": word_count(F.col(text_col)), "_u": draw(key, seed), "_tie": key,
             "_boost": five_digits(F.col(weight_col)) if weight_col
             else F.length(F.bin(word_count(F.col(text_col)))).cast("double")}
    light_path, plan_path = scratch_path(spark, "mix-draws"), scratch_path(spark, "mix-plan")
    # the texts are read here once and once more for the result; the steps between read only these few columns
    df.select(*(v.alias(k) for k, v in drawn.items())).write.parquet(light_path)
    light = spark.read.parquet(light_path)
    # distinct weights are few (five_digits, or the digits of a size), so a source's fit into one array
    sums = (light.groupBy("_source", "_boost").agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("words"))
            .groupBy("_source").agg(F.sum("n").alias("n"), F.sum("words").alias("total"),
                                    F.sort_array(F.collect_list(F.struct(F.col("_boost").alias("boost"), "words")))
                                    .alias("classes")))
    plan = (source_targets(sums.withColumnRenamed("_source", "source"), cap)
            .withColumn("certain", F.when(F.col("total") > 0, F.floor(F.col("target") / F.greatest(F.col("total"), F.lit(1))))
                        .otherwise(F.lit(0)).cast("bigint"))
            .withColumn("rest", F.col("target") - F.col("certain") * F.col("total"))
            .withColumn("p0", factor(F.col("classes"), F.col("rest"), F.col("total"))).drop("classes")
            .withColumn("buckets", F.ceil(F.col("n") / bucket_rows)))
    plan.write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    cuts = _cuts(_ranked(light, plan), plan.count() <= FEW_SOURCES)
    cuts_path = scratch_path(spark, "mix-cuts")
    (plan.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
     .write.parquet(cuts_path))
    known = spark.read.parquet(cuts_path)
    # the rows travel as one struct, so that no name of theirs meets a name used here
    rows = _ranked(df.select(F.struct(*keep).alias("_row"), *(v.alias(k) for k, v in drawn.items())), known)
    plan_of = lambda c: F.col(f"_plan.{c}")
    inside = F.lit(False)
    for k in range(ROUNDS):
        inside = inside | ((F.struct("_q", "_tie") <= plan_of(f"cut{k}")) & (F.col("_size") <= plan_of(f"limit{k}"))
                           ).eqNullSafe(F.lit(True))
    extra = (plan_of("edge").isNull() | (F.col("_bucket") < plan_of("edge"))
             | ((F.col("_bucket") == plan_of("edge")) & inside).eqNullSafe(F.lit(True)) | plan_of("pick").eqNullSafe(F.col("_tie")))
    copies = plan_of("certain") + F.when(extra & (plan_of("rest") > 0), 1).otherwise(0)
    return rows.select("_row.*", F.col("_size").alias("size"), plan_of("total").alias("source_size"),
                       plan_of("target").alias("target"), copies.alias("copies"),
                       (copies * F.col("_size")).alias("taken"))


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan, the Pareto rank ``_q`` and its bucket.

    The plan has one row per source.  Up to ``FEW_SOURCES`` of them are broadcast (some 100 bytes each); beyond that the
    join is a shuffle, in which the engine splits a hot source's partition.
    """
    few = plan.count() <= FEW_SOURCES
    plan = plan.select(F.col("source").alias("_key"), F.struct(*plan.columns).alias("_plan"))
    if few:
        plan = F.broadcast(plan)
    p = F.least(F.col("_plan.p0") * F.col("_boost"), F.lit(1.0))
    odds = (F.when(p > 0, F.col("_u") * (1 - p) / ((1 - F.col("_u")) * F.greatest(p, F.lit(1e-300))))
            .otherwise(1e300 * (1 + F.col("_u"))))
    # certain rows stand before all others (they never hold more than ``rest``), rows of no weight behind them
    bucket = (F.when(p >= 1, -1).when(p > 0, F.floor(F.col("_q") / (1 + F.col("_q")) * F.col("_plan.buckets")))
              .otherwise(F.floor((1 + F.col("_u")) * F.col("_plan.buckets"))))
    return (rows.join(plan, F.col("_source").eqNullSafe(F.col("_key"))).drop("_key").withColumn("_q", odds)
            .withColumn("_bucket", bucket))


def _cuts(rows: DataFrame, few: bool) -> DataFrame:
    """Per source: the bucket in which the words run out, the last rank taken in it, and the document that fills up.

    All buckets before the edge are taken.  In it, documents are taken in rank order while they fit.  What is left
    goes, again in rank order, to documents no longer than it (twice), and then to the document of the bucket whose
    size is nearest to the gap (if nearer than none).  Each round is two numbers a source: the last rank taken and the
    longest size allowed.
    """
    rows = rows.withColumn("rest", F.col("_plan.rest")).drop("_plan")
    by = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = (rows.groupBy("_source", "_bucket", "rest").agg(F.sum("_size").alias("s"))
            .withColumn("upto", F.sum("s").over(by)))
    edges = (sums.filter(F.col("upto") > F.col("rest")).groupBy("_source")
             .agg(F.min(F.struct("_bucket", (F.col("upto") - F.col("s")).alias("before"))).alias("e"))
             .select(F.col("_source").alias("source"), F.col("e._bucket").alias("edge"), F.col("e.before")))
    if few:
        edges = F.broadcast(edges)
    inside = rows.join(edges, F.col("_source").eqNullSafe(F.col("source")) & (F.col("_bucket") == F.col("edge")))
    rank = Window.partitionBy("source").orderBy("_q", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("source")
    inside = inside.withColumn("in", F.lit(False)).withColumn("used", F.col("before").cast("double"))
    out = []
    for k in range(ROUNDS):
        gap = F.col("rest") - F.col("used")
        may = ~F.col("in") & (F.col("_size") <= gap) if k else F.lit(True)
        inside = (inside.withColumn("gap", gap).withColumn("may", may)
                  .withColumn("after", F.col("used") + F.sum(F.when(F.col("may"), F.col("_size")).otherwise(0)).over(rank))
                  .withColumn("fits", F.col("may") & (F.col("after") <= F.col("rest")))
                  .withColumn("in", F.col("in") | F.col("fits"))
                  .withColumn("used", F.coalesce(F.max(F.when(F.col("fits"), F.col("after"))).over(whole), F.col("used")))
                  .withColumn(f"got{k}", F.when(F.col("fits"), F.struct("_q", "_tie"))))
        limit = F.lit(float("inf")) if k == 0 else F.col("gap")
        inside = inside.withColumn(f"limit{k}", limit)
        out += [F.max(f"got{k}").alias(f"cut{k}"), F.first(f"limit{k}").alias(f"limit{k}")]
    gap = F.col("rest") - F.col("used")
    miss = F.abs(gap - F.col("_size"))
    return inside.groupBy("source", "edge").agg(
        *out, F.min(F.when(~F.col("in") & (miss < gap), F.struct(miss.alias("m"), "_q", "_tie")))["_tie"].alias("pick"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS size,
         concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), 'null'), md5(coalesce(text, ''))) AS tie
  FROM documents),
u AS (SELECT *, length(bin(size))::DOUBLE AS boost, (CAST(('0x' || substr(md5(concat_ws(':', tie, 'mix')), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
                / 4503599627370496.0::DOUBLE AS u FROM d),
s AS (SELECT source, sum(size)::BIGINT AS total FROM u GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
l AS (SELECT *, (sum(total) OVER () - 3 * coalesce(sum(total) OVER o, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level,
         total * 3 / weight::DOUBLE AS fill
  FROM w WINDOW o AS (ORDER BY total * 3 / weight::DOUBLE, encode(source) NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT -(min({'f': fill, 'l': -level}) FILTER (WHERE level * weight < total * 3)).l AS level FROM l),
t AS (SELECT source, total, coalesce(least(weight * v.level, (total * 3)::DOUBLE), 0.0::DOUBLE) AS target FROM l, v),
p AS (SELECT *, CASE WHEN total > 0 THEN floor(target / total::DOUBLE) ELSE 0 END::BIGINT AS certain FROM t),
q0 AS (SELECT *, target - certain * total AS rest FROM p),
cl AS (SELECT source, boost, sum(size) AS words FROM u GROUP BY source, boost HAVING sum(size) > 0),
cu AS (SELECT source, boost, sum(words) OVER upto AS cw, sum(boost * words) OVER upto AS cb
       FROM cl WINDOW upto AS (PARTITION BY source ORDER BY boost ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
lv AS (SELECT q0.source, boost, (rest - (total - cw)::DOUBLE) / cb::DOUBLE AS level
       FROM q0 JOIN cu ON q0.source IS NOT DISTINCT FROM cu.source),
z AS (SELECT source, arg_max(level, boost) AS p0 FROM lv WHERE level * boost < 1 GROUP BY source),
q AS (SELECT q0.*, coalesce(z.p0, 1e300) AS p0 FROM q0 LEFT JOIN z ON q0.source IS NOT DISTINCT FROM z.source),
r0 AS (SELECT u.doc_id, u.size, u.tie, u.u, q.*, least(q.p0 * u.boost, 1.0::DOUBLE) AS p
  FROM u JOIN q ON u.source IS NOT DISTINCT FROM q.source),
r AS (SELECT * EXCLUDE u, CASE WHEN p > 0 THEN u * (1 - p) / ((1 - u) * p) ELSE 1e300 * (1 + u) END AS odds FROM r0),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds, tie
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after FROM r),
b AS (SELECT *, CASE WHEN p >= 1 THEN -1 ELSE least(floor(
           odds / (1 + odds) * ceil(count(*) OVER (PARTITION BY source) / 1000.0::DOUBLE)), 1e15) END AS bucket FROM c),
e AS (SELECT source, min(bucket) AS edge FROM b WHERE after > rest GROUP BY source),
f0 AS (SELECT b.* EXCLUDE after, e.edge, bucket = e.edge AS here, after <= rest AS taken_in,
              rest - coalesce(max(CASE WHEN after <= rest THEN after END) OVER (PARTITION BY b.source), 0) AS gap
       FROM b LEFT JOIN e ON b.source IS NOT DISTINCT FROM e.source),
ROUNDS
k AS (SELECT source, (min({'m': abs(gap - size), 'q': odds, 't': tie})
                      FILTER (WHERE NOT taken_in AND here AND abs(gap - size) < gap)).t AS pick FROM f2 GROUP BY source),
x AS (SELECT f2.*, CASE WHEN rest > 0 AND (taken_in OR tie IS NOT DISTINCT FROM k.pick) THEN 1 ELSE 0 END AS extra
  FROM f2 LEFT JOIN k ON f2.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, total AS source_size, target, (certain + extra) * size AS taken FROM x
"""

OP5_SQL = OP5_SQL.replace("ROUNDS", "".join(f"""
s{k} AS (SELECT *, sum(CASE WHEN NOT taken_in AND here AND size <= gap THEN size ELSE 0 END)
                   OVER (PARTITION BY source ORDER BY odds, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
       FROM f{k - 1}),
t{k} AS (SELECT *, NOT taken_in AND here AND size <= gap AND run <= gap AS more FROM s{k}),
f{k} AS (SELECT * EXCLUDE (taken_in, gap, run, more), taken_in OR more AS taken_in,
                gap - coalesce(max(CASE WHEN more THEN run END) OVER (PARTITION BY source), 0) AS gap FROM t{k}),"""
                                            for k in range(1, ROUNDS)))


@register("op5_pareto_mix", OP5_SQL)
def op5_pareto_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
