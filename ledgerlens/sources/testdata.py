"""The given test tables and the fixtures Spark derives from them.

Each derived fixture has a Spark definition and a DuckDB twin (``*_SQL``, a CTE body) so a query over the fixture
can be checked against the same rows in DuckDB.  Every fixture is a plain projection, filter or aggregate over
the given tables, so its size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import sql_uniform, uniform

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------------------------------------------
# transactions: events mapped to the nine-column transaction schema
#   event_id -> transaction_id, ts -> tx_datetime text, user_id -> customer_id, event_id mod 100 -> terminal_id,
#   value -> tx_amount, seconds of day -> tx_time_seconds, days since the first date -> tx_time_days,
#   event_type = 'error' -> tx_fraud, 0 -> tx_fraud_scenario
# --------------------------------------------------------------------------------------------------------------

def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    first_day = ev.agg(F.min(F.to_date("ts")).alias("_d0")).scalar()   # scalar subquery, no join, no collect
    return (ev
            .select(F.col("event_id").alias("transaction_id"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("tx_datetime"),
                    F.col("user_id").alias("customer_id"),
                    (F.col("event_id") % 100).alias("terminal_id"),
                    F.col("value").alias("tx_amount"),
                    (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("int").alias("tx_time_seconds"),
                    F.datediff(F.to_date("ts"), first_day).alias("tx_time_days"),
                    (F.col("event_type") == "error").cast("int").alias("tx_fraud"),
                    F.lit(0).alias("tx_fraud_scenario")))


TX_SQL = """
SELECT event_id AS transaction_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS tx_datetime,
       user_id AS customer_id,
       event_id % 100 AS terminal_id,
       value AS tx_amount,
       CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS tx_time_seconds,
       CAST(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS INTEGER) AS tx_time_days,
       CAST(event_type = 'error' AS INTEGER) AS tx_fraud,
       0 AS tx_fraud_scenario
FROM events"""

TX_COLUMNS = ["transaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds",
              "tx_time_days", "tx_fraud", "tx_fraud_scenario"]


# --------------------------------------------------------------------------------------------------------------
# raw transaction text: headerless comma lines with the edge rows the cleaning chain must handle
#   u = uniform(transaction_id, 'raw'):  u < 0.01 -> empty tx_amount field (null after parse, removed by drop_na)
#                                        0.01 <= u < 0.015 -> short line of four fields (malformed, dropped)
#                                        0.015 <= u < 0.02 -> the time as a quoted field with a comma in it (kept)
#                                        0.02 <= u < 0.025 -> 'abc' as amount (malformed, dropped)
#   plus one header line (id does not parse -> null id, removed by drop_header)
# --------------------------------------------------------------------------------------------------------------

RAW_EMPTY_AMOUNT = 0.01
RAW_SHORT_LINE = 0.015
RAW_QUOTED = 0.02
RAW_BAD_NUMBER = 0.025
RAW_HEADER = ",".join(TX_COLUMNS)


def raw_transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    u = uniform("transaction_id", "raw")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TX_COLUMNS]
    amount_blank = [F.lit("") if c == "tx_amount" else f for c, f in zip(TX_COLUMNS, fields)]
    line = (F.when(u < RAW_EMPTY_AMOUNT, F.concat_ws(",", *amount_blank))
            .when(u < RAW_SHORT_LINE, F.concat_ws(",", *fields[:4]))
            .when(u < RAW_QUOTED, F.concat_ws(",", fields[0], F.concat(F.lit('"'), F.replace(fields[1], F.lit(" "), F.lit(", ")),
                                                                       F.lit('"')), *fields[2:]))
            .when(u < RAW_BAD_NUMBER, F.concat_ws(",", *(F.lit("abc") if c == "tx_amount" else f
                                                         for c, f in zip(TX_COLUMNS, fields))))
            .otherwise(F.concat_ws(",", *fields)))
    header = tx.limit(1).select(F.lit(RAW_HEADER).alias("value"))
    return tx.select(line.alias("value")).unionByName(header)


_u_raw = sql_uniform("event_id", "raw")
RAW_TX_SQL = f"""
SELECT CAST(transaction_id AS INTEGER) AS transaction_id,
       CASE WHEN u >= {RAW_SHORT_LINE} AND u < {RAW_QUOTED} THEN replace(tx_datetime, ' ', ', ') ELSE tx_datetime END AS tx_datetime,
       CAST(customer_id AS INTEGER) AS customer_id, CAST(terminal_id AS INTEGER) AS terminal_id,
       CASE WHEN u < {RAW_EMPTY_AMOUNT} THEN NULL ELSE tx_amount END AS tx_amount,
       tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario
FROM (SELECT t.*, {sql_uniform('transaction_id', 'raw')} AS u FROM ({TX_SQL}) t)
WHERE NOT (u >= {RAW_EMPTY_AMOUNT} AND u < {RAW_SHORT_LINE}) AND NOT (u >= {RAW_QUOTED} AND u < {RAW_BAD_NUMBER})"""

_written: dict[tuple, str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Folder of a derived fixture in the shared folder, made by ``build(path)`` once per application and state of the
    input tables (application id, names and change times of the files)."""
    from ledgerlens.session import scratch_path
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(sf_dir)
    state = tuple(sorted((str(f.getPath()), f.getModificationTime()) for f in root.getFileSystem(conf).listStatus(root)))
    key = (spark.sparkContext.applicationId, sf_dir, name, state)
    if key not in _written:
        path = scratch_path(spark, name)
        build(path)
        _written[key] = path
    return _written[key]


def raw_transaction_dir(spark: SparkSession, sf_dir: str) -> str:
    """The raw text as a folder of files."""
    return written(spark, sf_dir, "raw-transactions", lambda path: raw_transaction_lines(spark, sf_dir)
                   .write.mode("overwrite").text(path))


def sum_input_dir(spark: SparkSession, sf_dir: str) -> str:
    """One INT per line with '#' comment lines: terminal ids of all transactions."""
    def build(path):
        tx = transactions(spark, sf_dir)
        lines = tx.select(F.col("terminal_id").cast("string").alias("value"))
        comment = tx.limit(1).select(F.lit("# field: terminal id of each transaction").alias("value"))
        comment.unionByName(lines).write.mode("overwrite").text(path)
    return written(spark, sf_dir, "sum-input", build)


# --------------------------------------------------------------------------------------------------------------
# answers / lectures stand-in (lineitem / part)
#   user_id = l_suppkey, content_id = l_partkey, content_type_id = 1 for return flag 'N' (lecture rows),
#   answered_correctly = -1 for lectures, 1 for 'R', 0 for 'A'; timestamp = epoch milliseconds of l_shipdate
#   lectures: lecture_id = p_partkey, tag = p_brand, part = p_size, type_of = p_type
# --------------------------------------------------------------------------------------------------------------

def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("content_id"),
        (F.col("l_returnflag") == "N").cast("int").alias("content_type_id"),
        F.when(F.col("l_returnflag") == "N", -1).when(F.col("l_returnflag") == "R", 1).otherwise(0)
         .alias("answered_correctly"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"))


ANSWERS_SQL = """
SELECT l_suppkey AS user_id, l_partkey AS content_id, CAST(l_returnflag = 'N' AS INTEGER) AS content_type_id,
       CASE WHEN l_returnflag = 'N' THEN -1 WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS answered_correctly,
       epoch_ms(l_shipdate) AS timestamp
FROM lineitem"""


def lectures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("lecture_id"), F.col("p_brand").alias("tag"),
        F.col("p_size").alias("part"), F.col("p_type").alias("type_of"))


LECTURES_SQL = "SELECT p_partkey AS lecture_id, p_brand AS tag, p_size AS part, p_type AS type_of FROM part"


# --------------------------------------------------------------------------------------------------------------
# labelled URLs (pages): 'bad' for plain http, 'good' for https, anything else kept as 'unknown'
# --------------------------------------------------------------------------------------------------------------

def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url",
                    F.when(F.col("url").startswith("http://"), "bad")
                     .when(F.col("url").startswith("https://"), "good").otherwise("unknown").alias("label"))


URLS_SQL = """
SELECT page_id, url, CASE WHEN starts_with(url, 'http://') THEN 'bad' WHEN starts_with(url, 'https://') THEN 'good'
                          ELSE 'unknown' END AS label
FROM pages"""


# --------------------------------------------------------------------------------------------------------------
# evaluation: y_test = quality; base model predicts toxic, candidate predicts not toxic
# --------------------------------------------------------------------------------------------------------------

def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    return lab.select("doc_id", F.col("quality").alias("y_test"),
                      F.col("toxic").cast("double").alias("y_pred_base"),
                      (1 - F.col("toxic")).cast("double").alias("y_pred_cand"))


EVAL_SQL = """
SELECT doc_id, quality AS y_test, CAST(toxic AS DOUBLE) AS y_pred_base, CAST(1 - toxic AS DOUBLE) AS y_pred_cand
FROM labels"""


# --------------------------------------------------------------------------------------------------------------
# offsets: one sample per (topic, partition) at the end of every hour of the data
#   topic = event_type, partition = user_id mod 3, end = events up to the end of the hour,
#   committed = end one hour earlier (the consumer is one hour behind); topic 'signup' is never committed
# --------------------------------------------------------------------------------------------------------------

def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    per_hour = ev.groupBy("topic", "partition", "hour").agg(F.count(F.lit(1)).alias("n"))
    # hourly grid per (topic, partition): its size is hours x partitions, independent of the row count.  Each row of
    # per_hour stands for its hour and for the empty ones before the next row; the first and the last row of a
    # partition reach out to the bounds of all, so the events are read once
    by = W.partitionBy("topic", "partition").orderBy("hour")
    everything = W.partitionBy()
    step = F.expr("INTERVAL 1 HOUR")
    spans = (per_hour.withColumn("_mn", F.min("hour").over(everything)).withColumn("_mx", F.max("hour").over(everything))
             .withColumn("_from", F.when(F.row_number().over(by) == 1, F.col("_mn")).otherwise(F.col("hour")))
             .withColumn("_to", F.coalesce(F.lead("hour").over(by) - step, F.col("_mx"))))
    filled = spans.select("topic", "partition", F.col("hour").alias("_at"), "n",
                          F.explode(F.sequence("_from", "_to", step)).alias("hour"))
    filled = filled.withColumn("n", F.when(F.col("hour") == F.col("_at"), F.col("n")).otherwise(F.lit(0)))
    w = W.partitionBy("topic", "partition").orderBy("hour").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum("n").over(w)
    return filled.select(
        "topic", "partition",
        F.when(F.col("topic") == "signup", F.lit(None).cast("bigint")).otherwise(end - F.col("n")).alias("committed"),
        end.alias("end"),
        (F.col("hour") + F.expr("INTERVAL 1 HOUR")).alias("sampled_at"))


OFFSETS_SQL = """
WITH ph AS (SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", date_trunc('hour', ts) AS hour,
                   count(*) AS n FROM events GROUP BY ALL),
b AS (SELECT min(date_trunc('hour', ts)) AS mn, max(date_trunc('hour', ts)) AS mx FROM events),
g AS (SELECT tp.topic, tp."partition", unnest(generate_series(b.mn, b.mx, INTERVAL 1 HOUR)) AS hour
      FROM (SELECT DISTINCT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition" FROM events) tp, b),
x AS (SELECT g.topic, g."partition", g.hour, coalesce(ph.n, 0) AS n FROM g LEFT JOIN ph USING (topic, "partition", hour)),
c AS (SELECT *, CAST(sum(n) OVER (PARTITION BY topic, "partition" ORDER BY hour) AS BIGINT) AS e FROM x)
SELECT topic, "partition", CASE WHEN topic = 'signup' THEN NULL ELSE e - n END AS committed, e AS "end",
       hour + INTERVAL 1 HOUR AS sampled_at
FROM c"""


# --------------------------------------------------------------------------------------------------------------
# counter samples: what three instances (user_id mod 3) would show when read once a minute, an hour of events a minute
#   counters of requests, errors and fraud predictions, and duration buckets (value / 100 seconds); an instance starts
#   again every 37 minutes, a tenth of the reads is missing, a tenth comes twice, the second time with a stale value;
#   and a gauge: replicas, three and the requests of the hour modulo 4
# --------------------------------------------------------------------------------------------------------------

#: fixed values: upper bounds of the duration buckets in seconds
DURATION_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, float("inf"))


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(instance, metric, le, read_at, value)."""
    from pyspark.sql import Window as W
    from ledgerlens.functions.scoring import request_risk_score
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    fraud = request_risk_score(F.col("value"), seconds, F.col("user_id"), large=100.0, medium=50.0) > 0.5
    ev = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 3).alias("i"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3_600_000_000)).alias("hour"),
        (F.col("event_type") == "error").alias("error"), fraud.alias("fraud"), (F.col("value") / 100.0).alias("lat"))
    bounds = {f"b{k}": b for k, b in enumerate(DURATION_BOUNDS)}
    hours = ev.groupBy("i", "hour").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("error").alias("errors"), F.count_if("fraud").alias("fraud"),
        *(F.count_if(F.col("lat") <= F.lit(b)).alias(c) for c, b in bounds.items()))
    life = W.partitionBy("i", F.floor((F.col("hour") + 11 * F.col("i")) / 37)).orderBy("hour").rowsBetween(W.unboundedPreceding, 0)
    row = lambda metric, c, le=None: F.struct(F.lit(metric).alias("metric"), F.lit(le).cast("double").alias("le"),
                                              c.cast("double").alias("value"))
    sums = hours.select("i", "hour", (3 + F.col("requests") % 4).alias("replicas"),
                        *(F.sum(c).over(life).alias(c) for c in ("requests", "errors", "fraud", *bounds)))
    shown = sums.select("i", "hour", F.explode(F.array(
        row("http_requests_total", F.col("requests")), row("http_errors_total", F.col("errors")),
        row("ml_model_predictions_fraud", F.col("fraud")), row("replicas", F.col("replicas")),
        *(row("http_request_duration_seconds_bucket", F.col(c), b) for c, b in bounds.items()))).alias("m"))
    key = F.concat_ws(":", F.col("i").cast("string"), F.col("hour").cast("string"))
    read = shown.withColumn("key", key).filter(uniform("key", "gap") >= 0.1)
    read = read.select("i", "hour", "m.*", F.explode(F.when((uniform("key", "late") < 0.1) & (F.col("m.metric") != "replicas"), F.array(
        F.col("m.value"), F.floor(F.col("m.value") / 2).cast("double"))).otherwise(F.array("m.value"))).alias("v"))
    return read.select(F.concat(F.lit("api-"), F.col("i").cast("string")).alias("instance"), "metric", "le",
                       F.timestamp_seconds(F.col("hour") * 60).cast("timestamp_ntz").alias("read_at"), F.col("v").alias("value"))


def counter_samples_sql() -> str:
    from ledgerlens.functions.scoring import request_risk_score_sql
    p = request_risk_score_sql("value", "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))", "user_id", large=100.0, medium=50.0)
    le = lambda b: "CAST('inf' AS DOUBLE)" if b == float("inf") else f"{b}::DOUBLE"
    shown = [("http_requests_total", "NULL", "requests"), ("http_errors_total", "NULL", "errors"),
             ("ml_model_predictions_fraud", "NULL", "fraud")]
    shown += [("http_request_duration_seconds_bucket", le(b), f"b{k}") for k, b in enumerate(DURATION_BOUNDS)]
    counters = " UNION ALL ".join(
        f"SELECT i, hour, '{m}' AS metric, CAST({b} AS DOUBLE) AS le, CAST(sum({c}) OVER (PARTITION BY i, (hour + 11 * i) // 37 "
        f"ORDER BY hour) AS DOUBLE) AS value FROM hours" for m, b, c in shown)
    buckets = ", ".join(f"count(*) FILTER (WHERE lat <= {le(b)}) AS b{k}" for k, b in enumerate(DURATION_BOUNDS))
    return f"""
WITH ev AS (SELECT user_id % 3 AS i, epoch_us(ts) // 3600000000 AS hour, event_type = 'error' AS error, {p} > 0.5 AS fraud,
                   value / 100.0 AS lat FROM events),
hours AS (SELECT i, hour, count(*) AS requests, count(*) FILTER (WHERE error) AS errors, count(*) FILTER (WHERE fraud) AS fraud,
                 {buckets} FROM ev GROUP BY i, hour),
shown AS ({counters} UNION ALL SELECT i, hour, 'replicas', NULL, CAST(3 + requests % 4 AS DOUBLE) FROM hours),
kept AS (SELECT *, concat_ws(':', i, hour) AS key FROM shown WHERE {sql_uniform("concat_ws(':', i, hour)", 'gap')} >= 0.1),
again AS (SELECT i, hour, metric, le, value FROM kept UNION ALL
          SELECT i, hour, metric, le, floor(value / 2) FROM kept WHERE metric <> 'replicas' AND {sql_uniform('key', 'late')} < 0.1)
SELECT 'api-' || i AS instance, metric, le, make_timestamp(hour * 60000000) AS read_at, value FROM again"""


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw text read back with the explicit schema (malformed and header lines removed)."""
    from ledgerlens.sources.files import read_transactions
    return read_transactions(spark, raw_transaction_dir(spark, sf_dir))


def csv_with_header_dir(spark: SparkSession, sf_dir: str) -> str:
    """Transactions as CSV with a header line in every file."""
    return written(spark, sf_dir, "tx-csv-header", lambda path: transactions(spark, sf_dir)
                   .write.mode("overwrite").option("header", "true").csv(path))


def events_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a feature source keyed by customer: amount, seconds of day, fraud flag, kind."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("customer_id"), "ts", "event_id", "event_type",
                     F.col("value").alias("tx_amount"),
                     (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("int").alias("tx_time_seconds"),
                     (F.col("event_type") == "error").cast("int").alias("tx_fraud"))


EVENTS_FEATURES_SQL = """
SELECT user_id AS customer_id, ts, event_id, event_type, value AS tx_amount,
       CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS tx_time_seconds,
       CAST(event_type = 'error' AS INTEGER) AS tx_fraud
FROM events"""


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned transactions as written by the cleaning job (Parquet in the shared folder, written once per
    session); downstream jobs (labels, training, scoring) read this table, as the reference's jobs read the
    cleaned Parquet, which also cuts the lineage back to the raw text."""
    from ledgerlens.operators.cleaning import clean_transactions
    return spark.read.parquet(written(spark, sf_dir, "clean-transactions", lambda path: clean_transactions(
        raw_transactions(spark, sf_dir)).write.mode("overwrite").parquet(path)))
