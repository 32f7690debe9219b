"""Streaming queries.  History is stored as Kafka-shaped record files and replayed through Structured Streaming
file sources (the Kafka connector is not installed here); each query drains the replay with ``availableNow``
and returns what its sink holds, so the stream answer can be compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from ledgerlens.functions import scoring as S
from ledgerlens.operators import labels as L
from ledgerlens.operators import ml as ML
from ledgerlens.operators import monitoring as M
from ledgerlens.plans.common import HUGE, LARGE, MEDIUM, RAW_TX_SQL, TX_SQL
from ledgerlens.plans.ml import MODEL_NAME, champion_table
from ledgerlens.plans.monitoring import GAUGE_LIMITS, GAUGES, _gauges
from ledgerlens.plans.registry import ORACLE, register
from ledgerlens.schemas import CLICK_SCHEMA
from ledgerlens.session import scratch_path
from ledgerlens.sources import testdata as T
from ledgerlens.streaming import io as IO
from ledgerlens.streaming.alerts import alert_events, with_rocksdb
from ledgerlens.streaming.jobs import (PARSE_ERROR, dead_letters, parse_stream, predictions_output,
                                        score_with_heuristic_udf, to_envelope, well_formed, windowed_rates)
from ledgerlens.streaming.positions import read_once, stream_offsets
from ledgerlens.streaming.udfs import external_scoring, request_scorer
from ledgerlens.functions.hashing import sql_uniform, uniform

ROWS_PER_FILE = 12_500      # of the stored history, more in a long one; a trigger reads FILES_PER_TRIGGER files
FILES_PER_TRIGGER = 2


def _records(spark, sf, kind: str = "tx", sample_n: int | None = None, least_files: int = 2) -> str:
    """Stored history: ``tx`` envelopes; ``raw`` envelopes of the raw rows; ``broken`` as tx, but cut short where the
    draw is below 0.02; ``flat`` flat payloads."""
    def build(path):
        src = T.raw_transactions(spark, sf) if kind == "raw" else T.transactions(spark, sf)
        if sample_n:
            src = L.sample_n(src, sample_n, "transaction_id", 42)
        at = F.col("_ts")
        value = to_envelope(src, sent_at=at) if kind != "flat" else F.to_json(F.struct(
            F.col("transaction_id").cast("string").alias("transaction_id"), "tx_amount", "tx_fraud",
            F.col("customer_id").cast("string").alias("account_id"), F.col("terminal_id").cast("string").alias("merchant_id"),
            F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "tx_time_seconds", "tx_time_days"))
        if kind in ("broken", "flat"):
            value = F.when(uniform("transaction_id", "broken") < BROKEN, F.substring(value, 1, 9)).otherwise(value)
        sent = F.try_to_timestamp(F.replace("tx_datetime", F.lit(","), F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss"))
        df = src.select("*", sent.alias("_ts"), F.pmod(F.col("customer_id"), F.lit(3)).alias("_part"))
        IO.write_records(df, path, "transaction_id", value, "transactions-input", "_part", "transaction_id", "_ts",
                         ROWS_PER_FILE, least_files=least_files)
    return T.written(spark, sf, f"records-{kind}-{sample_n or 'all'}-{least_files}", build)


BROKEN = 0.02


def _drain(df, name):
    spark = df.sparkSession
    out = scratch_path(spark, f"sink-{name}")
    IO.run_to_parquet(df, out)
    return spark.read.parquet(out)


_PARSED_COLS = """CAST(transaction_id AS VARCHAR) AS transaction_id, tx_datetime, customer_id, terminal_id, tx_amount,
       tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario"""
_META_COLS = """CAST(transaction_id AS VARCHAR) AS kafka_key, CAST(customer_id % 3 AS INTEGER) AS "partition",
       CAST(transaction_id AS BIGINT) AS "offset", strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS kafka_timestamp"""
PARSED_SQL = f"SELECT {_PARSED_COLS}, {_META_COLS} FROM ({TX_SQL})"


def _parsed_stream(spark, sf, kind="tx", files_per_trigger=FILES_PER_TRIGGER, sample_n=None, keep_broken=False, least_files=2):
    src = IO.replay_source(spark, _records(spark, sf, kind, sample_n, least_files), files_per_trigger)
    # the record time is an instant; shown as UTC wall-clock time like the tables' timestamps
    out = parse_stream(src, nested=kind != "flat", keep_broken=keep_broken)
    return out.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))


_IS_BROKEN = f"{sql_uniform('transaction_id', 'broken')} < {BROKEN}"


def _split_sink(spark, sf, kind):
    """Parsed records and dead letters of one pass, as partitions of one sink."""
    root = scratch_path(spark, f"sink-{kind}")
    write = IO.idempotent_batch_writer(root, extra_partitions=("outcome",))

    def per_batch(batch_df, batch_id):
        write(batch_df.withColumn("outcome", F.when(F.col(PARSE_ERROR).isNull(), "ok").otherwise("broken")), batch_id)

    IO.foreach_batch_sink(_parsed_stream(spark, sf, kind, keep_broken=True), per_batch)
    return spark.read.parquet(root)


@register("parse_stream", f"SELECT {_PARSED_COLS}, {_META_COLS} FROM ({TX_SQL}) WHERE NOT ({_IS_BROKEN})")
def q_parse_stream(spark, sf):
    out = _split_sink(spark, sf, "broken").filter("outcome = 'ok'")
    return well_formed(out).drop("outcome", "batch_id")


@register("dead_letters", f"""
SELECT CAST(transaction_id AS VARCHAR) AS kafka_key, CAST(transaction_id AS BIGINT) AS "offset", '{{"transac' AS raw_value,
       'not an envelope with data' AS parse_error
FROM ({TX_SQL}) WHERE {_IS_BROKEN}""")
def q_dead_letters(spark, sf):
    out = _split_sink(spark, sf, "broken").filter("outcome = 'broken'")
    return dead_letters(out).select("kafka_key", "offset", "raw_value", PARSE_ERROR)


@register("parse_stream_flat", f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, tx_amount, CAST(customer_id AS VARCHAR) AS account_id,
       CAST(terminal_id AS VARCHAR) AS merchant_id, strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS "timestamp",
       {{HP}} AS fraud_prediction, CASE WHEN {{HP}} >= 0.5 THEN 'FRAUD' ELSE 'NORMAL' END AS fraud_label,
       {{HQ}} AS fraud_probability, strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS kafka_timestamp,
       CAST(transaction_id AS BIGINT) AS "offset", CAST(customer_id % 3 AS INTEGER) AS "partition"
FROM ({TX_SQL}) WHERE NOT ({_IS_BROKEN})""".format(
    HP=S.stream_heuristic_sql("tx_amount", "transaction_id", HUGE)[0],
    HQ=S.stream_heuristic_sql("tx_amount", "transaction_id", HUGE)[1]))
def q_parse_stream_flat(spark, sf):
    """Flat payloads, scored, with the columns of the prediction topic."""
    scored = score_with_heuristic_udf(_parsed_stream(spark, sf, "flat"), large=HUGE)
    return _drain(predictions_output(scored).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), "flat")


@register("replay_source", PARSED_SQL)
def q_replay_source(spark, sf):
    """The full history."""
    return _drain(_parsed_stream(spark, sf), "replay")


@register("replay_source_sampled", f"""
SELECT {_PARSED_COLS}, {_META_COLS} FROM ({TX_SQL})
ORDER BY {sql_uniform('transaction_id', 42)}, transaction_id LIMIT 1000""")
def q_replay_source_sampled(spark, sf):
    """The optional sample of the history (1,000 rows)."""
    return _drain(_parsed_stream(spark, sf, sample_n=1000), "replay")


@register("bounded_run", f"SELECT *, TRUE AS whole_batches FROM ({PARSED_SQL})")
def q_bounded_run(spark, sf):
    """A run that is stopped after three seconds leaves whole micro-batches, the first ones; a second run from its checkpoint
    adds the rest, and every record is there once."""
    df = _parsed_stream(spark, sf, files_per_trigger=1)
    out, ckpt = scratch_path(spark, "sink-bounded"), scratch_path(spark, "ckpt")
    write = IO.idempotent_batch_writer(out)
    with IO.ProgressLog(spark) as log:
        first = IO.bounded_run(IO.foreach_batch_sink(df, write, ckpt, available_now=False, processing_time="1 second"), 3)
        told = log.table(first).filter("num_input_rows > 0").select("batch_id", "num_input_rows")
        left = told.agg(F.max("batch_id").alias("last"), F.count(F.lit(1)).alias("n")).collect()[0]
    IO.foreach_batch_sink(df, write, ckpt)
    kept = spark.read.schema(f"{df.drop('batch_id').schema.simpleString()[7:-1].replace(':', ' ')}, batch_id bigint").parquet(out)
    # what the first run reported is what its batches hold, and they are the first ones
    held = kept.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    wrong = told.join(held, "batch_id", "left").filter("n IS NULL OR n <> num_input_rows").limit(1).count()
    whole = not wrong and (left["n"] == 0 or left["last"] == left["n"] - 1)
    return kept.drop("batch_id").withColumn("whole_batches", F.lit(bool(whole)))


@register("foreach_batch_sink", f"SELECT {_PARSED_COLS} FROM ({TX_SQL})")
def q_foreach_batch_sink(spark, sf):
    df = _parsed_stream(spark, sf).select("transaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount",
                                          "tx_time_seconds", "tx_time_days", "tx_fraud", "tx_fraud_scenario")
    out = scratch_path(spark, "sink-foreach")
    IO.foreach_batch_sink(df, IO.idempotent_batch_writer(out))
    return spark.read.parquet(out).drop("batch_id")


_HP, _HQ = S.stream_heuristic_sql("tx_amount", "transaction_id", HUGE)


@register("stream_score_udf", f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, {_HP} AS fraud_prediction, {_HQ} AS fraud_probability,
       CASE WHEN {_HP} >= 0.5 THEN 'FRAUD' ELSE 'NORMAL' END AS fraud_label
FROM ({TX_SQL})""")
def q_stream_score_udf(spark, sf):
    scored = score_with_heuristic_udf(_parsed_stream(spark, sf), large=HUGE)
    return _drain(scored.select("transaction_id", "fraud_prediction", "fraud_probability", "fraud_label"), "udf")


@register("stream_score", f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, tx_amount, CAST(customer_id AS VARCHAR) AS account_id,
       CAST(terminal_id AS VARCHAR) AS merchant_id, strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS "timestamp",
       TRUE AS equals_batch, TRUE AS label_ok, strptime(tx_datetime, '%Y-%m-%d %H:%M:%S') AS kafka_timestamp,
       CAST(transaction_id AS BIGINT) AS "offset", CAST(customer_id % 3 AS INTEGER) AS "partition" FROM ({TX_SQL})""")
def q_stream_score(spark, sf):
    """The saved champion over the stream; its answers are those of the same model over the table."""
    from pyspark.ml.functions import vector_to_array
    model = ML.load_champion(champion_table(spark, sf), MODEL_NAME)
    s = model.transform(_parsed_stream(spark, sf))
    out = s.select("transaction_id", "tx_amount", F.col("customer_id").cast("string").alias("account_id"),
                   F.col("terminal_id").cast("string").alias("merchant_id"),
                   F.to_timestamp("tx_datetime", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("timestamp"),
                   F.col("prediction").alias("fraud_prediction"),
                   S.fraud_label(F.col("prediction"), exact_one=True).alias("fraud_label"),
                   vector_to_array("probability")[1].alias("fraud_probability"),
                   "kafka_timestamp", "offset", "partition")
    stream = _drain(out, "model")
    batch = ML.batch_predict(model, T.transactions(spark, sf)).select(
        F.col("transaction_id").cast("string").alias("transaction_id"), "prediction", "probability_1")
    same = (F.col("fraud_prediction") == F.col("prediction")) & (F.abs(F.col("fraud_probability") - F.col("probability_1")) < 1e-12)
    label = F.col("fraud_label") == S.fraud_label(F.col("prediction"), exact_one=True)
    return (stream.join(batch, "transaction_id", "left")
            .select("transaction_id", "tx_amount", "account_id", "merchant_id", "timestamp",
                    F.coalesce(same, F.lit(False)).alias("equals_batch"), F.coalesce(label, F.lit(False)).alias("label_ok"),
                    "kafka_timestamp", "offset", "partition"))


_SCORED_SCHEMA = "transaction_id string, success boolean, fraud_probability double, error string, latency_ms double"


def _external(spark, sf):
    """Score each micro-batch with the injected scorer in one pass and one write: rows land in the
    ``outcome=ok`` (results) or ``outcome=error`` (side table) partition of the batch, so the external scorer is
    called once per row without persisting the batch."""
    df = _parsed_stream(spark, sf, kind="raw")
    # broken rules are found natively; the scorer sees the valid rows only, and only the columns it needs
    df = df.select("transaction_id", "customer_id", "tx_amount", "tx_time_seconds",
                   F.array_join(S.request_violations(), ",").alias("violations"))
    root, stats = scratch_path(spark, "sink-external"), scratch_path(spark, "batch-outcomes")
    write = IO.idempotent_batch_writer(root, extra_partitions=("outcome",))
    scorer = request_scorer(large=LARGE, medium=MEDIUM)

    def per_batch(batch_df, batch_id):
        scored = batch_df.mapInPandas(external_scoring(scorer), _SCORED_SCHEMA)
        # counted while the batch is written, not by reading it again
        seen = Observation(f"outcomes-{batch_id}")
        write(scored.withColumn("outcome", F.when(F.col("success"), "ok").otherwise("error")).observe(
            seen, F.count_if("success").alias("success"), F.count_if(~F.col("success")).alias("failure"),
            F.avg("latency_ms").alias("mean_latency_ms")), batch_id)
        m = seen.get
        row = [(m["success"], m["failure"], m["mean_latency_ms"])]
        (batch_df.sparkSession.createDataFrame(row, "success long, failure long, mean_latency_ms double").coalesce(1)
         .write.mode("overwrite").parquet(f"{stats}/batch_id={batch_id}"))

    IO.foreach_batch_sink(df, per_batch)
    return spark.read.parquet(root).drop("outcome"), spark.read.parquet(stats)


_REQ_P = S.request_risk_score_sql("tx_amount", "tx_time_seconds", "customer_id", large=LARGE, medium=MEDIUM)


@register("score_batch_external", f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, v = '' AS success,
       CASE WHEN v = '' THEN round(p, 6) END AS fraud_probability,
       CASE WHEN v <> '' THEN 'invalid request: ' || v END AS error
FROM (SELECT *, {S.request_violations_sql()} AS v, {_REQ_P} AS p FROM ({RAW_TX_SQL}))""")
def q_score_batch_external(spark, sf):
    r, _ = _external(spark, sf)
    return r.select("transaction_id", "success", F.round("fraud_probability", 6).alias("fraud_probability"), "error")


@register("batch_outcome_stats", f"""
SELECT CAST(count(*) FILTER (WHERE v = '') AS BIGINT) AS success, CAST(count(*) FILTER (WHERE v <> '') AS BIGINT) AS failure,
       TRUE AS timed, TRUE AS as_written
FROM (SELECT {S.request_violations_sql()} AS v FROM ({RAW_TX_SQL}))""")
def q_batch_outcome_stats(spark, sf):
    """A row a micro-batch, observed while it ran, equals what the batch's own files hold; the sums are those of the input,
    whatever the batches were."""
    rows, stats = _external(spark, sf)
    files = outcome_stats(rows).select("batch_id", F.struct("success", "failure").alias("files"))
    both = stats.join(files, "batch_id", "full")
    return both.agg(F.sum("success").alias("success"), F.sum("failure").alias("failure"),
                    F.coalesce(F.min("mean_latency_ms") >= 0, F.lit(False)).alias("timed"),
                    F.coalesce(F.every(F.struct("success", "failure").eqNullSafe(F.col("files"))), F.lit(False)).alias("as_written"))


def outcome_stats(results):
    """Per micro-batch: successes, failures and the mean latency of a row."""
    return results.groupBy("batch_id").agg(F.count_if("success").alias("success"),
                                           F.count_if(~F.col("success")).alias("failure"),
                                           F.avg("latency_ms").alias("mean_latency_ms"))


PROGRESS_FILES = 5


def _progress(spark, sf, trigger: dict):
    """Progress reports of a replay, one file a micro-batch, through a listener (no cap on their number)."""
    df = _parsed_stream(spark, sf, files_per_trigger=1, least_files=PROGRESS_FILES)
    with IO.ProgressLog(spark) as log:
        q = (df.writeStream.format("parquet").option("path", scratch_path(spark, "sink-progress"))
             .option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(**trigger).start())
        (IO.ended if "availableNow" in trigger else IO.drain)(q, None)
        return log.table(q).filter(F.col("num_input_rows") > 0)


@register("progress_table", "SELECT CAST(count(*) AS BIGINT) AS input_rows, TRUE AS several_batches, TRUE AS timed FROM events")
def q_progress_table(spark, sf):
    """All reports of a run, summed: the rows of all micro-batches are the rows of the input."""
    return _progress(spark, sf, {"availableNow": True}).agg(
        F.sum("num_input_rows").alias("input_rows"), (F.count("batch_id") > 1).alias("several_batches"),
        F.coalesce(F.min("trigger_execution_ms") >= 0, F.lit(False)).alias("timed"))


@register("throttled_trigger", "SELECT CAST(count(*) AS BIGINT) AS input_rows, TRUE AS several_batches, TRUE AS apart, "
                              "TRUE AS one_file_each FROM events")
def q_throttled_trigger(spark, sf):
    """A 2-second trigger over one file at a time reads the whole input: each micro-batch is a whole file, and they start two
    seconds apart (0.2 s less where one started late); the second one at the next even second."""
    told = _progress(spark, sf, {"processingTime": "2 seconds"})
    files = (spark.read.parquet(_records(spark, sf, least_files=PROGRESS_FILES)).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
             .groupBy("n").agg(F.count(F.lit(1)).alias("files")))
    batches = told.groupBy(F.col("num_input_rows").alias("n")).agg(F.count(F.lit(1)).alias("batches"))
    other = files.join(batches, "n", "full").filter("NOT files <=> batches").limit(1).count()
    at = F.unix_millis(F.to_timestamp("started_at"))
    # one row a micro-batch of this replay
    gaps = told.select("batch_id", "num_input_rows", (at - F.lag(at).over(Window.orderBy("batch_id"))).alias("gap"))
    return gaps.agg(F.sum("num_input_rows").alias("input_rows"), (F.count("batch_id") > 1).alias("several_batches"),
                    F.coalesce(F.min(F.when(F.col("batch_id") > 1, F.col("gap"))) >= 1800, F.lit(False)).alias("apart"), F.lit(not other).alias("one_file_each"))


def _event_slices(spark, sf) -> str:
    """The events in six files by time; one in fifty of the first half comes last, in a file of its own."""
    def build(path):
        ev = T.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
        b = ev.agg(F.min(F.unix_micros("ts")).alias("lo"), F.max(F.unix_micros("ts")).alias("hi")).collect()[0]
        late = (uniform("event_id", "late") < 0.02) & (F.unix_micros("ts") < F.lit(((b["lo"] or 0) + (b["hi"] or 0)) // 2))
        IO.time_slices(ev.filter(~late), path, "ts", least=6)
        ev.filter(late).coalesce(1).write.mode("append").parquet(path)
    return T.written(spark, sf, "event-slices", build)


@register("windowed_rates", f"""
WITH b AS (SELECT (epoch_us(min(ts)) + epoch_us(max(ts))) // 2 AS mid, epoch_us(max(ts)) // 1000 - 600000 AS closed FROM events),
w AS (SELECT epoch_us(ts) // 300000000 AS k, event_type FROM events, b
      WHERE NOT ({sql_uniform("event_id", "late")} < 0.02 AND epoch_us(ts) < mid))
SELECT make_timestamp(k * 300000000) AS window_start, make_timestamp((k + 1) * 300000000) AS window_end, event_type, count(*) AS n
FROM w, b WHERE (k + 1) * 300000 <= closed GROUP BY ALL""")
def q_windowed_rates(spark, sf):
    """Counts of five minutes as the watermark closes them; events that come after their window's end are left out."""
    schema = "event_id bigint, ts timestamp, event_type string"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(_event_slices(spark, sf))
    rates = windowed_rates(src, "ts", "5 minutes", "10 minutes", "event_type")
    at = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return _drain(rates.select(at("window_start"), at("window_end"), "event_type", "n"), "rates")


def _check_slices(spark, sf) -> str:
    def build(path):
        checks = M.threshold_alert(_gauges(spark, sf), GAUGE_LIMITS).select("metric", "sampled_at", "firing")
        IO.time_slices(checks, path, "sampled_at")
    return T.written(spark, sf, "check-slices", build)


_HOLDS = ", ".join(f"('{k}', {v[1]}, {v[2]})" for k, v in GAUGES.items())


@register("alert_events", f"""
WITH a AS (SELECT metric, sampled_at, firing FROM ({ORACLE["threshold_alert"]})),
e AS (SELECT max(sampled_at) - INTERVAL 10 MINUTE AS upto FROM a),
t AS (SELECT a.*, h.f, h.g, max(sampled_at) OVER (PARTITION BY a.metric) AS final FROM a JOIN (VALUES {_HOLDS}) h(metric, f, g) USING (metric), e
      WHERE sampled_at <= upto),
c AS (SELECT *, CASE WHEN lag(firing) OVER w IS NULL OR lag(firing) OVER w <> firing
                       OR (epoch_us(sampled_at) - lag(epoch_us(sampled_at)) OVER w) / 1e6 > g THEN 1 ELSE 0 END AS chg
      FROM t WINDOW w AS (PARTITION BY metric ORDER BY sampled_at)),
r AS (SELECT *, sum(chg) OVER (PARTITION BY metric ORDER BY sampled_at) AS run FROM c),
k AS (SELECT *, min(sampled_at) OVER (PARTITION BY metric, run) AS start,
             row_number() OVER (PARTITION BY metric, run ORDER BY sampled_at) AS nth FROM r WHERE firing)
SELECT metric, 'open' AS state, start, start AS at_time, 1::BIGINT AS checks FROM k WHERE nth = 1
UNION ALL SELECT metric, 'firing', start, min(sampled_at), min(nth) FROM k
          WHERE epoch_us(sampled_at) - epoch_us(start) >= f * 1000000::BIGINT GROUP BY metric, run, start
UNION ALL SELECT metric, 'resolved', start, max(sampled_at), count(*) FROM k, e GROUP BY metric, run, start, g, final, upto
          HAVING max(sampled_at) < final OR epoch_us(max(sampled_at)) + g * 1000000::BIGINT <= epoch_us(upto)""")
def q_alert_events(spark, sf):
    """The gauges' alerts as the stream runs: opened, firing after their hold time, resolved by a check or by silence."""
    src = (spark.readStream.schema("metric string, sampled_at timestamp_ntz, firing boolean").option("maxFilesPerTrigger", "1")
           .parquet(_check_slices(spark, sf)))
    with with_rocksdb(spark):
        out = _drain(alert_events(src, "sampled_at", "metric", {k: (float(v[1]), float(v[2])) for k, v in GAUGES.items()}), "alerts")
    return out.withColumnRenamed("at", "at_time")


@register("console_sink", f"SELECT CAST(count(*) AS BIGINT) AS shown_rows FROM ({TX_SQL})")
def q_console_sink(spark, sf):
    """The console sink prints every micro-batch; the rows it was given are counted from its progress reports."""
    with IO.ProgressLog(spark) as log:
        q = IO.console_sink(_parsed_stream(spark, sf).select("transaction_id", "tx_amount"), num_rows=1)
        return log.table(q).agg(F.sum("num_input_rows").alias("shown_rows"))


def _click_records(spark, sf):
    ev = T.table(spark, sf, "events").filter(F.col("event_type") == "click")
    page = F.get_json_object("props", "$.k").cast("long")
    value = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
                               F.col("user_id"), page.alias("page_id")))
    return ev.select(page.alias("_page"), value.alias("_value"), "event_id", F.col("ts").cast("timestamp").alias("_ts"),
                     F.pmod(page, F.lit(3)).alias("_part"))


def _clicks_dir(spark, sf):
    return T.written(spark, sf, "records-clicks", lambda path: IO.write_records(
        _click_records(spark, sf), path, "_page", "_value", "clicks", "_part", "event_id", "_ts", ROWS_PER_FILE, least_files=2))


@register("click_consumer", """
SELECT 'clicks' AS topic, CAST(CAST(props->>'k' AS BIGINT) % 3 AS INTEGER) AS "partition", event_id AS "offset",
       props->>'k' AS "key", ts, user_id, CAST(props->>'k' AS BIGINT) AS page_id
FROM events WHERE event_type = 'click'""")
def q_click_consumer(spark, sf):
    return _drain(_clicks(IO.replay_source(spark, _clicks_dir(spark, sf), FILES_PER_TRIGGER)), "clicks")


def _clicks(src):
    dec = src.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                     F.from_json(F.col("value").cast("string"), CLICK_SCHEMA).alias("c"))
    return dec.select("topic", "partition", "offset", "key",
                      F.to_timestamp("c.ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").cast("timestamp_ntz").alias("ts"),
                      "c.user_id", "c.page_id")


def _clicks_again_dir(spark, sf):
    """The clicks in slices of time; every fourth is delivered a second time three days later, every twentieth at once."""
    def build(path):
        c = _click_records(spark, sf).select(
            F.col("_page").cast("string").cast("binary").alias("key"), F.col("_value").cast("binary").alias("value"),
            F.lit("clicks").alias("topic"), F.col("_part").cast("int").alias("partition"),
            F.col("event_id").cast("long").alias("offset"), F.col("_ts").alias("timestamp"))
        again = c.filter("offset % 4 = 0").withColumn("sent", F.col("timestamp") + F.expr("INTERVAL 3 DAYS"))
        sent = c.withColumn("sent", F.col("timestamp")).unionByName(again).unionByName(
            c.filter("offset % 20 = 0").withColumn("sent", F.col("timestamp")))
        IO.time_slices(sent, path, "sent", rows_per_slice=ROWS_PER_FILE, least=6)
    return T.written(spark, sf, "records-clicks-again", build)


@register("click_consumer_once", ORACLE["click_consumer"])
def q_click_consumer_once(spark, sf):
    """A history with repeats, within files and across them, gives each click once."""
    src = IO.replay_source(spark, _clicks_again_dir(spark, sf), 1)
    with with_rocksdb(spark):
        return _drain(_clicks(read_once(src, "4 days")), "clicks-once")


@register("stream_lag", """
SELECT 'transactions-input' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", count(*) AS total, 0::BIGINT AS lag_at_end,
       TRUE AS as_in_sink, TRUE AS falls
FROM events GROUP BY ALL""")
def q_stream_lag(spark, sf):
    """The lag of a throttled replay from its own checkpoint: after every batch it is what the sink doesn't hold yet, it
    never grows, and it ends at 0."""
    records, out, ckpt = _records(spark, sf, least_files=PROGRESS_FILES), scratch_path(spark, "sink-lag"), scratch_path(spark, "ckpt")
    src = IO.replay_source(spark, records, 1).select("topic", "partition", "offset")
    IO.foreach_batch_sink(src, IO.idempotent_batch_writer(out), ckpt)
    at = stream_offsets(spark, records, ckpt).withColumn("lag", F.col("end") - F.col("committed"))
    sink = spark.read.schema("topic string, partition int, offset bigint, batch_id bigint").parquet(out)
    sink = sink.groupBy("topic", "partition", "batch_id").agg(F.count(F.lit(1)).alias("written"))
    by = Window.partitionBy("topic", "partition").orderBy("batch_id")     # one row a batch and partition
    both = at.join(sink, ["topic", "partition", "batch_id"], "left").withColumn(
        "in_sink", F.sum(F.coalesce("written", F.lit(0))).over(by)).withColumn("before", F.lag("lag").over(by))
    return both.groupBy("topic", "partition").agg(
        F.max("end").alias("total"), F.max_by("lag", "batch_id").alias("lag_at_end"),
        F.every(F.col("lag") == F.col("end") - F.col("in_sink")).alias("as_in_sink"),
        (F.every(F.coalesce(F.col("lag") <= F.col("before"), F.lit(True))) & (F.count(F.lit(1)) > 1)).alias("falls"))
