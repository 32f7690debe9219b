"""Streams: file-source replay equals the batch answer; empty micro-batches and broken JSON are handled."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path
from ledgerlens.streaming import io as IO
from ledgerlens.streaming.jobs import to_envelope, unwrap_envelope, well_formed
from ledgerlens.streaming.udfs import external_scoring
from ledgerlens.schemas import KAFKA_RECORD_SCHEMA
from tests.conftest import SF_SMALL


def test_broken_json_goes_to_the_dead_letters(spark):
    df = spark.createDataFrame([('{"transaction_id":"tx_1","data":{"transaction_id":1,"tx_amount":5.0}}', 1),
                                ("{not json", 2), ('{"transaction_id":"2"}', 3), (None, 4)], "value string, offset int")
    out = unwrap_envelope(df)
    assert [(r.transaction_id, r.tx_amount, r.offset) for r in well_formed(out).collect()] == [("1", 5.0, 1)]
    left = out.filter("parse_error IS NOT NULL").orderBy("offset").collect()
    assert [(r.raw_value, r.parse_error) for r in left] == [
        ("{not json", "not an envelope with data"), ('{"transaction_id":"2"}', "not an envelope with data"), (None, "no value")]


def test_a_drain_with_a_limit_raises_instead_of_returning_a_part(spark):
    path = scratch_path(spark, "slow-records")
    for k in range(6):
        spark.range(k * 10, k * 10 + 10).write.mode("append").parquet(path)
    src = spark.readStream.schema("id long").option("maxFilesPerTrigger", "1").parquet(path)
    slow = src.select(F.expr("reflect('java.lang.Thread', 'activeCount')").alias("n"), "id")
    with pytest.raises(IO.InputRemains):
        IO.run_to_parquet(slow, scratch_path(spark, "slow-sink"), timeout_s=0.05)
    out = scratch_path(spark, "slow-sink")
    q = (src.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "ckpt"))
         .trigger(processingTime="0 seconds").start())
    with pytest.raises(IO.InputRemains):
        IO.drain(q, timeout_s=0.05)
    IO.run_to_parquet(src, out := scratch_path(spark, "slow-sink"))
    assert spark.read.parquet(out).count() == 60


def test_progress_of_more_than_100_batches(spark):
    path = scratch_path(spark, "many-files")
    spark.range(105).repartition(105, "id").write.parquet(path)
    files = len([f for f in spark.read.parquet(path).inputFiles()])
    src = spark.readStream.schema("id long").option("maxFilesPerTrigger", "1").parquet(path)
    spark.range(0).write.parquet(sink := scratch_path(spark, "none"))
    with IO.ProgressLog(spark) as log:
        q = IO.foreach_batch_sink(src, lambda df, i: None)
        rows = log.table(q).filter("num_input_rows > 0 OR batch_id >= 0").select("batch_id").distinct().count()
    assert files > 50 and rows >= files and sink


def test_retry_with_another_outcome_replaces_the_batch(spark):
    out = scratch_path(spark, "retry")
    w = IO.idempotent_batch_writer(out, extra_partitions=("outcome",))
    w(spark.createDataFrame([(1, "error")], "id int, outcome string"), 0)
    w(spark.createDataFrame([(1, "ok")], "id int, outcome string"), 0)
    assert [(r.id, r.outcome, r.batch_id) for r in spark.read.parquet(out).collect()] == [(1, "ok", 0)]


def test_scorer_errors_are_per_row(spark):
    df = spark.createDataFrame([("a", 1.0, ""), ("b", -1.0, ""), (None, 2.0, ""), ("d", 3.0, "tx_amount:gt_0")],
                               "transaction_id string, tx_amount double, violations string")

    def scorer(pdf):
        if (pdf["tx_amount"] < 0).any():
            raise ValueError("negative")
        return pdf["tx_amount"] / 10

    ddl = "transaction_id string, success boolean, fraud_probability double, error string, latency_ms double"
    got = df.coalesce(1).mapInPandas(external_scoring(scorer), ddl).collect()
    assert [(r.transaction_id, r.success, r.fraud_probability, r.error) for r in got] == [
        ("a", True, 0.1, None), ("b", False, None, "scorer error: negative"), (None, True, 0.2, None),
        ("d", False, None, "invalid request: tx_amount:gt_0")]


def test_envelope_and_kafka_rows(spark):
    df = spark.createDataFrame([(7, None, 2.5)], "transaction_id long, tx_datetime string, tx_amount double")
    at = F.lit("2024-05-01 10:00:00").cast("timestamp_ntz")
    js = json.loads(df.select(to_envelope(df, at).alias("v")).collect()[0].v)
    assert js == {"transaction_id": "tx_1714557600000000_7", "stream_timestamp": "2024-05-01T10:00:00.000000",
                  "producer_id": "replay", "producer_config": {"tps_target": 50, "topic": "transactions-input"},
                  "data": {"transaction_id": 7, "tx_amount": 2.5}}
    row = IO.kafka_rows(df).collect()[0]
    assert row.key == "7" and json.loads(row.value) == {"transaction_id": 7, "tx_amount": 2.5}


def test_empty_stream_and_console(spark):
    path = scratch_path(spark, "empty-records")
    spark.createDataFrame([], KAFKA_RECORD_SCHEMA).write.parquet(path)
    src = IO.replay_source(spark, path)
    sink = scratch_path(spark, "empty-sink")
    IO.run_to_parquet(src.select(F.col("value").cast("string").alias("v")), sink)
    q = IO.console_sink(src.select("offset"))
    assert not q.isActive


def test_idempotent_batch_writer(spark):
    out = scratch_path(spark, "idem")
    w = IO.idempotent_batch_writer(out)
    df = spark.range(5)
    w(df, 0)
    w(df, 0)           # retried batch replaces its own partition
    w(df, 1)
    assert spark.read.parquet(out).count() == 10


def test_windowed_rates_stream_matches_batch_for_closed_windows(spark):
    from datetime import datetime, timedelta
    from ledgerlens.streaming.jobs import windowed_rates
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(seconds=37 * i), "FRAUD" if i % 5 == 0 else "NORMAL") for i in range(400)]
    src_dir = scratch_path(spark, "win-src")
    import time
    for k in range(4):   # time slices written one after another, so file modification order is time order
        part = rows[k * 100:(k + 1) * 100]
        spark.createDataFrame(part, "ts timestamp, fraud_label string").coalesce(1).write.mode("append").parquet(src_dir)
        time.sleep(1.1)
    stream = spark.readStream.schema("ts timestamp, fraud_label string").option("maxFilesPerTrigger", "1").parquet(src_dir)
    out = scratch_path(spark, "win-out")
    IO.run_to_parquet(windowed_rates(stream, "ts", "5 minutes", "0 seconds", "fraud_label"), out)
    got = {(r.window_start, r.fraud_label): r.n for r in spark.read.parquet(out).collect()}
    batch = windowed_rates(spark.read.parquet(src_dir), "ts", "5 minutes", "0 seconds", "fraud_label")
    want = {(r.window_start, r.fraud_label): r.n for r in batch.collect()}
    assert got and all(want[k] == v for k, v in got.items())     # every emitted (closed) window is complete


def test_slices_come_in_order_and_late_rows_are_counted(spark):
    """Windows that the watermark closed equal the batch answer, and the events left out are told by the progress reports."""
    from pyspark.sql import functions as F
    from ledgerlens.plans import streams as S
    from ledgerlens.streaming import io as IO
    from ledgerlens.streaming.jobs import windowed_rates
    path = S._event_slices(spark, SF_SMALL)
    src = spark.readStream.schema("event_id bigint, ts timestamp, event_type string").option("maxFilesPerTrigger", "1").parquet(path)
    out = scratch_path(spark, "rates")
    with IO.ProgressLog(spark) as log:
        told = log.table(IO.run_to_parquet(windowed_rates(src, "ts", "5 minutes", "10 minutes"), out))
        dropped = told.agg(F.sum("rows_dropped_by_watermark").alias("n"), F.sum("num_input_rows").alias("rows")).collect()[0]
    assert dropped["rows"] == spark.read.parquet(path).count() and dropped["n"] > 0
    files = spark.read.parquet(path).withColumn("f", F.input_file_name()).groupBy("f").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()
    spans = sorted((r.lo, r.hi) for r in files)
    assert sum(a[1] > b[0] for a, b in zip(spans, spans[1:])) <= 5      # the late file alone reaches into others


def test_progress_rows_beyond_those_held(spark, monkeypatch):
    from ledgerlens.plans import streams as S
    from ledgerlens.streaming import io as IO
    monkeypatch.setattr(IO.ProgressLog, "HELD", 2)
    with IO.ProgressLog(spark) as log:
        q = IO.run_to_parquet(S._parsed_stream(spark, SF_SMALL, files_per_trigger=1, least_files=5).select("offset"), scratch_path(spark, "held"))
        told = log.table(q).filter("num_input_rows > 0")
    assert told.count() == 5 and log.rows == [] and log.files >= 2
    assert sorted(r.batch_id for r in told.collect()) == [0, 1, 2, 3, 4]


def _hours(spark, rows):
    """(id, ts): ``rows`` rows an hour apart, and one without a time."""
    return spark.range(rows).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("ts")).union(
        spark.sql("SELECT 1000000L, CAST(NULL AS timestamp)"))


def test_slices_take_a_few_passes_whatever_their_number(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    path = scratch_path(spark, "slices")
    IO.time_slices(_hours(spark, 100).mapInArrow(counted, "id long, ts timestamp"), path, "ts", rows_per_slice=5)
    assert seen.value <= 3 * 101
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("ts").alias("n"),
        F.max("_metadata.file_modification_time").alias("at")).orderBy("at").collect()
    assert [r.lo for r in files] == sorted(r.lo for r in files) and all(a.hi < b.lo for a, b in zip(files, files[1:]))
    assert sum(r.n for r in files) == 100 and len(files) == 21


def test_a_long_history_has_larger_files_not_more(spark):
    path = scratch_path(spark, "slices")
    IO.time_slices(_hours(spark, 100), path, "ts", rows_per_slice=1)
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() <= IO.MOST_FILES
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(100))
    assert [IO.history_files(n, 12_500, 2) for n in (0, 100, 100_000, 6_000_000, 36_000_000)] == [2, 2, 8, 24, 72]


def test_records_of_a_long_history_come_in_few_micro_batches(spark):
    path = scratch_path(spark, "records")
    rows = spark.range(60).select("id", F.lit("v").alias("v"), F.lit(0).alias("p"), F.timestamp_seconds("id").alias("ts"))
    IO.write_records(rows, path, "id", "v", "t", "p", "id", "ts", rows_per_file=1)
    with IO.ProgressLog(spark) as log:
        q = IO.console_sink(IO.replay_source(spark, path, 2).select("offset"), num_rows=1)
        told = log.table(q).filter("num_input_rows > 0").agg(F.count("batch_id").alias("batches"), F.sum("num_input_rows").alias("rows")).first()
    assert told.batches <= IO.MOST_FILES // 2 and told.rows == 60


def test_a_record_is_parsed_once(spark):
    df = spark.createDataFrame([('{"data":{"transaction_id":1,"tx_amount":5.0}}',), ("{",), (None,)], "value string")
    out = well_formed(unwrap_envelope(df)).select("transaction_id", "tx_amount")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1, plan
    assert [tuple(r) for r in out.collect()] == [("1", 5.0)]


def test_a_record_file_is_read_by_several_tasks(spark):
    import glob

    import pyarrow.parquet as pq
    path = scratch_path(spark, "row-groups")
    text = F.concat(*[F.sha2(F.concat_ws(":", "id", F.lit(k)), 256) for k in range(6)])
    rows = spark.range(0, 30_000, 1, 2).select("id", F.lit(0).alias("p"), F.timestamp_seconds("id").alias("ts"))
    IO.write_records(rows, path, "id", text, "t", "p", "id", "ts")
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*.parquet")]
    assert len(files) == 1 and files[0].num_row_groups >= 3, files
    got = spark.read.parquet(path)
    assert got.schema.simpleString() == KAFKA_RECORD_SCHEMA.simpleString() and got.count() == 30_000
    want = rows.select(F.col("id").cast("string").cast("binary").alias("key"), text.cast("binary").alias("value"))
    assert got.select("key", "value").exceptAll(want).isEmpty()


def test_a_long_history_is_dealt_by_time_before_its_values_are_made(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def value(i):
        seen.add(1)
        return f"v{i}"

    rows = spark.range(100).select("id", F.lit(0).alias("p"), F.timestamp_seconds("id").alias("ts"))
    IO.write_records(rows, path := scratch_path(spark, "made-once"), "id", value("id"), "t", "p", "id", "ts", rows_per_file=25)
    assert seen.value == 100
    got = spark.read.parquet(path).orderBy("offset").select(F.col("value").cast("string").alias("v"), "offset").collect()
    assert [(r.v, r.offset) for r in got] == [(f"v{i}", i) for i in range(100)]
