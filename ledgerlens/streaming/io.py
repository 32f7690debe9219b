"""Stream sources and sinks: Kafka, file-backed replay with Kafka's record columns, foreachBatch, console,
and helpers to run a query bounded in time and read its progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerlens.schemas import KAFKA_RECORD_SCHEMA
from ledgerlens.session import scratch_path


# ---- Kafka (needs the spark-sql-kafka connector on the classpath; not exercised in the local tests) ------------

def kafka_source(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Records of a topic.  Lost offsets are an error unless the caller says otherwise; no rate limit by default."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
         .option("startingOffsets", starting_offsets).option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def kafka_rows(df: DataFrame, key_col: str | None = "transaction_id") -> DataFrame:
    """key and to_json(struct(*)) as value: the rows a Kafka topic takes."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.col(key_col).cast("string").alias("key"), value) if key_col else df.select(value)


def kafka_batch_writer(servers: str, topic: str, key_col: str | None = "transaction_id"):
    """foreachBatch function that sends each micro-batch to a topic with the batch writer (at least once: a batch that
    is retried is sent again)."""
    def write(batch_df: DataFrame, batch_id: int):
        (kafka_rows(batch_df, key_col).write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
    return write


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, key_col: str = "transaction_id",
               trigger_seconds: int = 2, query_name: str | None = None) -> StreamingQuery:
    """key + to_json(struct(*)) as value; append mode, checkpointed offsets, processing-time trigger."""
    w = (kafka_rows(df, key_col).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(processingTime=f"{trigger_seconds} seconds"))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


# ---- file-backed replay ------------------------------------------------------------------------------------------

MOST_FILES = 24              # of a stored history, until its files have
MOST_ROWS = 500_000          # rows each
RECORD_ROW_GROUP = 2 << 20   # bytes as the writer holds them, pages compressed; a file of a history is read by several tasks


def history_files(rows: int, rows_per_file: int, least_files: int = 1) -> int:
    """Number of files of a stored history.  A trigger reads whole files and every micro-batch costs the same on top of its
    rows, so a longer history is kept in larger files, not in more of them: ``rows_per_file`` rows each up to
    ``MOST_FILES`` files, then that many files until they have ``MOST_ROWS`` rows; from there on their number grows."""
    rows_per_file = max(rows_per_file, min(-(-rows // MOST_FILES), MOST_ROWS))
    return max(least_files, -(-rows // rows_per_file), 1)


def write_records(df: DataFrame, path: str, key: str, value: Column | str, topic: str, partition: str, offset: str, ts: str,
                  rows_per_file: int = 1_000_000, least_files: int = 1) -> str:
    """Store rows as Kafka-shaped records (key, value, topic, partition, offset, timestamp), range-partitioned by
    time into files of about ``rows_per_file`` rows (more in a long history, see ``history_files``), so a file stream
    replays history in time slices.  A ``value`` given as an expression is made when the files are written: the rows are
    dealt to them by time without it."""
    at, no = F.col(ts).cast("timestamp"), F.col(offset).cast("long")
    n_files = history_files(df.count(), rows_per_file, least_files)
    dealt = df.repartitionByRange(n_files, at, no).sortWithinPartitions(at, no)
    rec = dealt.select(F.col(key).cast("string").cast("binary").alias("key"),
                       (F.col(value) if isinstance(value, str) else value).cast("string").cast("binary").alias("value"),
                       F.lit(topic).alias("topic"), F.col(partition).cast("int").alias("partition"),
                       no.alias("offset"), at.alias("timestamp"))
    rec.write.mode("overwrite").option("parquet.block.size", RECORD_ROW_GROUP).parquet(path)
    return path


def replay_source(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Replay stored records as a rate-limited stream (files per trigger plays the role of max offsets)."""
    return (spark.readStream.schema(KAFKA_RECORD_SCHEMA).option("maxFilesPerTrigger", str(max_files_per_trigger))
            .parquet(path))


# ---- sinks, drains and bounded runs ---------------------------------------------------------------------------

class InputRemains(RuntimeError):
    """A drain was given a time limit and input was left when it was over."""


def drain(q: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait until the query has processed all available input; no limit by default.

    An ``availableNow`` query ends by itself; any other is stopped once it has caught up.  With a limit, a query that
    is not through by then is stopped and InputRemains raised: a drain never passes off a part as the whole."""
    import threading
    import time
    end = None if timeout_s is None else time.monotonic() + timeout_s
    done = threading.Event()
    error: list[BaseException] = []

    def work():
        try:
            q.processAllAvailable()
        except BaseException as e:  # noqa: BLE001  handed to the caller below
            error.append(e)
        done.set()

    t = threading.Thread(target=work, daemon=True)
    t.start()
    over = not done.wait(None if end is None else max(0.0, end - time.monotonic()))
    if over:
        q.stop()
        raise InputRemains(f"input was left after {timeout_s} s; the sink holds a part of it only")
    if q.exception() is not None:
        raise q.exception()
    if error and q.isActive:
        raise error[0]
    if q.isActive:
        q.stop()
    return q


def bounded_run(q: StreamingQuery, timeout_s: float = 120.0, grace_s: float = 30.0) -> StreamingQuery:
    """Run a query for ``timeout_s`` seconds and stop it.  The early stop is the feature here: the sink then holds the
    micro-batches done so far.  The one in flight gets ``grace_s`` more to end, then it is cut off and the next run from
    the checkpoint does it again.  To process everything use :func:`drain`."""
    import time
    if not q.awaitTermination(timeout_s):
        end = time.monotonic() + grace_s
        while q.isActive and q.status["isTriggerActive"] and time.monotonic() < end:
            time.sleep(0.02)
        if q.isActive:
            q.stop()
    return q


def run_to_parquet(df: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True,
                   processing_time: str | None = None, timeout_s: float | None = None, query_name: str | None = None
                   ) -> StreamingQuery:
    """Append a stream to Parquet with a checkpoint in the shared folder; ``availableNow`` drains what is there
    (respecting the source's per-trigger limit) and stops."""
    ckpt = checkpoint or scratch_path(df.sparkSession, "ckpt")
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "2 seconds")
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    return ended(q, timeout_s) if available_now else q


def ended(q: StreamingQuery, timeout_s: float | None) -> StreamingQuery:
    """Wait for the end of an ``availableNow`` query; with a limit, InputRemains if it is not through by then."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise InputRemains(f"input was left after {timeout_s} s; the sink holds a part of it only")
    return q


def foreach_batch_sink(df: DataFrame, fn, checkpoint: str | None = None, timeout_s: float | None = None,
                       available_now: bool = True, processing_time: str = "10 seconds") -> StreamingQuery:
    ckpt = checkpoint or scratch_path(df.sparkSession, "ckpt")
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    return ended(q, timeout_s) if available_now else q


def idempotent_batch_writer(path: str, partition_col: str = "batch_id", extra_partitions: tuple = ()):
    """Writes each micro-batch to its own folder ``path/batch_id=N`` (split further by ``extra_partitions`` columns
    below it), overwriting that folder as a whole: a retried batch replaces all its own output, whatever partitions
    the first try had."""

    def write(batch_df: DataFrame, batch_id: int):
        w = batch_df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if extra_partitions:
            w = w.partitionBy(*extra_partitions)
        w.parquet(f"{path}/{partition_col}={batch_id}")

    return write


def console_sink(df: DataFrame, truncate: bool = False, num_rows: int = 20, checkpoint: str | None = None,
                 available_now: bool = True, timeout_s: float | None = None) -> StreamingQuery:
    """Debug output of each micro-batch to stdout."""
    ckpt = checkpoint or scratch_path(df.sparkSession, "ckpt-console")
    w = (df.writeStream.format("console").option("truncate", str(truncate).lower()).option("numRows", str(num_rows))
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="2 seconds")
    q = w.start()
    return ended(q, timeout_s) if available_now else q


def time_slices(df: DataFrame, path: str, ts: str, rows_per_slice: int = 1_000_000, least: int = 4) -> str:
    """Write ``df`` as files of consecutive time ranges, one after the other, so a file stream reads them in order of time.

    One pass deals the rows to the slices, then each file is written from its own slice alone; a long history has larger
    slices, not more of them (``history_files``)."""
    spark = df.sparkSession
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    b = df.agg(F.min(us).alias("lo"), F.max(us).alias("hi"), F.count(F.lit(1)).alias("n")).collect()[0]
    n = history_files(b["n"], rows_per_slice, least)
    width = max(1, -(-((b["hi"] or 0) - (b["lo"] or 0) + 1) // n))
    dealt = scratch_path(spark, "dealt")
    at = F.floor((us - F.lit(b["lo"] or 0)) / F.lit(width)).cast("int")
    (df.select("*", at.alias("_slice")).filter("_slice IS NOT NULL").repartition(n, "_slice")
     .write.partitionBy("_slice").parquet(dealt))
    rows = spark.read.schema(StructType([*df.schema.fields, StructField("_slice", IntegerType())])).parquet(dealt)
    for k in range(n):
        (rows.filter(F.col("_slice") == k).drop("_slice").coalesce(1)
         .write.mode("append").option("parquet.block.size", RECORD_ROW_GROUP).parquet(path))
    return path


_PROGRESS = ("run_id string, batch_id long, started_at string, num_input_rows long, input_rows_per_second double, "
             "processed_rows_per_second double, trigger_execution_ms long, rows_dropped_by_watermark long")


class ProgressLog(StreamingQueryListener):
    """Keeps every progress report of the queries started while it is registered, as rows in the shared folder: at most
    ``HELD`` of them wait on the driver (the engine's own ``recentProgress`` keeps the last 100 only)."""

    HELD = 100

    def __init__(self, spark: SparkSession):
        import threading
        self.spark, self.rows, self.ended = spark, [], set()
        self.path, self.files, self.lock = scratch_path(spark, "progress"), 0, threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        dropped = sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators)
        row = (str(p.runId), int(p.batchId), str(p.timestamp), int(p.numInputRows), float(p.inputRowsPerSecond or 0.0),
               float(p.processedRowsPerSecond or 0.0), int((p.durationMs or {}).get("triggerExecution", 0)), dropped)
        with self.lock:
            self.rows.append(row)
            if len(self.rows) >= self.HELD:
                self._flush()

    def _flush(self) -> None:
        if self.rows:
            self.spark.createDataFrame(self.rows, _PROGRESS).coalesce(1).write.parquet(f"{self.path}/part={self.files}")
            self.rows, self.files = [], self.files + 1

    def onQueryTerminated(self, event):
        self.ended.add(str(event.runId))

    def table(self, q: StreamingQuery, wait_s: float = 60.0) -> DataFrame:
        """The reports of an ended query as rows; events arrive behind it, so wait for its end to be told."""
        import time
        end = time.monotonic() + wait_s
        while str(q.runId) not in self.ended:
            if time.monotonic() > end:
                raise TimeoutError("the end of the query was not reported")
            time.sleep(0.05)
        with self.lock:
            self._flush()
        if not self.files:
            return self.spark.createDataFrame([], _PROGRESS).drop("run_id")
        return self.spark.read.schema(_PROGRESS).parquet(self.path).filter(F.col("run_id") == str(q.runId)).drop("run_id", "part")
