"""Where a stream stands in its topic, and reading an at-least-once topic exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _file(path) -> F.Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def stream_offsets(spark: SparkSession, records: str, checkpoint: str) -> DataFrame:
    """Committed and available positions of a stream over record files, from its checkpoint: (batch_id, topic, partition,
    committed, end, sampled_at), one row a committed batch and partition, in the form ``consumer_lag`` takes.

    ``committed`` counts the records of the files the batches up to this one read, ``end`` those in the folder now, and
    ``sampled_at`` is when the batch was committed.  Batches whose log entries the engine has cleaned up have no row; their
    files still count for the later ones."""
    def log(name: str) -> DataFrame:
        return spark.read.text(f"{checkpoint}/{name}")

    read = log("sources/0").select(F.from_json("value", "path string, batchId bigint").alias("f")).filter("f.path IS NOT NULL")
    read = read.select(_file(F.col("f.path")).alias("file"), F.col("f.batchId").alias("log_batch")).distinct()
    ends = log("offsets").select(F.col("_metadata.file_name").cast("bigint").alias("batch_id"),
                                 F.get_json_object("value", "$.logOffset").cast("bigint").alias("log_batch"))
    done = log("commits").select(F.col("_metadata.file_name").cast("bigint").alias("batch_id"),
                                 F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("sampled_at")).distinct()
    batches = ends.filter("log_batch IS NOT NULL").join(done, "batch_id")

    held = (spark.read.parquet(records).groupBy(_file(F.col("_metadata.file_path")).alias("file"), "topic", "partition")
            .agg(F.count(F.lit(1)).alias("n")))
    total = held.groupBy("topic", "partition").agg(F.sum("n").alias("end"))
    taken = held.join(read, "file").groupBy("topic", "partition", "log_batch").agg(F.sum("n").alias("n"))
    # every partition at every position, also where a batch had none of its records: batches x partitions rows
    last = read.agg(F.coalesce(F.max("log_batch"), F.lit(-1)).alias("last")).scalar()
    grid = total.withColumn("log_batch", F.explode(F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last))))
    so_far = Window.partitionBy("topic", "partition").orderBy("log_batch").rowsBetween(Window.unboundedPreceding, 0)
    at = grid.join(taken, ["topic", "partition", "log_batch"], "left").withColumn(
        "committed", F.sum(F.coalesce("n", F.lit(0))).over(so_far))
    return at.join(batches, "log_batch").select("batch_id", "topic", "partition", "committed", "end", "sampled_at")


def read_once(records: DataFrame, delay: str, ts: str = "timestamp") -> DataFrame:
    """Each record of an at-least-once topic once, by (topic, partition, offset).  A record is remembered until the
    watermark (the latest time seen less ``delay``) has passed its time, so state follows ``delay`` and not the history;
    a repeat that comes later than that is late and left out as such.  So is a first delivery more than ``delay`` late:
    choose ``delay`` above the longest hold-up, and watch ``rows_dropped_by_watermark`` in the progress."""
    return records.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])
