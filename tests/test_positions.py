"""Lag of a stream from its own checkpoint; an at-least-once topic read once."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators.monitoring import consumer_lag
from ledgerlens.session import scratch_path
from ledgerlens.streaming import io as IO
from ledgerlens.streaming.positions import read_once, stream_offsets

RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def _records(spark, path, rows):
    """One file of (partition, offset, hour) records."""
    data = [(b"k", b"v", "t", p, o, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for p, o, h in rows]
    spark.createDataFrame(data, RECORD).coalesce(1).write.mode("append").parquet(path)


def test_lag_counts_files_that_came_after_the_run(spark):
    path, ckpt = scratch_path(spark, "rec"), scratch_path(spark, "ckpt")
    _records(spark, path, [(0, 1, 0), (0, 2, 0), (1, 1, 0)])
    _records(spark, path, [(0, 3, 1)])
    run = lambda: IO.foreach_batch_sink(IO.replay_source(spark, path, 1), lambda df, i: None, ckpt)
    run()
    at = sorted((r.batch_id, r.partition, r.committed, r.end) for r in stream_offsets(spark, path, ckpt).collect())
    assert at == [(0, 0, 2, 3), (0, 1, 1, 1), (1, 0, 3, 3), (1, 1, 1, 1)]
    _records(spark, path, [(1, 2, 2), (1, 3, 2), (2, 1, 2)])
    behind = consumer_lag(stream_offsets(spark, path, ckpt)).first()
    assert (behind.total_lag, behind.total_end) == (3, 7)
    run()
    assert consumer_lag(stream_offsets(spark, path, ckpt)).first().total_lag == 0
    assert stream_offsets(spark, path, ckpt).filter("batch_id = 2").count() == 3


def test_lag_after_the_source_log_was_compacted(spark):
    path, ckpt = scratch_path(spark, "rec"), scratch_path(spark, "ckpt")
    for k in range(23):   # the engine compacts its file log every ten batches
        _records(spark, path, [(0, k, 0)])
    IO.foreach_batch_sink(IO.replay_source(spark, path, 1), lambda df, i: None, ckpt)
    at = stream_offsets(spark, path, ckpt).orderBy("batch_id").collect()
    assert [(r.batch_id, r.committed, r.end) for r in at] == [(k, k + 1, 23) for k in range(23)]


def test_each_record_once_across_files_batches_and_restarts(spark):
    path, ckpt, out = scratch_path(spark, "rec"), scratch_path(spark, "ckpt"), scratch_path(spark, "out")
    once = lambda: IO.run_to_parquet(read_once(IO.replay_source(spark, path, 1), "6 hours").select(
        "partition", "offset"), out, ckpt)
    _records(spark, path, [(0, 1, 0), (0, 1, 0), (1, 1, 0)])         # repeat in one file, one offset in two partitions
    _records(spark, path, [(0, 1, 0), (0, 2, 3)])                    # repeat in the next batch
    once()
    _records(spark, path, [(0, 2, 3), (0, 3, 20)])                   # repeat after a restart
    _records(spark, path, [(0, 1, 0), (0, 4, 21)])                   # repeat behind the watermark
    once()
    got = spark.read.parquet(out).groupBy("partition", "offset").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted((r.partition, r.offset, r.n) for r in got) == [(0, 1, 1), (0, 2, 1), (0, 3, 1), (0, 4, 1), (1, 1, 1)]
