"""Alerts on a stream against the table query: one replay, a replay stopped and started again, late and repeated checks."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.monitoring import sustained_alert
from ledgerlens.session import scratch_path
from ledgerlens.streaming import io as IO
from ledgerlens.streaming.alerts import alert_events, with_rocksdb

HOLDS = {"a": (120.0, 300.0), "b": (600.0, 120.0), "c": (0.0, 90.0)}
SCHEMA = "metric string, ts timestamp_ntz, firing boolean"


def checks(seed=1):
    r, rows = random.Random(seed), []
    for key in HOLDS:
        t = 0
        for _ in range(80):
            t += r.choice([60, 60, 60, 90, 200, 900])
            rows.append((key, t, r.random() < 0.7))
    return sorted(rows, key=lambda x: x[1])


def write(spark, rows, path, name):
    df = spark.createDataFrame(rows, "metric string, s long, firing boolean").select(
        "metric", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "firing")
    df.coalesce(1).write.mode("append").parquet(path)


def replay(spark, path, out, ckpt):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)
    with with_rocksdb(spark):
        IO.run_to_parquet(alert_events(src, "ts", "metric", HOLDS, "10 minutes"), out, checkpoint=ckpt)
    got = spark.read.parquet(out).collect()
    secs = lambda x: int((x - __import__("datetime").datetime(1970, 1, 1)).total_seconds())
    return sorted((r.metric, secs(r.start), secs(r["at"]), r.state, r.checks) for r in got)


def table(rows, upto):
    """The events of the checks up to the watermark, by a loop over them."""
    out = []
    for key, (hold, pause) in HOLDS.items():
        run = None
        for _, t, firing in sorted(x for x in rows if x[0] == key and x[1] <= upto):
            if run and (not firing or t - run[1] > pause):
                out.append((key, run[0], run[1], "resolved", run[2]))
                run = None
            if firing:
                if not run:
                    run = [t, t, 0, False]
                    out.append((key, t, t, "open", 1))
                run[1], run[2] = t, run[2] + 1
                if not run[3] and t - run[0] >= hold:
                    run[3] = True
                    out.append((key, run[0], t, "firing", run[2]))
        if run and run[1] + pause <= upto:
            out.append((key, run[0], run[1], "resolved", run[2]))
    return sorted(out)


def test_replay_equals_table_also_after_a_restart(spark):
    rows = checks()
    # every slice but the last has some checks that belong to the one before, within the watermark's delay
    n = len(rows) // 4
    slices = [rows[k * n:(k + 1) * n] for k in range(3)] + [rows[3 * n:]]
    for k in range(1, 4):
        border = slices[k - 1][-1][1]
        late = [x for x in slices[k - 1] if border - x[1] < 300][::2]
        slices[k - 1] = [x for x in slices[k - 1] if x not in late]
        slices[k] = late + slices[k]
    want = table(rows, rows[-1][1] - 600)
    assert {"open", "firing", "resolved"} == {x[3] for x in want} and len(want) > 40
    whole, halves = scratch_path(spark, "checks"), scratch_path(spark, "checks")
    for s in slices:
        write(spark, s, whole, "x")
    assert replay(spark, whole, scratch_path(spark, "out"), scratch_path(spark, "ckpt")) == want
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    for s in slices[:2]:
        write(spark, s, halves, "x")
    first = replay(spark, halves, out, ckpt)
    assert 0 < len(first) < len(want)
    for s in slices[2:]:
        write(spark, s, halves, "x")
    assert replay(spark, halves, out, ckpt) == want


def test_runs_are_those_of_the_table_query(spark):
    rows = checks(2)
    df = spark.createDataFrame(rows, "metric string, s long, firing boolean").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    upto = rows[-1][1] - 600
    runs = sustained_alert(df.filter(F.col("s") <= upto), "ts", "metric", {k: h[0] for k, h in HOLDS.items()},
                           {k: h[1] for k, h in HOLDS.items()})
    secs = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    got = {(r.metric, r.s, r.e, r.checks): r.fired for r in runs.select("metric", secs("start").alias("s"), secs("end").alias("e"), "checks", "fired").collect()}
    events = table(rows, upto)
    fired = {(k, s) for k, s, _, state, _ in events if state == "firing"}
    closed = {(k, s, e, n): (k, s) in fired for k, s, e, state, n in events if state == "resolved"}
    assert closed and all(got[x] == f for x, f in closed.items())
    assert len(got) - len(closed) == sum(x[3] == "open" for x in events) - len(closed) <= len(HOLDS)
