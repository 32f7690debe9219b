"""Alerts while the stream runs: each series' run of firing checks as keyed state with event-time timers.

Checks wait in the state until the watermark has passed them and are then taken in order of time, so late ones (within the
watermark's delay) change nothing in the result, whatever batches they came in.  A run opens with its first firing check,
fires once it has held for its time, and is resolved by a check that doesn't fire or, by a timer, when no check came for
longer than the pause allowed.  The state of a series is its open run and the checks of the watermark's delay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_EVENTS = "key string, state string, start_us long, at_us long, checks long"


class AlertRuns(StatefulProcessor):
    """``holds``: key -> (seconds a run must last to fire, longest pause between its checks); other keys use ``default``."""

    def __init__(self, holds: dict[str, tuple[float, float]], default: tuple[float, float]):
        self.holds, self.default = holds, default

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, firing boolean")
        self.run = handle.getValueState("run", "start long, last long, checks long, fired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(u), bool(f)) for part in rows for u, f in zip(part["us"], part["firing"])]
        self.waiting.appendList(new)
        self._wake(min(u for u, _ in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        events = self._advance(key[0], now)
        if events:
            yield pd.DataFrame(events, columns=["key", "state", "start_us", "at_us", "checks"])

    def close(self) -> None:
        pass

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def _advance(self, key: str, now: int) -> list[tuple]:
        """Take all checks up to ``now``; what happens on the way."""
        hold, pause = (round(x * 1e6) for x in self.holds.get(key, self.default))
        held = list(self.waiting.get())
        ready, later = sorted(tuple(x) for x in held if x[0] <= now), [tuple(x) for x in held if x[0] > now]
        run = tuple(self.run.get()) if self.run.exists() else None
        events = []
        for us, firing in ready:
            if run and (not firing or us - run[1] > pause):
                events.append((key, "resolved", run[0], run[1], run[2]))
                run = None
            if not firing:
                continue
            if run is None:
                run = (us, us, 0, False)
                events.append((key, "open", us, us, 1))
            run = (run[0], us, run[2] + 1, run[3])
            if not run[3] and us - run[0] >= hold:
                run = (*run[:3], True)
                events.append((key, "firing", run[0], us, run[2]))
        if run and run[1] + pause <= now:
            events.append((key, "resolved", run[0], run[1], run[2]))
            run = None
        if run:
            self.run.update(run)
            self._wake(run[1] + pause)
        else:
            self.run.clear()
        if later:
            self.waiting.put(later)
            self._wake(min(u for u, _ in later))
        else:
            self.waiting.clear()
        return events


def alert_events(checks: DataFrame, ts: str, key: str, holds: dict[str, tuple[float, float]], watermark: str = "10 minutes",
                 default: tuple[float, float] = (120.0, 300.0)) -> DataFrame:
    """(key, state, start, at, checks) for a stream of checks (key, ts, firing): ``open``, ``firing`` and ``resolved``.

    A resolved run's ``at`` is its last firing check.  Checks older than the watermark are dropped by the engine; two
    checks of one time count one after the other, the one that doesn't fire first; null keys, times and states are left out.
    The query needs the RocksDB state store: see :func:`with_rocksdb`.
    """
    plain = (checks.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("ts"), "firing")
             .filter("key IS NOT NULL AND ts IS NOT NULL AND firing IS NOT NULL")
             .withColumn("us", F.unix_micros("ts")).withWatermark("ts", watermark))
    out = plain.groupBy("key").transformWithStateInPandas(AlertRuns(holds, default), _EVENTS, "Append", "EventTime")
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select(F.col("key").alias(key), "state", at("start_us").alias("start"), at("at_us").alias("at"), "checks")


class with_rocksdb:  # noqa: N801  reads as a statement
    """Queries started inside keep their state in RocksDB; the session's setting comes back afterwards."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(PROVIDER, None)
        self.spark.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *_):
        if self.before is None:
            self.spark.conf.unset(PROVIDER)
        else:
            self.spark.conf.set(PROVIDER, self.before)
