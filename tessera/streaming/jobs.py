"""Tracking of batch jobs: each job's outcome once, from a stream of its states or from a table of them.

A job has ended with its first terminal state. A job of which nothing is heard for longer than ``patience``, in the time
of the events, has timed out; what comes afterwards doesn't count. States of one time are taken in the order of ``ord``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.embedding import SUCCESS, TERMINAL
from ..operators.ordered import following

TIMED_OUT = "TimedOut"
OUTCOME = "job string, status string, succeeded boolean, at timestamp"


def outcomes(events: DataFrame, patience: str) -> DataFrame:
    """The outcome of each job of a table (job, ord, status, at), as of the table's last time; open jobs have no row.

    Rows without a job, a state or a time are left out. ``at`` of a timed-out job is the last time that counted. A job may
    have any number of states.
    """
    known = events.where("job IS NOT NULL AND status IS NOT NULL AND at IS NOT NULL").select("job", "ord", "status", F.col("at").cast("timestamp").alias("at"))
    now = F.timestamp_micros(F.lit(known.agg(F.unix_micros(F.max("at"))).first()[0]).cast("long"))
    paired = following(known, ["job"], ["at", "ord"], "at", "__next")
    ended = F.col("status").isin(*TERMINAL)
    silent = F.coalesce(F.col("__next.at"), now) > F.col("at") + F.expr(f"INTERVAL {patience}")
    found = paired.where(ended | silent).withColumn("status", F.when(ended, F.col("status")).otherwise(TIMED_OUT))
    first = found.groupBy("job").agg(F.min(F.struct("at", "ord", "status")).alias("f"))
    return first.select(F.col("job").cast("string").alias("job"), F.col("f.status").alias("status"), F.col("f.status").isin(*SUCCESS).alias("succeeded"), F.col("f.at").alias("at"))


class _Tracker(StatefulProcessor):
    """State of a job: its last time in milliseconds, and whether its outcome is out."""

    def __init__(self, patience_ms: int) -> None:
        self.patience = patience_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("job", "at long, done boolean, due long")

    def _keep(self, at: int, done: bool, old_due: int | None, due: int) -> None:
        if old_due is not None and old_due != due:
            self.handle.deleteTimer(old_due)
        if old_due != due:
            self.handle.registerTimer(due)
        self.state.update((at, done, due))

    def handleInputRows(self, key, rows, timerValues):
        at, done, due = self.state.get() if self.state.exists() else (None, False, None)
        seen = pd.concat(list(rows)).sort_values(["at", "ord"], kind="stable")
        outcome, old_due = None, due
        for moment, status in zip(seen["at"], seen["status"]):
            ms = int(pd.Timestamp(moment).timestamp() * 1000)
            if done:
                break
            if at is not None and ms - at > self.patience:
                outcome, done = (TIMED_OUT, at), True
            elif status in TERMINAL:
                outcome, done, at = (status, ms), True, ms
            else:
                at = ms if at is None else max(at, ms)
        # the state of an ended job is kept as long again, so that its outcome comes out once
        self._keep(at, done, old_due, due if done and outcome is None else at + self.patience * (2 if done else 1) + 1)
        if outcome:
            yield self._row(key, *outcome)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at, done, due = self.state.get()
        if done:
            self.state.clear()
            return
        self._keep(at, True, None, due + self.patience)
        yield self._row(key, TIMED_OUT, at)

    @staticmethod
    def _row(key, status: str, ms: int) -> pd.DataFrame:
        return pd.DataFrame({"job": [str(key[0])], "status": [status], "succeeded": [status in SUCCESS], "at": [pd.Timestamp(ms, unit="ms")]})

    def close(self) -> None:
        pass


def track(events: DataFrame, patience_ms: int, delay: str = "0 seconds") -> DataFrame:
    """A stream of outcomes from a stream of states (job, ord, status, at), to be written in append mode.

    States may come ``delay`` late; later ones are dropped. The session's state store must be RocksDB
    (``spark.sql.streaming.stateStore.providerClass``). Times are kept to the millisecond.
    """
    from ..workers import ship

    ship(events.sparkSession)
    known = events.where("job IS NOT NULL AND status IS NOT NULL AND at IS NOT NULL").select(F.col("job").cast("string").alias("job"), "ord", "status", F.col("at").cast("timestamp").alias("at"))
    return known.withWatermark("at", delay).groupBy("job").transformWithStateInPandas(_Tracker(patience_ms), outputStructType=OUTCOME, outputMode="Append", timeMode="EventTime")
