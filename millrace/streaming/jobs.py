"""UD9, SC13: the life of remote jobs as keyed state over their events, in event time.

A job is submitted, runs, and is done; where it takes longer than the timeout it has timed out and is submitted again, so many times,
and then it has failed. Events may come in any order within the watermark's delay, and more than once: they wait in the state until
the watermark has passed them, and are then taken in the order of their times. So the transitions depend on the events alone, neither
on batches nor on partitions. A timer wakes a shard of jobs at its next event or deadline; no state is looked at in vain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

IDLE, SUBMITTED, RUNNING, DONE, FAILED = "idle", "submitted", "running", "done", "failed"
TIMED_OUT = "timed_out"
#: What an event says of its job.
SUBMIT, PROGRESS, FINISH = "submit", "progress", "finish"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class Job:
    """Where a job stands; times in microseconds."""

    status: str = IDLE
    attempt: int = 0
    since: int = 0

    def pass_time(self, now: int, timeout: int, retries: int) -> Iterator[tuple[int, str, int]]:
        """(attempt, status, time) of what happens by itself before `now`: an attempt is over when it has taken longer than the timeout."""
        while self.status in (SUBMITTED, RUNNING) and self.since + timeout < now:
            self.since += timeout
            yield self.attempt, TIMED_OUT, self.since
            if self.attempt < retries:
                self.attempt, self.status = self.attempt + 1, SUBMITTED
                yield self.attempt, SUBMITTED, self.since
            else:
                self.status = FAILED
                yield self.attempt, FAILED, self.since

    def take(self, kind: str, at: int) -> Iterator[tuple[int, str, int]]:
        """What an event makes of the job. One that is in flight isn't submitted again, and one that isn't neither runs nor ends."""
        if kind == SUBMIT and self.status not in (SUBMITTED, RUNNING):
            self.status, self.attempt, self.since = SUBMITTED, 0, at
            yield 0, SUBMITTED, at
        elif kind == PROGRESS and self.status == SUBMITTED:
            self.status = RUNNING
            yield self.attempt, RUNNING, at
        elif kind == FINISH and self.status in (SUBMITTED, RUNNING):
            self.status = DONE
            yield self.attempt, DONE, at


FLYING, WAITING = "job array<long>, status array<string>, attempt array<int>, since array<long>", "of array<long>, at array<long>, event array<long>, kind array<string>"
TOLD = "job long, attempt int, status string, at timestamp"
#: Jobs share a state by their hash: a call for each job of a batch costs milliseconds.
SHARDS = 512


def _columns(rows: list[tuple], n: int) -> tuple[list, ...]:
    return tuple(list(c) for c in zip(*rows, strict=True)) if rows else ([],) * n


class Lives:
    """A shard's turn in a batch: with new events of its jobs, or when its timer is over. Its state holds jobs in flight and events that wait."""

    def __init__(self, timeout: int, retries: int):
        self.timeout, self.retries = timeout, retries

    def turn(self, key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ((),) * 8
        jobs = {k: Job(*known) for k, *known in zip(*held[:4], strict=True)}
        events, now, told = set(zip(*held[4:], strict=True)), state.getCurrentWatermarkMs() * 1000, []  # once each
        for f in () if state.hasTimedOut else frames:
            at = f["at"].astype("datetime64[us]" if f["at"].dt.tz is None else "datetime64[us, UTC]").astype("int64")
            events.update(e for e in zip(f["job"].tolist(), at.tolist(), f["event"].tolist(), f["kind"].tolist(), strict=True) if e[1] > now)  # the others are late
        due = sorted(e for e in events if e[1] <= now)
        for k, at, _, kind in due:
            job = jobs.setdefault(k, Job())
            told += ((k, *x) for x in job.pass_time(at, self.timeout, self.retries))
            told += ((k, *x) for x in job.take(kind, at))
        for k, job in jobs.items():
            told += ((k, *x) for x in job.pass_time(now, self.timeout, self.retries))
        left = sorted(events.difference(due))
        flying = [(k, job.status, job.attempt, job.since) for k, job in jobs.items() if job.status in (SUBMITTED, RUNNING)]  # others begin anew
        if left or flying:
            state.update((*_columns(flying, 4), *_columns(left, 4)))
            wake = min([e[1] for e in left] + [since + self.timeout + 1 for *_, since in flying])
            state.setTimeoutTimestamp(-(-wake // 1000) - 1)  # it is over when the watermark is beyond it: at the event's time, in whole milliseconds
        elif state.exists:
            state.remove()
        if told:
            job, attempt, status, at = _columns(told, 4)
            yield pd.DataFrame({"job": job, "attempt": attempt, "status": status, "at": pd.to_datetime(at, unit="us", utc=True)})


def use_rocksdb(spark: SparkSession) -> None:
    """This store spills to disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def job_lives(events: DataFrame, kind: Column, timeout: float, retries: int, late: str, job: str = "user_id", event: str = "event_id", time: str = "ts") -> DataFrame:
    """job, attempt, status, at of every transition, from a stream of events (job, event, time).

    kind tells what an event says: SUBMIT, PROGRESS or FINISH; others, and events without a job or a time, say nothing. timeout: seconds. Events that come
    later than `late` are dropped; what is newer than that waits.
    """
    use_rocksdb(events.sparkSession)
    rows = events.select(F.col(job).cast("long").alias("job"), F.col(event).cast("long").alias("event"), F.col(time).cast("timestamp").alias("at"), kind.alias("kind"))
    rows = rows.where("job is not null and at is not null").where(F.col("kind").isin(SUBMIT, PROGRESS, FINISH)).withWatermark("at", late)
    shards = rows.withColumn("shard", F.pmod(F.xxhash64("job"), F.lit(SHARDS)))
    return shards.groupBy("shard").applyInPandasWithState(Lives(round(timeout * 1_000_000), retries).turn, TOLD, f"{FLYING}, {WAITING}", "append", GroupStateTimeout.EventTimeTimeout)
