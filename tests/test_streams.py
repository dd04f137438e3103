"""Streams that die, and events that come late, twice and in any order."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string"


def log(folder, name, events):
    frame = pd.DataFrame(events, columns=["event_id", "ts", "user_id", "event_type"])
    frame["ts"] = pd.to_datetime(frame["ts"], unit="us")
    frame.to_parquet(f"{folder}/{name}.parquet", row_group_size=7, index=False)


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def some_events(n=60, seed=1):
    rng = random.Random(seed)
    return [(k, 1_700_000_000_000_000 + k * 60_000_000 + rng.randrange(1000), rng.choice([1, 1, 1, 2, 3]), rng.choice(["submit", "submit", "progress", "finish", "noise"])) for k in range(n)]


def test_a_stream_that_dies_gives_every_event_once(spark, tmp_path):
    """It fails in its second batch, is started again, and goes on; then a file is added."""
    from millrace.sources.events import stream_of

    (tmp_path / "log").mkdir()
    events = some_events()
    log(tmp_path / "log", "a", events[:25])
    log(tmp_path / "log", "b", events[25:])
    log(tmp_path / "log", "_hidden", events)
    seen, tries = {}, []

    def run(fail):
        def write(rows, number):
            tries.append(number)
            got = [r.event_id for r in rows.collect()]
            if fail and number == 1:
                raise RuntimeError("killed")
            assert number not in seen or seen[number] == got
            seen[number] = got

        stream = stream_of(spark, str(tmp_path / "log"), schema(spark), str(tmp_path / "mark"), rows=20, partitions=3)
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "state")).foreachBatch(write).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="killed"):
        run(True)
    assert list(seen) == [0] and len(seen[0]) == 20
    run(False)
    assert tries.count(1) == 2 and sorted(x for b in seen.values() for x in b) == list(range(60))
    assert all(len(b) == 20 for b in seen.values())
    log(tmp_path / "log", "c", some_events(75)[60:])
    run(False)
    assert sorted(x for b in seen.values() for x in b) == list(range(75))


def test_the_log_as_a_table(spark, tmp_path):
    from millrace.sources.events import register

    events = some_events()
    log(tmp_path, "a", events[:25])
    log(tmp_path, "b", events[25:])
    register(spark)
    rows = spark.read.format("job_events").schema(schema(spark)).option("path", str(tmp_path)).option("partitions", 5).load()
    assert rows.rdd.getNumPartitions() == 5
    assert sorted(r.event_id for r in rows.collect()) == list(range(60))
    assert spark.read.format("job_events").schema("user_id long").option("path", f"file://{tmp_path}/a.parquet").load().count() == 25


def lives(events, timeout, retries, until):
    """Minute by minute, one job after the other."""
    out = []
    for job in {e[2] for e in events}:
        mine = sorted({e for e in events if e[2] == job and e[3] != "noise" and e[1] <= until}, key=lambda e: e[:0] + (e[1], e[0]))
        status, attempt, since = "idle", 0, 0
        for at, kind in [(e[1], e[3]) for e in mine] + [(until, "end")]:
            while status in ("submitted", "running") and at - since > timeout:
                since += timeout
                out.append((job, attempt, "timed_out", since))
                attempt, status = (attempt + 1, "submitted") if attempt < retries else (attempt, "failed")
                out.append((job, attempt, status, since))
            flying = status in ("submitted", "running")
            if kind == "submit" and not flying:
                status, attempt, since = "submitted", 0, at
            elif kind == "progress" and status == "submitted":
                status = "running"
            elif kind == "finish" and flying:
                status = "done"
            else:
                continue
            out.append((job, attempt, status, at))
    return sorted(out)


@pytest.mark.parametrize("order", ["in order", "mixed"])
def test_job_lives(spark, tmp_path, order):
    """Events in any order within the delay, some twice, in batches of any size; one that comes later than the delay is left out."""
    from millrace.sources.events import stream_of
    from millrace.streaming import replay
    from millrace.streaming.jobs import job_lives

    events, rng, delay = some_events(90, 4), random.Random(2), 600_000_000
    sent = sorted(events, key=lambda e: e[1] + (rng.randrange(delay) if order == "mixed" else 0))
    sent += [sent[-1], sent[-3]]  # twice, at the end
    late = (500, events[0][1] + 1, 1, "finish")
    (tmp_path / "log").mkdir()
    log(tmp_path / "log", "a", sent[:40] + [sent[38], sent[39]])
    log(tmp_path / "log", "b", sent[40:] + [late])
    log(tmp_path / "log", "c", [(900, None, 1, "submit"), (901, sent[5][1] + 10**9, None, "submit")])
    stream = stream_of(spark, str(tmp_path / "log"), schema(spark), str(tmp_path / "mark"), rows=17 if order == "mixed" else 50)
    got = replay(job_lives(stream, F.col("event_type"), 240, 2, "600 seconds"), paced=True)
    until = max(e[1] for e in events if e[3] != "noise") // 1000 * 1000 - delay
    found = sorted((r.job, r.attempt, r.status, round(r.at.timestamp() * 1_000_000)) for r in got.collect())
    assert found == lives(events, 240_000_000, 2, until)
    assert {"timed_out", "failed", "done", "running"} <= {r[2] for r in found}
