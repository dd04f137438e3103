"""Sinks that write in one pass, once, whatever fails."""

from __future__ import annotations

import json
import os
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from millrace.sources import transaction as TX

SCHEMA = "id long, decision string, score double"


def failing_once(rows, calls, fail):
    """The rows with a score from a model that notes its calls; some first attempts die after a part of their rows."""

    def model(frames):
        c = TaskContext.get()
        for k, f in enumerate(frames):
            with open(f"{calls}/{c.partitionId()}-{c.attemptNumber()}-{k}", "w") as note:
                note.write("\n".join(map(str, f["id"])))
            yield f.assign(score=f["id"] / 2)
            if fail and c.attemptNumber() == 0 and c.partitionId() % 2:
                raise RuntimeError("lost")

    return rows.mapInPandas(model, SCHEMA)


def files(folder):
    return sorted(f"{os.path.basename(d)}/{n}" for d, _, names in os.walk(folder) for n in names if n.endswith(".jsonl"))


@pytest.mark.parametrize("fail", [False, True])
def test_decisions_are_written_once(spark, tmp_path, fail):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    (tmp_path / "calls").mkdir()
    rows = spark.range(0, 200, 1, 4).select("id", F.when(F.col("id") % 3 == 0, "accept").otherwise("reject").alias("decision"), F.lit(None).cast("double").alias("score"))
    scores = failing_once(rows, tmp_path / "calls", fail)
    path = f"{tmp_path}/out"
    TX.write_decisions(scores, path, "b1")
    read = lambda part: sorted((r.id, r.decision, r.score) for r in TX.read_part(spark, path, part, SCHEMA).collect())
    every = [(k, "reject" if k % 3 else "accept", k / 2) for k in range(200)]
    assert read("scores") == every and read("accept") == every[::3] and read("reject") == [r for r in every if r[1] == "reject"]
    listed = sorted(r.file for r in TX.records(spark, path).collect())
    assert [f for f in files(path) if not f.startswith("_records")] == listed  # nothing of attempts that died
    called = [int(x) for n in os.listdir(tmp_path / "calls") for x in (tmp_path / "calls" / n).read_text().split() if fail is False or n.split("-")[1] != "0" or int(n.split("-")[0]) % 2 == 0]
    assert sorted(called) == list(range(200))  # one call for each row, beside those of attempts that died
    before = len(os.listdir(tmp_path / "calls"))
    TX.write_decisions(scores, path, "b1")
    assert len(os.listdir(tmp_path / "calls")) == before and read("scores") == every
    TX.write_decisions(scores.where("id < 3"), path, "b2")
    assert len(read("scores")) == 203


def test_a_batch_that_fails_leaves_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(k, "accept" if k < 90 else "maybe", 0.5) for k in range(100)], SCHEMA).repartition(4)
    with pytest.raises(Exception, match="maybe"):
        TX.write_decisions(rows, f"{tmp_path}/out", "b1")
    assert files(tmp_path) == [] and not TX.committed(f"{tmp_path}/out", "b1")
    TX.write_decisions(rows.where("id < 0"), f"{tmp_path}/out", "b1")
    assert TX.read_part(spark, f"{tmp_path}/out", "accept", SCHEMA).collect() == []
    nulls = spark.createDataFrame([(1, "accept", None)], SCHEMA)
    TX.write_decisions(nulls, f"{tmp_path}/out", "b2")
    name = TX.records(spark, f"{tmp_path}/out").where("part = 'accept'").first().file
    assert (tmp_path / "out" / name).read_text() == '{"id":1,"decision":"accept","score":null}\n'


def test_lists_are_posted_once(spark, tmp_path):
    """The service fails now and then, and so does the task that sends; every task arrives once."""
    got, lock = [], threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            with lock:
                fail = len(got) % 3 == 1 and self.headers["Idempotency-Key"] not in [k for k, _ in got]
                got.append((self.headers["Idempotency-Key"], None if fail else body))
            self.send_response(500 if fail else 201)
            self.send_header("Content-Length", "0")
            self.end_headers()

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/import"
        tasks = spark.range(0, 70, 1, 3).select(F.to_json(F.struct("id")).alias("line"))
        sent = TX.post_once(tasks, f"{tmp_path}/out", "b1", url, {"Authorization": "Token t"}, size=10).collect()
        assert all(r.rows <= 10 and r.status == "sent" for r in sent) and sum(r.rows for r in sent) == 70
        again = TX.post_once(tasks, f"{tmp_path}/out", "b1", url, size=10).collect()
        assert {r.status for r in again} == {"there"}
        arrived = [b for _, b in got if b]
        assert sorted(x["id"] for b in arrived for x in b) == list(range(70)) and len(arrived) == len(sent)
    finally:
        server.shutdown()


