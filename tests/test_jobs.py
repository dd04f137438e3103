"""Windows of jobs, places within groups, exact decimals, and rows that were wrong before."""

from __future__ import annotations

import collections
import json
import math
import random
import sys
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millrace.functions import decimals as D
from millrace.functions import vision as V
from millrace.operators import jobs as W
from millrace.operators import relational as R

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks cannot import tests


class Fake:
    """A service with a clock of its own; jobs take the ticks that their request says, by attempt, and give so many outputs."""

    def __init__(self):
        self.now, self.jobs, self.open, self.most, self.submitted = 0, {}, 0, 0, []

    def clock(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds

    def submit(self, request, key):
        ticks, outputs = json.loads(request)
        attempt = int(key.rsplit("-", 1)[1])
        self.submitted.append(key)
        self.jobs[key] = (self.now + ticks[min(attempt, len(ticks) - 1)], outputs)
        return key

    def fetch(self, name):
        ready, outputs = self.jobs[name]
        return [f"{name}:{k}" for k in range(outputs)] if self.now >= ready else None


def by_the_rule(jobs, target, most, each, timeout, policy, retries):
    """The loop over jobs in flight as one would write it down: (job, attempt, status, place) in order."""
    out, flying, now, left, taken = [], [], 0, list(jobs), 0
    while taken < target:
        while len(flying) < min(most, math.ceil((target - taken) / each)) and left:
            k, ticks, outputs = left.pop(0)
            flying.append([k, 0, now, ticks, outputs])
        if not flying:
            break
        due = sorted((f for f in flying if now - f[2] > timeout), key=lambda f: f[2])
        for f in due:
            if policy == "retry" and f[1] < retries:
                out.append((f[0], f[1], "retried", None))
                flying[flying.index(f)] = [f[0], f[1] + 1, now, f[3], f[4]]
            elif policy == "skip":
                out.append((f[0], f[1], "skipped", None))
                flying.remove(f)
            else:
                raise TimeoutError
        ready = [f for f in flying if now >= f[2] + f[3][min(f[1], len(f[3]) - 1)]]
        if not ready:
            now += 1 if flying else 0
            continue
        for f in reversed(ready):
            flying.remove(f)
            for place in range(f[4]):
                if taken < target:
                    taken += 1
                    out.append((f[0], f[1], "done", place))
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize(("policy", "retries"), [("skip", 0), ("retry", 3)])
def test_a_window_follows_the_rule(seed, policy, retries):
    rng = random.Random(seed)
    slow = lambda: rng.choice([0, 1, 2, 3, 5, 9, 30])
    jobs = [(k, [slow(), slow(), slow(), 1], rng.randrange(4)) for k in range(60)]
    for target, most, each in ((40, 4, 1), (25, 3, 2), (1000, 7, 1)):
        client = Fake()
        rows = [{"job": k, "seed": k, "request": json.dumps([ticks, n])} for k, ticks, n in jobs]
        submit, live = client.submit, set()
        window = W.Window(client, iter(rows), target, "r", most, each, 6, 1, policy, retries)
        client.submit = lambda request, key: (live.add(key), submit(request, key))[1]  # noqa: B023
        got, peak = [], 0
        for flight, status, place, _ in window:
            got.append((flight.job["job"], flight.attempt, status, place))
            peak = max(peak, len(window.flights))
        assert got == by_the_rule(jobs, target, most, each, 6, policy, retries)
        assert peak <= most
        assert sum(s == "done" for _, _, s, _ in got) <= target
        if target == 25:
            assert len({k.split("-")[1] for k in client.submitted}) < 60  # what is not needed is not submitted


def test_a_window_that_fails():
    client = Fake()
    rows = [{"job": 0, "seed": 0, "request": "[[9, 9], 1]"}]
    for policy, retries in (("fail", 3), ("retry", 1)):
        with pytest.raises(TimeoutError, match="job 0"):
            list(W.Window(client, iter(rows), 1, "r", 2, 1, 3, 1, policy, retries))


def test_jobs_by_partition(spark):
    """Each partition takes its share; together they reach the target and no more."""
    plan = spark.range(300).select(F.col("id").alias("job"), (F.col("id") + 7).alias("seed"), F.concat(F.lit("[["), F.col("id") % 5, F.lit("], 2]")).alias("request"))
    got = W.run_jobs(plan, Fake, 101, partitions=3, max_inflight=4, outputs_per_job=2, timeout=3, every=1, policy="skip").collect()
    done = [r for r in got if r.status == "done"]
    assert len(done) == 101 and {r.part for r in got} == {0, 1, 2} and all(r.job % 3 == r.part and r.seed == r.job + 7 for r in got)
    assert sorted(collections.Counter(r.part for r in done).values()) == [33, 34, 34]
    assert all(r.job % 5 == 4 for r in got if r.status == "skipped") and any(r.status == "skipped" for r in got)
    for part in range(3):
        assert [r.turn for r in sorted((r for r in got if r.part == part), key=lambda r: r.turn)] == list(range(sum(r.part == part for r in got)))
    counts = W.outcome_counts(spark.createDataFrame(got)).first()
    assert (counts.outputs, counts.timeout_count, counts.timeout_skip_count, counts.timeout_retry_count) == (101, len(got) - 101, len(got) - 101, 0)
    assert W.run_jobs(plan.limit(0), Fake, 5).collect() == []
    with pytest.raises(ValueError):
        W.run_jobs(plan, Fake, 5, policy="again")


def test_generation_goes_on_until_the_target(spark):
    """Jobs that give nothing are replaced by later ones, with anchors and seeds by their number."""
    anchors = spark.createDataFrame([(k, k) for k in range(7)], "anchor_id long, turn long")
    request = lambda plan: F.concat(F.lit("[[1], "), F.when(F.col("job") < 30, 0).otherwise(1), F.lit("]"))
    got = W.generate(anchors, request, 20, 100, Fake, partitions=2, every=1).where("status = 'done'").collect()
    assert len(got) == 20 and all(r.job >= 30 and r.seed == 100 + r.job for r in got)
    with pytest.raises(RuntimeError, match="gave nothing"):
        W.generate(anchors, lambda plan: F.lit("[[1], 0]"), 5, 0, Fake, partitions=2, every=1)


def test_a_service_over_http(spark, tmp_path):
    """Jobs end out of order; each is submitted once, with its key; images go up first."""
    seen, lock = {"keys": [], "polls": collections.Counter(), "files": []}, threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def answer(self, found):
            body = json.dumps(found).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            with lock:
                if self.path == "/prompt":
                    seen["keys"].append(self.headers["Idempotency-Key"])
                    return self.answer({"prompt_id": f"p{json.loads(body)['prompt']['n']}"})
                seen["files"].append(body.count(b"pixels"))
            self.answer({"name": "anchor (1).png"})

        def do_GET(self):
            name = self.path.rsplit("/", 1)[1]
            with lock:
                seen["polls"][name] += 1
                late = seen["polls"][name] <= 4 - int(name[1:]) % 5
            images = [{"filename": f"{name}.png", "type": "output"}, {"filename": "x.png", "type": "temp"}]
            self.answer({} if late else {name: {"outputs": {"9": {"images": images}}}})

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}"
        plan = spark.range(12).select(F.col("id").alias("job"), F.col("id").alias("seed"), F.to_json(F.struct(F.col("id").alias("n"))).alias("request"))
        got = W.run_jobs(plan, lambda: W.Service(url), 12, partitions=2, max_inflight=3, every=0.01, run="r").collect()
        assert sorted(json.loads(r.output)["filename"] for r in got) == sorted(f"p{k}.png" for k in range(12))
        assert sorted(seen["keys"]) == sorted(f"r-{k}-0" for k in range(12))
        (tmp_path / "a.png").write_bytes(b"pixels")
        assert W.Service(url).upload(str(tmp_path / "a.png"), "sub") == "anchor (1).png" and seen["files"] == [1]
    finally:
        server.shutdown()


def test_places_within_one_large_group(spark):
    """One prefix has nearly all rows: no range has more than twice the middle one, and places are those of one sort."""
    rng = random.Random(3)
    rows = [("hot" if k % 50 else f"p{k % 7}", rng.randrange(400), k) for k in range(4000)] + [(None, 1, 5000), (None, 0, 5001)]
    df = spark.createDataFrame(rows, "prefix string, counter long, id long").repartition(5)
    got = R.ranked_within(df, ["prefix"], [F.col("counter"), F.col("id")])
    turn, expected = collections.Counter(), set()
    for p, c, i in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        turn[p] += 1
        expected.add((p, c, i, turn[p]))
    assert {tuple(r) for r in got.collect()} == expected
    ranges = R.fixed(df.repartitionByRange(4, "prefix", "counter", "id")).groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in ranges)
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:  # pairs meet by prefix and place, in tasks of nearly one size
        refs = df.select("prefix", F.col("id").alias("ref_id"))
        pairs = R.rank_pairs(df.select("prefix", "counter", F.col("id").alias("name")), refs)
        tasks = sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(tasks) == 4000 and tasks[-1] < 2 * tasks[len(tasks) // 2]


def test_decimals_are_exact(spark):
    """What Python's formatting and rounding say, for ties, what only seems a tie, and all else."""
    rng = random.Random(9)
    xs = [k / 128 for k in range(-300, 300)] + [0.1234565, 2.675, 1.005, 0.5, 1.5, 2.5, 0.03125, 0.0, -0.0, -1e-9, 1e-300, 4.4e9 + 1 / 3, -4.4e9, 123456.7890125, float("nan"), float("inf"), float("-inf")]
    xs += [rng.uniform(-1, 1) for _ in range(3000)] + [round(rng.uniform(0, 99), 5) + 0.0000005 for _ in range(3000)] + [rng.randrange(1 << 40) / (1 << 20) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(3)
    x = F.col("x")
    for r in df.select("x", D.fixed_text(x, 6).alias("six"), D.fixed_text(x, 2).alias("two"), D.fixed_text(x, 0).alias("none"), D.rounded(x, 4).alias("four")).collect():
        assert (r.six, r.two, r.none) == (f"{r.x:.6f}", f"{r.x:.2f}", f"{r.x:.0f}")
        assert str(r.four) == str(round(r.x, 4)) or r.four == round(r.x, 4)
    unit = df.where("x between 0 and 1 and cast(x as string) <> '-0.0'").select("x", D.unit_text(x).alias("t")).collect()
    assert len(unit) > 1000 and all(r.t == f"{r.x:.6f}" for r in unit)
    assert spark.sql("select cast(null as double) as x").select(D.fixed_text(x, 6)).first()[0] is None


def test_label_lines_at_ties_and_without_numbers(spark):
    """Lines against plain formatting: ties, numbers beyond 0 and 1, missing and odd keypoints, boxes and sizes that lack a number."""
    rng = random.Random(8)
    clamp = lambda v: max(0.0, min(1.0, v))

    def plain(b, k, w, h):
        if w is None or h is None or len(b) < 4 or None in b[:4]:
            return None
        k = [0.0 if x is None else x for x in [*k, *[0.0] * 51][:51]]
        head = ((b[0] + b[2] / 2) / w, (b[1] + b[3] / 2) / h, b[2] / w, b[3] / h)
        return "0 " + " ".join(f"{clamp(v):.6f}" for v in head) + "".join(f" {clamp(k[j] / w):.6f} {clamp(k[j + 1] / h):.6f} {int(k[j + 2])}" for j in range(0, 51, 3))

    rows = []
    for _ in range(400):
        w = rng.choice([128, 64, 640, 1000, 3])
        rows.append(([rng.randrange(2 * w) / 2 for _ in range(4)], [float(rng.choice([0, 1, 2])) if j % 3 == 2 else rng.uniform(-1, 1.2 * w) if j % 2 else rng.randrange(w) / 4 for j in range(51)], w, 128))
    rows += [([1.0, None, 10.0, 6.0], [1.0], 5, 5), ([1.0, 2.0], [1.0], 5, 5), ([1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 12.0, None, 3.0, -1.0], 5, 5), ([1.0, 2.0, 3.0, 4.0], [], None, 5), ([1.0, 2.0, 3.0, 4.0, 9.0], [2.0] * 60, 8, 8)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, b array<double>, k array<double>, w int, h int").repartition(3)
    got = {r.i: r.t for r in df.select("i", V.coco_label_line(F.col("b"), F.col("k"), F.col("w"), F.col("h")).alias("t")).collect()}
    assert [got[i] for i in range(len(rows))] == [plain(*r) for r in rows]


def test_rows_that_were_wrong(spark, tmp_path):
    real = spark.createDataFrame([("a", 0, "x"), ("b", 1, "y"), ("c", 2, "z")], "sample_id string, pos long, image_path string")
    assert R.stub_plan(real, 0, 7).collect() == [] and R.stub_plan(real, -1, 7).collect() == []
    files = spark.createDataFrame([("x",), ("z",)], "path string")
    assert sorted(r.seed for r in R.stub_plan(real, 2, 7, 0, files).collect()) == [7, 8, 207, 208]
    seen = spark.createDataFrame([(float("nan"),), (0.5,), (0.2,), (0.0,)], "c double").select(V.visibility(F.col("c"), 0.5)).collect()
    assert [r[0] for r in seen] == [0, 2, 1, 0]
    assert R.job_count(spark.createDataFrame([("a",), ("\t",), ("\n ",), (" a",)], "id string"), "id").first().jobs == 1
    assert R.job_plan(spark.createDataFrame([], "anchor_id long, turn long"), 5, 1).collect() == []


def test_a_run_with_another_input_is_another_run(spark, tmp_path):
    from millrace.plans import Runner

    runner = Runner(spark, str(tmp_path), {"x": lambda s, c, rows: rows})
    assert runner.run(["x"], {}, spark.range(2)).count() == 2
    assert runner.run(["x"], {}, spark.range(5)).count() == 5 and runner.summary["skipped"] == []
    assert runner.run(["x"], {}, spark.range(5).repartition(3)).count() == 5 and runner.summary["skipped"] == ["x"]
