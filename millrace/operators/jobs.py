"""UD8-UD10, SC13, SF23: remote jobs, several in flight in each task, with deadlines, retries and a target.

The jobs are planned as a table; each partition takes its share of them, in order, and of the target. A task keeps a window of jobs
in flight, as many as may still be needed; it looks at them in turn, takes what is ready, and lets go of what took too long: the job
fails the task, is left out (a later job takes its place), or is tried again under its own number and seed. It stops at its share of
the target, and planned jobs that are not needed are never submitted.

A task that Spark runs again submits its jobs again; each submission has a key of its own (run, job, attempt), by which a service can
tell that it had it before.
"""

from __future__ import annotations

import heapq
import json
import math
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import fixed, job_plan

POLICIES = ("fail", "skip", "retry")
DONE, RETRIED, SKIPPED = "done", "retried", "skipped"
RESULT = "part int, turn int, job long, seed long, attempt int, status string, prompt_id string, place int, output string"


@dataclass(order=True)
class Flight:
    """A job in flight, by its deadline."""

    deadline: float
    number: int
    job: dict = field(compare=False)
    attempt: int = field(compare=False)
    name: str = field(compare=False)
    over: bool = field(compare=False, default=False)


class Window:
    """The jobs of one task. client: submit(request, key) gives a name; fetch(name) gives a list of outputs, or None while it runs;
    clock() and sleep(seconds) are time's, unless it has its own."""

    def __init__(self, client, jobs: Iterator[dict], target: int, run: str, most: int, each: int, timeout: float, every: float, policy: str, retries: int):
        self.client, self.jobs, self.target, self.run = client, jobs, target, run
        self.most, self.each, self.timeout, self.every, self.policy, self.retries = most, each, timeout, every, policy, retries
        self.clock, self.sleep = getattr(client, "clock", time.monotonic), getattr(client, "sleep", time.sleep)
        self.flights: list[Flight] = []  # in the order in which they are looked at
        self.deadlines: list[Flight] = []  # a heap
        self.taken, self.count = 0, 0

    def _submit(self, job: dict, attempt: int) -> Flight:
        name = self.client.submit(job["request"], f"{self.run}-{job['job']}-{attempt}")
        self.count += 1
        flight = Flight(self.clock() + self.timeout, self.count, job, attempt, str(name))
        heapq.heappush(self.deadlines, flight)
        return flight

    def _fill(self) -> None:
        need = min(self.most, math.ceil((self.target - self.taken) / self.each))
        while len(self.flights) < need and (job := next(self.jobs, None)) is not None:
            self.flights.append(self._submit(job, 0))

    def _late(self) -> list[Flight]:
        now, found = self.clock(), []
        while self.deadlines and (self.deadlines[0].over or self.deadlines[0].deadline < now):
            flight = heapq.heappop(self.deadlines)
            if not flight.over:
                found.append(flight)
        return found

    def __iter__(self) -> Iterator[tuple[Flight, str, int | None, str | None]]:
        """(flight, status, number of the output, output) of all that happens, until the target is reached or no job is left."""
        while self.taken < self.target:
            self._fill()
            if not self.flights:
                return
            for flight in self._late():
                flight.over = True
                at = self.flights.index(flight)
                if self.policy == "retry" and flight.attempt < self.retries:
                    yield flight, RETRIED, None, None
                    self.flights[at] = self._submit(flight.job, flight.attempt + 1)
                elif self.policy == "skip":
                    yield flight, SKIPPED, None, None
                    del self.flights[at]
                else:
                    raise TimeoutError(f"job {flight.job['job']} ({flight.name}) took longer than {self.timeout} s")
            ready = [(f, found) for f in self.flights if (found := self.client.fetch(f.name)) is not None]
            if not ready:
                if self.flights:
                    self.sleep(self.every)
                continue
            for flight, outputs in reversed(ready):
                flight.over = True
                self.flights.remove(flight)
                for place, output in enumerate(outputs):
                    if self.taken < self.target:
                        self.taken += 1
                        yield flight, DONE, place, output


def run_jobs(plan: DataFrame, client: Callable[[], object], target: int, partitions: int = 4, max_inflight: int = 4, outputs_per_job: int = 1, timeout: float = 1800, every: float = 1.0, policy: str = "fail", retries: int = 2, run: str | None = None) -> DataFrame:
    """What jobs (job, seed, request) gave: part, turn, job, seed, attempt, status, prompt_id, place, output.

    A row for each output (done) and for each attempt that took too long (retried, skipped). Each of the partitions takes every so-many-th
    job and its share of the target; turn is the order in which it saw things. client() is called once in each task.
    """
    if policy not in POLICIES:
        raise ValueError(f"{policy} is none of {POLICIES}")
    if target <= 0 or max_inflight <= 0 or outputs_per_job <= 0 or partitions <= 0:
        raise ValueError("the target, the window, the outputs of a job and the partitions must be positive")
    run = run or uuid.uuid4().hex

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for f in frames for r in f.to_dict("records"))
        first = next(rows, None)
        if first is None:
            return
        part = first["part"]
        share = target // partitions + (part < target % partitions)
        window = Window(client(), chain([first], rows), share, run, max_inflight, outputs_per_job, timeout, every, policy, retries)
        held = []
        for turn, (flight, status, place, output) in enumerate(window):
            held.append((part, turn, flight.job["job"], flight.job["seed"], flight.attempt, status, flight.name, place, output))
            if len(held) == 1000:
                yield _frame(held)
                held = []
        if held:
            yield _frame(held)

    dealt = plan.select(F.pmod("job", F.lit(partitions)).cast("int").alias("part"), F.col("job").cast("long").alias("job"), F.col("seed").cast("long").alias("seed"), F.col("request").cast("string").alias("request"))
    return dealt.repartitionById(partitions, F.col("part")).sortWithinPartitions("part", "job").mapInPandas(work, RESULT)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=["part", "turn", "job", "seed", "attempt", "status", "prompt_id", "place", "output"])
    return f.astype({"place": "Int32"})


def generate(anchors: DataFrame, request, target: int, seed: int, client: Callable[[], object], outputs_per_job: int = 1, spare: float = 1.0, **how) -> DataFrame:
    """UD9: jobs over anchors (anchor_id, turn; others) until the target is reached: job i takes anchor i mod n and seed + i.

    request: from the planned columns to the text that is submitted. A round plans what is still missing and some to spare; where jobs were
    skipped or gave nothing, the next one goes on with later numbers. What a round gave is kept, so that no round is run twice.
    """
    found, missing, start = None, target, 0
    while missing > 0:
        jobs = math.ceil(missing / outputs_per_job * (1 + spare))
        plan = job_plan(anchors, jobs, seed, start)
        got = fixed(run_jobs(plan.withColumn("request", request(plan)), client, missing, outputs_per_job=outputs_per_job, **how))
        n = got.where(F.col("status") == DONE).count()
        if not n:
            raise RuntimeError(f"{jobs} jobs gave nothing, and {missing} outputs are missing")
        found, missing, start = got if found is None else found.unionByName(got), missing - n, start + jobs
    return found


def outcome_counts(results: DataFrame) -> DataFrame:
    """UD9: outputs, and attempts that took too long: all of them, those that were tried again and those that were left out."""
    s = F.col("status")
    return results.agg(F.count_if(s == DONE).alias("outputs"), F.count_if(s != DONE).alias("timeout_count"), F.count_if(s == RETRIED).alias("timeout_retry_count"), F.count_if(s == SKIPPED).alias("timeout_skip_count"))


class Service:
    """SC13, UD8: a service that takes graphs and tells of finished ones in its history."""

    def __init__(self, base_url: str, client_id: str = "millrace"):
        self.base, self.client_id = base_url.rstrip("/"), client_id

    def _call(self, path: str, body: bytes | None = None, seconds: int = 60, **headers: str) -> dict:
        request = urllib.request.Request(self.base + path, data=body, headers={k.replace("_", "-"): v for k, v in headers.items()})
        with urllib.request.urlopen(request, timeout=seconds) as found:
            return json.loads(found.read())

    def submit(self, graph: str, key: str) -> str:
        body = json.dumps({"prompt": json.loads(graph), "client_id": self.client_id}).encode()
        return str(self._call("/prompt", body, Content_Type="application/json", Idempotency_Key=key)["prompt_id"])

    def fetch(self, name: str) -> list[str] | None:
        """The outputs of a finished job: one JSON text for each image of type output, in the order of nodes and images."""
        found = self._call(f"/history/{name}", seconds=30).get(name)
        if found is None:
            return None
        images = ((node, i) for node, out in (found.get("outputs") or {}).items() for i in out.get("images", []))
        return [json.dumps({"node_id": node, **i}) for node, i in images if i.get("type", "output") == "output"]

    def upload(self, path: str, subfolder: str = "") -> str:
        """The name that the service gives to an input image."""
        mark, fields = uuid.uuid4().hex, {"type": "input", "overwrite": "true"} | ({"subfolder": subfolder} if subfolder else {})
        parts = [f'--{mark}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in fields.items()]
        parts.append(f'--{mark}\r\nContent-Disposition: form-data; name="image"; filename="{Path(path).name}"\r\nContent-Type: application/octet-stream\r\n\r\n'.encode())
        name = self._call("/upload/image", b"".join([*parts, Path(path).read_bytes(), f"\r\n--{mark}--\r\n".encode()]), 120, Content_Type=f"multipart/form-data; boundary={mark}").get("name")
        if not name:
            raise RuntimeError("the service gave no name for an uploaded image")
        return str(name)
