"""Stage runner and serial plans (OR2-OR10, SC4): stages are functions over DataFrames in one session. The stages: stages.py.

A stage's result is kept under a hash of the input, its name, its settings and those of the stages before it, so that a run with the same
input and settings resumes where it stopped.
"""

from __future__ import annotations

import fcntl
import hashlib
import json
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import FALSE_WORDS, TRUE_WORDS

FAILED_ACTION, INTERRUPTED = 90, 143
WHEN = ("always", "success", "failure")


#: What a round runs (OR10).
ROUNDS = {"whole": ["dataloader", "generate", "filter", "train", "eval"], "filter_train_eval": ["filter", "train", "eval"], "closed_loop": ["generate", "dataloader"]}


def wired(settings: dict, folder: str) -> dict:
    """OR2: settings in which generate reads what dataloader gave and filter what generate gave, unless they say otherwise."""
    generate, filter_ = dict(settings.get("generate") or {}), dict(settings.get("filter") or {})
    generate.setdefault("real_manifest", f"{folder}/dataloader/real_manifest.jsonl")
    filter_.setdefault("input_manifests", [f"{folder}/generate/synth_manifest.jsonl"])
    return settings | {"generate": generate, "filter": filter_}


@contextmanager
def alone(path: str) -> Iterator[None]:
    """OR5: holds a lock file of this machine; a second holder fails at once."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a+") as held:
        try:
            fcntl.flock(held, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError as e:
            raise RuntimeError(f"{path} is held by another run") from e
        held.truncate(0)
        held.write(json.dumps({"pid": os.getpid()}))
        held.flush()
        yield


def fingerprint(rows: DataFrame) -> str:
    """The same for the same rows in any order: schema, number, and sums of two hashes of each row."""
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)), {"ignoreNullFields": "false"}) if rows.columns else F.lit("")
    part = lambda salt: F.sum(F.xxhash64(F.lit(salt), row).cast("decimal(38,0)"))
    found = rows.agg(F.count(F.lit(1)), part(1), part(2)).first()
    return hashlib.sha256(repr((rows.schema.json(), *map(str, found))).encode()).hexdigest()


@dataclass
class Runner:
    spark: SparkSession
    folder: str
    stages: dict[str, Callable[[SparkSession, dict, DataFrame | None], DataFrame]]
    summary: dict = field(default_factory=dict)

    def run(self, names: list[str], settings: dict[str, dict], start: DataFrame | None = None) -> DataFrame:
        """Runs the stages in order; stages whose result is there are skipped. The first failure ends the run, and so does an interrupt
        (OR5: its code is 143); the summary tells how far it came."""
        for n in names:
            if n not in self.stages:
                raise ValueError(f"unknown stage {n}")
        self.summary = {"status": "running", "completed": [], "skipped": []}
        rows, past = start, fingerprint(start) if start is not None else ""
        for n in names:
            past = hashlib.sha256(json.dumps([past, n, settings.get(n, {})], sort_keys=True).encode()).hexdigest()
            path = f"{self.folder}/{n}-{past[:16]}"
            if self._there(path):
                self.summary["skipped"].append(n)
            else:
                try:
                    self.stages[n](self.spark, settings.get(n, {}), rows).write.mode("overwrite").parquet(path)
                except KeyboardInterrupt:
                    self.summary |= {"status": "interrupted", "failed": n, "code": INTERRUPTED}
                    raise
                except Exception:
                    self.summary |= {"status": "failed", "failed": n}
                    raise
                self.summary["completed"].append(n)
            rows = self.spark.read.parquet(path)
        self.summary["status"] = "ok"
        return rows

    def _there(self, path: str) -> bool:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)


@dataclass(frozen=True)
class Action:
    kind: str
    enabled: bool = True
    on: str = "always"
    continue_on_error: bool = False
    timeout_sec: int = 10
    params: dict = field(default_factory=dict)

    def due(self, ok: bool) -> bool:
        return self.enabled and (self.on == "always" or (self.on == "success") == ok)


@dataclass(frozen=True)
class Task:
    stage: str
    name: str
    config: str
    actions: tuple[Action, ...]


def truth(value, default: bool) -> bool:
    """A setting as a truth value: the known words in any case, else whether there is anything; None is the default."""
    if value is None:
        return default
    word = value.strip().lower() if isinstance(value, str) else None
    return True if word in TRUE_WORDS else False if word in FALSE_WORDS else bool(value)


def parse_actions(found: list | None) -> tuple[Action, ...]:
    if found is not None and not isinstance(found, list):
        raise ValueError("post_actions must be a list")
    out = []
    for x in found or []:
        x = {"type": x} if isinstance(x, str) else dict(x)
        kind, on, seconds = str(x.get("type") or "").strip(), str(x.get("on", "always")).strip().lower(), int(x.get("timeout_sec", 10))
        if not kind:
            raise ValueError("an action has no type")
        if on not in WHEN:
            raise ValueError(f"on must be one of {WHEN}")
        if seconds <= 0:
            raise ValueError("timeout_sec must be positive")
        out.append(Action(kind, truth(x.get("enabled"), True), on, truth(x.get("continue_on_error"), False), seconds, dict(x.get("params") or {})))
    return tuple(out)


def parse_plan(plan: dict) -> tuple[list[Task], bool]:
    """OR6: tasks in order, each with the actions of the plan, its stage and its own; and whether to go on after a failure.

    Stages and tasks without a name get one by their place.
    """
    root = plan.get("serial_plan")
    if not isinstance(root, dict) or not isinstance(root.get("stages"), list) or not root["stages"]:
        raise ValueError("a plan needs serial_plan.stages")
    common, tasks = parse_actions(root.get("post_actions")), []
    for k, stage in enumerate(root["stages"], 1):
        name = str(stage.get("name") or "").strip() or f"stage_{k}"
        own = common + parse_actions(stage.get("post_actions"))
        if not isinstance(stage.get("tasks"), list) or not stage["tasks"]:
            raise ValueError(f"{name} has no tasks")
        for i, t in enumerate(stage["tasks"], 1):
            t = {"config": t} if isinstance(t, str) else t
            config = str(t.get("config") or "").strip()
            if not config:
                raise ValueError(f"a task of {name} has no config")
            tasks.append(Task(name, str(t.get("name") or "").strip() or f"{name}_{i}", config, own + parse_actions(t.get("post_actions"))))
    return tasks, truth(root.get("continue_on_error"), False)


def run_plan(plan: dict, run: Callable[[Task], int], act: Callable[[Action, Task], None], summary: str | None = None) -> dict:
    """OR8, OR9: the codes of all tasks and what their actions did; a failed action after a success makes the task fail with 90, and
    ends the task's actions unless it may fail. summary: a file that gets the result as JSON."""
    tasks, go_on = parse_plan(plan)
    results: list[dict] = []
    for t in tasks:
        code, told = run(t), []
        ok = code == 0
        for a in t.actions:
            if not a.due(ok):
                continue
            try:
                act(a, t)
                told.append((a.kind, "ok"))
            except Exception as e:  # noqa: BLE001  a failed action is a result
                told.append((a.kind, f"failed: {e}"))
                if not a.continue_on_error:
                    code = code or FAILED_ACTION
                    break
        results.append({"stage": t.stage, "name": t.name, "code": code, "actions": told})
        if code and not go_on:
            break
    out = {"results": results, "jobs": len(tasks), "tasks": [(r["name"], r["code"]) for r in results], "exit": int(any(r["code"] for r in results))}
    if summary:
        Path(summary).parent.mkdir(parents=True, exist_ok=True)
        Path(summary).write_text(json.dumps(out, ensure_ascii=False, indent=2))
    return out


def release_memory(spark: SparkSession) -> Callable[[Action, Task], None]:
    """OR8: the actions of this engine: free_memory drops cached tables, queue_empty_check fails while jobs run."""

    def act(action: Action, task: Task) -> None:
        if action.kind == "free_memory":
            spark.catalog.clearCache()
        elif action.kind == "queue_empty_check":
            if busy := list(spark.sparkContext.statusTracker().getActiveJobsIds()):
                raise RuntimeError(f"{len(busy)} jobs are running")
        else:
            raise ValueError(f"{action.kind} is no action")

    return act


def load_config(path: str) -> dict:
    """SC4: a YAML or JSON mapping."""
    text = Path(path).read_text()
    kind = Path(path).suffix.lower()
    if kind in (".yaml", ".yml"):
        import yaml

        found = yaml.safe_load(text)
    elif kind == ".json":
        found = json.loads(text)
    else:
        raise ValueError(f"{kind} is no format of settings")
    if not isinstance(found, dict):
        raise ValueError("settings must be a mapping")
    return found
