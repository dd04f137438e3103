"""Models as batched functions (UD1-UD6, UD8, SF24, PF13, PF25): a failing row gets an error instead of failing its task."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vision import candidates, margin
from .gate import margin_decision

#: Characters of an error message that are kept.
ERROR_CHARS = 500


def optional(module: str, hint: str):
    """UD5: a module that only some stages need."""
    try:
        return importlib.import_module(module)
    except ImportError as e:
        raise RuntimeError(hint) from e


def device(wanted: str, available: Callable[[], bool]) -> str:
    """UD1: cuda only where there is one."""
    return "cpu" if wanted.startswith("cuda") and not available() else wanted


def predict_rows(rows: DataFrame, load: Callable[[], Callable[[list], list]], input_column: str, output_type: str, batch_size: int = 32, name: str = "score", error: str = "error") -> DataFrame:
    """UD2, UD4, UD6: rows with the model's output and an error of at most ERROR_CHARS (SF24).

    load runs once in a worker and gives a function from a list of inputs to the list of their outputs. Where a batch fails, its rows
    are tried one by one, so that only those that fail themselves lose their output.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def each(inputs: list) -> list[tuple]:
            try:
                got = list(model(inputs))
                if len(got) == len(inputs):
                    return [(x, None) for x in got]
                raise ValueError("a model must give one output for each input")
            except Exception as e:  # noqa: BLE001  the row's own failure is its result
                if len(inputs) == 1:
                    return [(None, f"{type(e).__name__}: {e}"[:ERROR_CHARS])]
                return [x for i in inputs for x in each([i])]

        for f in frames:
            inputs = f[input_column].tolist()
            found = [x for k in range(0, len(inputs), batch_size) for x in each(inputs[k : k + batch_size])]
            yield f.assign(**{name: pd.Series([x for x, _ in found], index=f.index, dtype=object), error: pd.Series([e for _, e in found], index=f.index, dtype=object)})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{fields}, `{name}` {output_type}, `{error}` string")


def score_rows(rows: DataFrame, load: Callable[[], Callable], input_column: str, output_type: str = "double") -> DataFrame:
    """rows with score and error, by a model of one input at a time."""

    def batched():
        model = load()
        return lambda inputs: [model(x) for x in inputs]

    return predict_rows(rows, batched, input_column, output_type)


def margin_rows(rows: DataFrame, load: Callable[[], tuple[Callable, Callable]], positive: list[str], negative: list[str], threshold: float, top_k: int = 3, input_column: str = "image_path", batch_size: int = 32) -> DataFrame:
    """UD2, UD3, AG3, PF4: rows with margin, threshold, decision and error; rows whose image fails are rejected with a null margin.

    load gives two functions: from texts to their vectors, which runs once in a worker, and from inputs and these vectors to an array
    of logits for each input, positive texts first.
    """

    def loaded():
        encode, logits = load()
        vectors = encode([*positive, *negative])
        return lambda inputs: logits(inputs, vectors)

    scored = predict_rows(rows, loaded, input_column, "array<double>", batch_size, name="_logits")
    m = margin(F.slice("_logits", 1, len(positive)), F.slice("_logits", len(positive) + 1, len(negative)), top_k)["margin"]
    return scored.withColumn("margin", m).withColumns({"threshold": F.lit(float(threshold)), "decision": margin_decision(F.col("margin"), threshold)}).drop("_logits")


def person_candidates(prediction: Column) -> Column:
    """UD4, PF14: detections of a prediction: struct of xyxy, scores, classes, points and confidences."""
    return candidates(*(prediction[f] for f in ("xyxy", "scores", "classes", "points", "confidences")))


def job_results(jobs: DataFrame, client: Callable[[], tuple[Callable, Callable]], timeout: float = 1800, every: float = 1.0, retries: int = 2) -> DataFrame:
    """UD8, UD9, SC13: jobs (job, request) with result (JSON) and error: each is submitted and polled until it is there.

    client gives two functions: from a request to an id, and from an id to its result or None. As many jobs are in flight as jobs has
    partitions. A job that fails or takes longer than the timeout is tried again, up to so many times.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        submit, fetch = client()

        def once(request: str) -> str:
            name, until = submit(request), time.monotonic() + timeout
            while (found := fetch(name)) is None:
                if time.monotonic() > until:
                    raise TimeoutError(f"{name} took longer than {timeout} s")
                time.sleep(every)
            return found

        def kept(request: str) -> tuple[str | None, str | None]:
            for k in range(retries + 1):
                try:
                    return once(request), None
                except Exception as e:  # noqa: BLE001  the job's own failure is its result
                    if k == retries:
                        return None, f"{type(e).__name__}: {e}"[:ERROR_CHARS]
            return None, None

        for f in frames:
            found = [kept(x) for x in f["request"]]
            yield f[["job"]].assign(result=[r for r, _ in found], error=[e for _, e in found])

    return jobs.select(F.col("job").cast("long").alias("job"), "request").mapInPandas(run, "job long, result string, error string")
