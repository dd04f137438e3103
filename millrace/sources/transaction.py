"""SK3, SK4, SK13: tables written in one pass, by decision, all of it or nothing, and once however often tasks or drivers try.

Tasks write files of their own; a file counts once the batch's record lists it. The driver writes that record when all tasks have told
what they wrote, at once and under the batch's token: a batch whose record is there is not written again. Files of attempts that died
are in no record; those of the same token are removed.
"""

from __future__ import annotations

import json
import time
import urllib.request
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .events import located

RECORDS, SCORES = "_records", "scores"


@dataclass
class Written(WriterCommitMessage):
    """(part, file, rows) of what one task wrote."""

    files: list[tuple[str, str, int]]


class LinesSink(DataSource):
    """Rows (part, line): each line goes to a file of its part. Options: path, token, parts (those that may be, by commas), rows: lines of a
    file, 0 for one file of a task and part, and replace: whether what was there before goes."""

    @classmethod
    def name(cls) -> str:
        return "lines_by_part"

    def schema(self) -> str:
        return "part string, line string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.token = options["path"].rstrip("/"), options["token"]
        self.parts, self.rows = options["parts"].split(","), int(options.get("rows", 0))
        self.replace = options.get("replace", "false") == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = located(self.path)
        open_: dict[str, list] = {}
        done: list[tuple[str, str, int]] = []

        def close(part: str) -> None:
            name, stream, n = open_.pop(part)
            stream.close()
            done.append((part, name, n))

        try:
            for b in iterator:
                for part in b.column(0).unique().to_pylist():
                    if part not in self.parts:
                        raise ValueError(f"{part} is none of {self.parts}")
                    lines = b.column(1).filter(pc.equal(b.column(0), part))
                    while len(lines):
                        if part not in open_:
                            name = f"{part}/{self.token}-{uuid.uuid4().hex}.jsonl"
                            system.create_dir(f"{root}/{part}", recursive=True)
                            open_[part] = [name, system.open_output_stream(f"{root}/{name}"), 0]
                        held = open_[part]
                        some = lines.slice(0, self.rows - held[2] if self.rows else len(lines))
                        held[1].write(("\n".join(some.to_pylist()) + "\n").encode())
                        held[2] += len(some)
                        lines = lines.slice(len(some))
                        if held[2] == self.rows:
                            close(part)
            for part in list(open_):
                close(part)
        except BaseException:
            for name, stream, _ in open_.values():
                stream.close()
                done.append(("", name, 0))
            self._remove([name for _, name, _ in done])
            raise
        return Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = located(self.path)
        record = f"{root}/{RECORDS}/{self.token}.jsonl"
        files = [f for m in messages if m is not None for f in m.files]
        if system.get_file_info(record).type != fs.FileType.NotFound:  # another attempt was first
            return self._remove([name for _, name, _ in files])
        for part in self.parts:
            system.create_dir(f"{root}/{part}", recursive=True)
        system.create_dir(f"{root}/{RECORDS}", recursive=True)
        fresh = f"{root}/{RECORDS}/.{self.token}-{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as f:
            for part, name, n in files:
                f.write((json.dumps({"part": part, "file": name, "rows": n}) + "\n").encode())
        system.move(fresh, record)
        known = {name for _, name, _ in files}
        if self.replace:
            for x in system.get_file_info(fs.FileSelector(f"{root}/{RECORDS}")):
                if x.path != record and not x.path.endswith(f"/{RECORDS}/{self.token}.jsonl"):
                    system.delete_file(x.path)
        for part in self.parts:
            for x in system.get_file_info(fs.FileSelector(f"{root}/{part}")):
                if (self.replace or x.base_name.startswith(f"{self.token}-")) and f"{part}/{x.base_name}" not in known and x.is_file:
                    system.delete_file(x.path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._remove([name for m in messages if m is not None for _, name, _ in m.files])

    def _remove(self, names: list[str]) -> None:
        system, root = located(self.path)
        for name in names:
            if system.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:
                system.delete_file(f"{root}/{name}")


def committed(path: str, token: str) -> bool:
    system, root = located(path.rstrip("/"))
    return system.get_file_info(f"{root}/{RECORDS}/{token}.jsonl").type != fs.FileType.NotFound


def write_lines(rows: DataFrame, path: str, token: str, parts: list[str], lines: int = 0, replace: bool = False) -> None:
    """rows: part, line. A batch that is there already costs nothing. replace: it takes the place of all batches before it."""
    if any("," in p or "/" in p or not p for p in parts) or not token or "/" in token:
        raise ValueError("parts and tokens are names")
    if committed(path, token):
        return
    rows.sparkSession.dataSource.register(LinesSink)
    rows.select("part", "line").write.format(LinesSink.name()).mode("append").option("path", path).option("token", token).option("parts", ",".join(parts)).option("rows", lines).option("replace", str(replace).lower()).save()


def write_decisions(scores: DataFrame, path: str, token: str, decisions: tuple[str, ...] = ("accept", "reject"), replace: bool = False) -> None:
    """SK3, SK4: a manifest for each decision and the whole score table, JSON lines with nulls, from one pass over the scores: a model
    behind them runs once. Another decision fails, and then nothing is written."""
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in scores.columns)), {"ignoreNullFields": "false"})
    other = F.raise_error(F.concat(F.lit("unknown decision "), F.coalesce(F.col("decision"), F.lit("null")))).cast("string")
    parts = F.array(F.when(F.col("decision").isin(*decisions), F.col("decision")).otherwise(other), F.lit(SCORES))
    write_lines(scores.select(line.alias("line"), parts.alias("parts")).select(F.explode("parts").alias("part"), "line"), path, token, [*decisions, SCORES], replace=replace)


def records(spark: SparkSession, path: str) -> DataFrame:
    """token, part, file, rows of all files that count."""
    found = spark.read.schema("part string, file string, rows long").json(f"{path.rstrip('/')}/{RECORDS}")
    return found.withColumn("token", F.regexp_extract(F.input_file_name(), r"([^/]+)\.jsonl$", 1))


def read_part(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    """The rows of one part: those of the files that some record lists."""
    names = [r.file for r in records(spark, path).where(F.col("part") == part).select("file").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json([f"{path.rstrip('/')}/{n}" for n in names])


def post_once(tasks: DataFrame, path: str, token: str, url: str, headers: dict[str, str] | None = None, size: int = 500, retries: int = 2) -> DataFrame:
    """SK13: sends tasks (line: JSON texts) to a service in lists of at most `size`: file, rows and status of each list.

    The lists are written first, once for a token, and then sent by tasks. A list that was sent leaves a mark, and is not sent again by
    another attempt; its key goes along, so that a service can tell a list whose mark was lost.
    """
    write_lines(tasks.select(F.lit("tasks").alias("part"), "line"), path, token, ["tasks"], size)
    sent = dict(headers or {})

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = located(path.rstrip("/"))
        system.create_dir(f"{root}/_sent", recursive=True)
        for f in frames:
            status = []
            for name in f["file"]:
                mark = f"{root}/_sent/{name.replace('/', '-')}"
                if system.get_file_info(mark).type != fs.FileType.NotFound:
                    status.append("there")
                    continue
                with system.open_input_stream(f"{root}/{name}") as s:
                    body = b"[" + s.read().strip().replace(b"\n", b",") + b"]"
                for k in range(retries + 1):
                    try:
                        request = urllib.request.Request(url, data=body, headers={"Content-Type": "application/json", "Idempotency-Key": name, **sent})
                        urllib.request.urlopen(request, timeout=120).close()
                        break
                    except OSError:
                        if k == retries:
                            raise
                        time.sleep(0.1 * 2**k)
                with system.open_output_stream(mark) as s:
                    s.write(b"sent")
                status.append("sent")
            yield f.assign(status=status)

    lists = records(tasks.sparkSession, path).where(F.col("token") == token).select("file", "rows")
    return lists.mapInPandas(send, "file string, rows long, status string")
