"""SC14, SC13: a service's log of events as a stream: files of rows that are only ever added, read by ranges of rows.

An offset is a number of rows from the start of the log, its files taken in the order of their names. The reader is told where each batch
begins and ends by Spark, which logs that before the batch runs: a batch that is run again reads the same rows, so that every event
comes once however often the query dies. Tasks read their ranges of row groups; nothing passes through the driver but counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


#: Rows of one task of a batch.
TASK_ROWS = 250_000


class Log:
    """The files of a log and the rows before each; footers are read once, as files don't change."""

    def __init__(self, path: str):
        self.fs, self.path = located(path)
        self.sizes: dict[str, int] = {}

    def files(self) -> list[tuple[str, int, int]]:
        """(file, first row, row after the last) in order."""
        info = self.fs.get_file_info(self.path)
        names = [self.path] if info.is_file else sorted(x.path for x in self.fs.get_file_info(fs.FileSelector(self.path)) if x.is_file and x.base_name.endswith(".parquet") and x.base_name[0] not in "._")
        out, at = [], 0
        for name in names:
            if name not in self.sizes:
                with self.fs.open_input_file(name) as f:
                    self.sizes[name] = pq.read_metadata(f).num_rows
            out.append((name, at, at + self.sizes[name]))
            at += self.sizes[name]
        return out

    def ranges(self, start: int, end: int, parts: int) -> list[Rows]:
        """[start, end) in so many nearly equal ranges, or in more of at most TASK_ROWS, each with the files that it touches."""
        parts = max(parts, -(-(end - start) // TASK_ROWS))
        edges = [start + (end - start) * k // parts for k in range(parts + 1)]
        files = self.files()
        return [Rows([(n, max(a, x) - a, min(z, y) - a) for n, a, z in files if a < y and z > x]) for x, y in zip(edges[:-1], edges[1:], strict=True) if x < y]


class Rows(InputPartition):
    """(file, first row, row after the last) of each piece of a range."""

    def __init__(self, pieces: list[tuple[str, int, int]]):
        super().__init__(pieces)
        self.pieces = pieces


def read_rows(path: str, pieces: list[tuple[str, int, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of a range: of each file only the row groups and columns that it touches."""
    system, _ = located(path)
    for name, start, end in pieces:
        with system.open_input_file(name) as f:
            file, at = pq.ParquetFile(f), 0
            for g in range(file.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                if at < end and at + n > start:
                    row = at
                    for b in file.iter_batches(10_000, row_groups=[g], columns=schema.names):
                        a, z = max(start - row, 0), min(end - row, b.num_rows)
                        if a < z:
                            yield pa.RecordBatch.from_arrays([b.column(c).slice(a, z - a).cast(schema.field(c).type) for c in schema.names], schema=schema)
                        row += b.num_rows
                        if row >= end:
                            break
                at += n


class EventSource(DataSource):
    """Options: path (a Parquet file, or a folder of them); partitions: tasks of a batch, more where each would have over TASK_ROWS rows;
    rows: most of a batch, with mark: a file in a shared folder where the reader keeps how far batches were planned, so that one that is
    started again goes on at the same pace; batches: a log that is longer than so many of them is read in so many larger ones, since each
    costs seconds whatever it holds."""

    @classmethod
    def name(cls) -> str:
        return "job_events"

    def schema(self) -> str:
        raise ValueError("give the events' schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BatchReader(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options, schema)


def _arrow(schema: StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "timestamp_ntz": pa.timestamp("us"), "timestamp": pa.timestamp("us", "UTC"), "binary": pa.binary()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


class _Reader:
    def __init__(self, options, schema: StructType):
        self.path, self.parts, self.arrow = options["path"], int(options.get("partitions", 4)), _arrow(schema)

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        return read_rows(self.path, part.pieces, self.arrow)


class _BatchReader(_Reader, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        log = Log(self.path)
        files = log.files()
        return log.ranges(0, files[-1][2] if files else 0, self.parts) or [Rows([])]


class _StreamReader(_Reader, DataSourceStreamReader):
    def __init__(self, options, schema: StructType):
        super().__init__(options, schema)
        self.most, self.mark, self.batches = int(options.get("rows", 0)), options.get("mark"), int(options.get("batches", 0))
        if self.most and not self.mark:
            raise ValueError("a pace needs a mark")
        self.log = Log(self.path)

    def _planned(self) -> int:
        system, path = located(self.mark)
        if not system.get_file_info(path).is_file:
            return 0
        with system.open_input_file(path) as f:
            return json.loads(f.read())["row"]

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        """All that is there, or, at a pace, so many rows beyond what was planned. A batch is planned before another is asked for, also
        after a restart, so that this never falls behind what Spark has logged."""
        files = self.log.files()
        there = files[-1][2] if files else 0
        most = max(self.most, -(-there // self.batches)) if self.batches else self.most
        return {"row": min(there, self._planned() + most) if most else there}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.mark and end["row"] > self._planned():
            system, path = located(self.mark)
            fresh = f"{path}.{uuid.uuid4().hex}"
            with system.open_output_stream(fresh) as f:
                f.write(json.dumps(end).encode())
            system.move(fresh, path)
        return self.log.ranges(start["row"], end["row"], self.parts)

    def commit(self, end: dict) -> None:
        """Nothing is kept for rows that are done: the log is the service's."""


def register(spark: SparkSession) -> None:
    spark.dataSource.register(EventSource)


def stream_of(spark: SparkSession, path: str, schema: StructType, folder: str, rows: int = 0, partitions: int = 4, batches: int = 0):
    """The log as a stream, in batches of at most so many rows (0: all that is there); folder: a shared one of this stream alone. batches:
    of a log that is longer than so many batches, each holds its share (0: of as many as there are)."""
    register(spark)
    read = spark.readStream.format(EventSource.name()).schema(schema).option("path", path).option("partitions", partitions)
    return (read.option("rows", rows).option("batches", batches).option("mark", f"{folder}-planned.json") if rows else read).load()


def in_order(events: DataFrame, time: str, folder: str) -> str:
    """The path of a log of these events in the order of a time, written by ranges to a shared folder: a log that was put together from
    several begins anew in each, and what is later than a watermark allows would be lost."""
    path = f"{folder}-log"
    events.repartitionByRange(F.col(time), F.xxhash64(*events.columns)).sortWithinPartitions(time).write.parquet(path)
    return path
