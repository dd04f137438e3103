"""The filter cascade on streams: the same expressions as in batches, windowed counts, and finite streams run to their end."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vision import margin
from ..operators.gate import margin_decision


def window_counts(events: DataFrame, every: str = "1 day", late: str = "60 days") -> DataFrame:
    """Events by window and type; ts is a timestamp without zone in the tables and is read as UTC. Events later than `late` are dropped,
    and the counts of windows before that are forgotten."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", every).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n")


def decisions(logits: DataFrame, threshold: float, top_k: int = 3) -> DataFrame:
    """AG3, PF4 on a stream of id, positive and negative (arrays): id, margin, decision. No state is kept."""
    m = margin(F.col("positive"), F.col("negative"), top_k)["margin"]
    return logits.select("id", m.alias("margin"), margin_decision(m, threshold).alias("decision"))


def stream_folder(spark: SparkSession) -> str:
    """A new name in the shared folder (spark.checkpoint.dir) for what a stream keeps."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='millrace-')).rstrip('/')}/stream-{uuid.uuid4().hex}"


def replay(stream: DataFrame, keys: list[str] | None = None, seconds: float | None = None, paced: bool = False, folder: str | None = None) -> DataFrame:
    """The rows that a finite stream gives until its end, written by the tasks to the shared folder, one folder for each batch, so that a
    batch that is run again replaces itself.

    Without keys the stream appends rows; with keys it updates them, and the last row of each key counts. seconds: how long that may
    take. paced: the source gives what it has in many batches, not at once. folder: of a replay that was begun before, to go on with it.
    """
    known = folder is not None
    spark, folder, written = stream.sparkSession, folder or stream_folder(stream.sparkSession), []

    def write(rows: DataFrame, number: int) -> None:
        rows.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/rows/{number}")
        written.append(number)

    writer = stream.writeStream.outputMode("update" if keys else "append").option("checkpointLocation", f"{folder}/state")
    writer = writer.foreachBatch(write)
    query = (writer if paced else writer.trigger(availableNow=True)).start()
    try:
        if paced:
            query.processAllAvailable()
        elif seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            raise TimeoutError(f"the stream did not end within {seconds} s")
    finally:
        query.stop()
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stream.schema)}, _batch int"
    found = spark.read.schema(schema).option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true").parquet(f"{folder}/rows") if written or known else spark.createDataFrame([], schema)
    if not keys:
        return found.drop("_batch")
    others = [c for c in stream.columns if c not in keys]
    last = found.groupBy(*keys).agg(F.max_by(F.struct(*others), "_batch").alias("_last"))
    return last.select(*(F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in stream.columns))
