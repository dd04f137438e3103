"""Manifests and annotation documents (SC1-SC3, SC8, SK1, SF17). Files: files.py; image headers: images.py; what is written: sinks.py,
transaction.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .images import image_size as image_size


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SC1: JSON lines; blank lines are skipped, bad ones fail."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_manifest(rows: DataFrame, path: str, partition_by: str | None = None) -> None:
    """SK1, SK3, SK4: JSON lines with nulls, one folder for each decision if asked for."""
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(partition_by) if partition_by else writer).json(path)


def coco_tables(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """SC8: images and annotations of one COCO document."""
    document = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    return document.select(F.inline("images")), document.select(F.inline("annotations"))


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SC2: one row of a JSON document."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def flatten_annotations(tasks: DataFrame) -> DataFrame:
    """SF17: a row for each annotation of a task (id, annotations); tasks without any have one with has_annotation false."""
    return tasks.select(F.col("id").alias("task_id"), F.explode_outer("annotations").alias("annotation")).withColumn("has_annotation", F.col("annotation").isNotNull())
