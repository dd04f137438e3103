"""Label files of datasets and the annotations they come from (SF13-SF15, SF17, JN8, PF16, PF25, SK7, SC16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import basename, stem
from ..functions.vision import coco_label_line, polygons, pose_label_line, segment_line


def pose_labels(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """SK7, PF16: image_id, file_name, label (the text of its label file) of every image with annotations, in the order of their ids.

    images: image_id, file_name, width, height; annotations: image_id, id, bbox, keypoints.
    """
    line = coco_label_line(F.col("bbox"), F.col("keypoints"), F.col("width"), F.col("height"))
    each = annotations.join(images, "image_id").select("image_id", "file_name", F.struct(F.col("id"), line.alias("line")).alias("l"))
    lines = F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"])
    return each.groupBy("image_id", "file_name").agg(F.concat(F.concat_ws("\n", lines), F.lit("\n")).alias("label"))


def predicted_labels(predictions: DataFrame, threshold: float) -> DataFrame:
    """SF13, PF25: sample_id, image_path, n_persons, label of predictions that can be used, and the reason why others cannot.

    predictions: sample_id, image_path, boxes (normalized cx cy w h), points, confidences (arrays by person) and error. skipped is null
    for rows that have a label.
    """
    person = F.arrays_zip(F.col("boxes").alias("b"), F.col("points").alias("p"), F.coalesce("confidences", F.transform("boxes", lambda _: F.lit(None).cast("array<double>"))).alias("c"))
    lines = F.transform(person, lambda x: pose_label_line(x["b"], x["p"], x["c"], threshold))
    skipped = F.when(F.col("error").isNotNull(), "error").when(F.coalesce(F.size("boxes"), F.lit(0)) <= 0, "no_boxes").when(F.coalesce(F.size("points"), F.lit(0)) <= 0, "no_keypoints")
    label = F.when(skipped.isNull(), F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return predictions.select("sample_id", "image_path", F.when(skipped.isNull(), F.size("boxes")).otherwise(0).alias("n_persons"), label.alias("label"), skipped.alias("skipped"), F.substring("error", 1, 500).alias("error"))


def skip_counts(labels: DataFrame) -> DataFrame:
    """PF25."""
    return labels.groupBy(F.coalesce("skipped", F.lit("written")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def segment_labels(tasks: DataFrame, files: DataFrame, classes: list[str]) -> DataFrame:
    """SF14, SF15, SC16, JN8: sample_id, image_path, label of every image with polygons of known classes.

    tasks: image (a reference), result, pos; files: path of every image that is there. Tasks meet images by base name; polygons of all
    tasks of an image are put together in order.
    """
    if not classes:
        raise ValueError("there must be a class")
    there = files.select(F.col("path").alias("image_path"), basename(F.col("path")).alias("name")).dropDuplicates(["name"])
    each = tasks.withColumn("name", basename(F.col("image"))).where("name <> ''").join(there, "name").select("image_path", "pos", polygons(F.col("result"), classes).alias("p")).where(F.size("p") > 0)
    lines = F.transform("p", lambda x: segment_line(x["label"], x["points"]))
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", lines.alias("l")))), lambda x: x["l"]))
    return each.groupBy(stem(F.col("image_path")).alias("sample_id")).agg(F.min("image_path").alias("image_path"), F.concat(F.array_join(whole, "\n"), F.lit("\n")).alias("label"))
