"""The stages of a round over DataFrames (OR1, UD7, UD13), for plans.Runner. Settings are plain values; models are given as functions.

Each stage takes (spark, settings, rows) and gives rows; rows are those of the stage before, null for the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import labels as L
from ..operators import manifests as M
from ..operators import relational as R
from ..operators.scoring import margin_rows
from ..sources import read_manifest

REAL = "sample_id string, image_path string, source string, width int, height int, label_path string, pos long"


def dataloader(spark: SparkSession, settings: dict, rows: DataFrame | None) -> DataFrame:
    """Real rows of a manifest, up to max_samples; only those with a label where labels are required."""
    real = read_manifest(spark, settings["manifest"], REAL)
    kept = real.where(F.col("label_path").isNotNull()) if settings.get("require_labels") else real
    return R.limited(kept, int(settings.get("max_samples", 0)), "pos")


def generate(spark: SparkSession, settings: dict, rows: DataFrame | None) -> DataFrame:
    """Planned synthetic rows: synth_per_real for each real row, with their seeds and lineage."""
    plan = R.stub_plan(rows, int(settings.get("synth_per_real", 1)), int(settings.get("seed_base", 0)), int(settings.get("max_synth_samples", 0)))
    name = F.concat_ws("_", F.lit("synth"), "sample_id", F.col("k").cast("string"))
    made = plan.select(name.alias("sample_id"), F.concat(name, F.lit(".png")).alias("image_path"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), "seed", F.col("sample_id").alias("guide_image_id"))
    return M.trace_rows(made, settings.get("config_ref", ""), settings.get("guide_type", "prompt"), settings.get("prompt", ""))


def filtering(load: Callable[[], tuple[Callable, Callable]]):
    """The first filter with a model: margins of images against positive and negative texts."""

    def run(spark: SparkSession, settings: dict, rows: DataFrame | None) -> DataFrame:
        inputs = rows.select(F.col("synthetic_id").alias("sample_id"), F.col("synthetic_image_path").alias("image_path"))
        return margin_rows(inputs, load, settings["positive"], settings["negative"], float(settings["threshold"]), int(settings.get("top_k", 3)))

    return run


def train(spark: SparkSession, settings: dict, rows: DataFrame | None) -> DataFrame:
    """UD13: what was trained on: the accepted rows, up to max_train_samples, by source, and the stand-in for a metric."""
    used = R.limited(rows.where("decision = 'accept'"), int(settings.get("max_train_samples", 0)), "sample_id")
    report = E.mix_report(used.withColumn("source", F.when(F.col("sample_id").startswith("synth"), "synthetic").otherwise("real")))
    return report.withColumn("train_metric", E.train_metric(F.col("total"), F.col("real_ratio")))


def evaluation(spark: SparkSession, settings: dict, rows: DataFrame | None) -> DataFrame:
    """UD13: metrics of a trained round and what the filter should do next."""
    m = E.metric_formulas(F.col("train_metric"), F.lit(float(settings.get("real_mean", 0))), F.lit(float(settings.get("synthetic_mean", 0))))
    found = rows.select(m.alias("m")).select("m.*")
    return found.withColumn("policy", E.policy(F.col("map50"), float(settings.get("target_map50", 0.75)), F.lit(float(settings.get("accept_threshold", 0.6)))))


def annotation(spark: SparkSession, settings: dict, rows: DataFrame | None) -> DataFrame:
    """Label lines of predictions, and their split."""
    labels = L.predicted_labels(rows, float(settings.get("visibility_threshold", 0.5))).where("skipped is null")
    split = R.split_train_val(labels.select("sample_id").distinct(), "sample_id", float(settings.get("val_ratio", 0.2)), int(settings.get("seed", 42)))
    return labels.drop("skipped", "error").join(split, "sample_id")


def outside(run: Callable[[dict, DataFrame], dict], schema: str):
    """UD7: a stage whose work is not Spark's (training and validating a network): one row with its report."""

    def stage(spark: SparkSession, settings: dict, rows: DataFrame | None) -> DataFrame:
        return spark.createDataFrame([run(settings, rows)], schema)

    return stage


def stages(load: Callable[[], tuple[Callable, Callable]], trainer=None, validator=None) -> dict[str, Callable]:
    """OR1: the stages by name."""
    report = "model string, metric double"
    missing = lambda settings, rows: (_ for _ in ()).throw(RuntimeError("no network is given"))
    return {
        "dataloader": dataloader,
        "generate": generate,
        "filter": filtering(load),
        "train": train,
        "eval": evaluation,
        "annotation": annotation,
        "coco_to_yolo_pose": lambda spark, settings, rows: L.pose_labels(spark.read.parquet(settings["images"]), spark.read.parquet(settings["annotations"])),
        "build_mixed": lambda spark, settings, rows: R.mixed_dataset(spark.read.parquet(settings["real"]), spark.read.parquet(settings["synthetic"]), spark.read.parquet(settings["eval"]) if settings.get("eval") else None),
        "train_yolo_pose": outside(trainer or missing, report),
        "eval_yolo_pose": outside(validator or missing, report),
    }
