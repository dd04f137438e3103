"""Reports and feedback (AG12-AG16, AG23, AG24, SL1, SL5, PF22, PF23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decimals import rounded
from ..functions.scalar import clamp, ratio


def slice_means(scores: DataFrame) -> DataFrame:
    """AG13: mean score of real and synthetic rows, 0 where there are none."""
    mean = lambda s: F.coalesce(F.avg(F.when(F.col("source") == s, F.col("score"))), F.lit(0.0))
    return scores.agg(mean("real").alias("real_mean"), mean("synthetic").alias("synthetic_mean"))


def metric_formulas(train_metric: Column, real_mean: Column, synthetic_mean: Column) -> Column:
    """AG14: struct of the four metrics, each within its bounds and rounded to 4 places."""
    bound = lambda c, low=0.0: rounded(clamp(c, low, 1.0), 4)
    map50 = bound(0.4 + train_metric * 0.5 + real_mean * 0.08)
    return F.struct(map50.alias("map50"), bound(map50 - 0.13).alias("map50_95"), bound(0.35 + train_metric * 0.4 + synthetic_mean * 0.12).alias("iou_mean"), bound(0.35 - train_metric * 0.25, 0.01).alias("calibration_error"))


def hard_cases(scores: DataFrame, k: int = 5) -> DataFrame:
    """SL1, PF22: the k lowest scores, earlier rows first among equals."""
    return scores.orderBy("score", "pos").limit(k).select("sample_id", "source", F.lit("low_asf_score").alias("reason"), "score")


def mix_report(rows: DataFrame) -> DataFrame:
    """AG15."""
    count = lambda s: F.count(F.when(F.col("source") == s, 1))
    total = rows.agg(F.count(F.lit(1)).alias("total"), count("real").alias("real"), count("synthetic").alias("synthetic"))
    return total.select("*", ratio(F.col("real"), F.col("total")).alias("real_ratio"), ratio(F.col("synthetic"), F.col("total")).alias("synthetic_ratio"))


def train_metric(n: Column, real_ratio: Column) -> Column:
    """AG16."""
    return clamp(rounded(0.5 + F.least(n / 100, F.lit(0.35)) - 0.15 * F.abs(real_ratio - 0.5), 4), 0, 0.99)


def policy(value: Column, target: float, threshold: Column) -> Column:
    """AG23: struct of action and the next threshold."""
    low = value < target
    step = F.when(low, threshold + 0.05).otherwise(threshold - 0.03)
    return F.struct(F.when(low, "tighten_filter").otherwise("relax_filter").alias("action"), rounded(F.greatest(F.lit(0.0), F.least(F.lit(1.0), step)), 4).alias("next_threshold"))


def seg_policy(value: Column, target: float = 0.65) -> Column:
    """AG24: the action alone."""
    return policy(value, target, F.lit(0.0))["action"]


def preview(rows: DataFrame, order: str, n: int = 20) -> DataFrame:
    """SL5: the first rows, for a report."""
    return rows.orderBy(order).limit(n)


def resolution_stats(rows: DataFrame) -> DataFrame:
    """AG12; what lacks a label is in preview(rows.where('label is null'), ...)."""
    return rows.agg(*(f(c).alias(f"{name}_{c}") for c in ("width", "height") for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max))), F.count("label").alias("with_label"), F.count(F.when(F.col("label").isNull(), 1)).alias("without_label"))


def source_counts(rows: DataFrame, column: str = "name") -> DataFrame:
    """PF23: files by prefix; path_sources decides where no name has one."""
    return rows.agg(F.count(F.when(F.col(column).startswith("real_"), 1)).alias("real"), F.count(F.when(F.col(column).startswith("synth_"), 1)).alias("synthetic"), F.count(F.lit(1)).alias("total"))


def path_sources(rows: DataFrame, dataset_path: str, column: str = "name") -> DataFrame:
    """PF23: as source_counts; where no name has a prefix, all files are real if the dataset's path says so, else synthetic."""
    whole = "real" if "real_train_anchor" in dataset_path or "real_dataset" in dataset_path else "synthetic"
    none = (F.col("real") == 0) & (F.col("synthetic") == 0)
    return source_counts(rows, column).select(*(F.when(none & F.lit(whole == s), F.col("total")).otherwise(F.col(s)).alias(s) for s in ("real", "synthetic")), "total")
