"""Threshold calibration (AG4-AG9, WN1): one cumulative pass over the different margins instead of one pass for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .relational import fixed


def checked(scores: DataFrame, score: str = "margin", label: str = "label") -> DataFrame:
    """AG9: fails on null or NaN scores and labels other than 0 and 1, and on an empty table."""
    if scores.isEmpty():
        raise ValueError("scores must not be empty")
    ok = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isin(0, 1)
    return scores.where(F.coalesce(ok, F.lit(False)) | F.raise_error(F.lit("scores must be numbers and labels 0 or 1")).cast("boolean"))


def metrics(tp, fp, fn) -> list:
    """AG5: precision, recall and F1; 0 where the denominator is 0."""
    safe = lambda n, d: F.when(d > 0, n.cast("double") / d).otherwise(0.0)
    p, r = safe(tp, tp + fp), safe(tp, tp + fn)
    return [p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1")]


def sweep(scores: DataFrame, score: str = "margin", label: str = "label") -> DataFrame:
    """AG6: threshold, tn, fp, fn, tp, precision, recall, f1 for every different score, at which score >= threshold accepts.

    Equal scores are counted first, so that the running sums only see different ones. These are dealt to ranges, summed up within each
    range and raised by the sums of the ranges above it, so that no task sees them all.
    """
    each = checked(scores, score, label).groupBy(F.col(score).alias("threshold")).agg(F.sum(label).alias("pos"), F.count(label).alias("n"))
    ranges = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = fixed(each.repartitionByRange(ranges, F.desc("threshold")).withColumn("_range", F.spark_partition_id()))
    down = Window.partitionBy("_range").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    above, every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    sums = dealt.groupBy("_range").agg(F.sum("pos").alias("p"), F.sum("n").alias("c"))
    before = sums.select("_range", *(F.coalesce(F.sum(x).over(above), F.lit(0)).alias(f"{x}_above") for x in "pc"), F.sum("p").over(every).alias("all_pos"), F.sum("c").over(every).alias("all_n"))
    run = dealt.join(F.broadcast(before), "_range").select("threshold", (F.sum("pos").over(down) + F.col("p_above")).alias("tp"), (F.sum("n").over(down) + F.col("c_above")).alias("taken"), "all_pos", "all_n")
    counted = run.select("threshold", (F.col("all_n") - F.col("all_pos") - F.col("taken") + F.col("tp")).alias("tn"), (F.col("taken") - F.col("tp")).alias("fp"), (F.col("all_pos") - F.col("tp")).alias("fn"), "tp")
    return counted.select("*", *metrics(F.col("tp"), F.col("fp"), F.col("fn")))


def best_f1(swept: DataFrame) -> DataFrame:
    """AG7: greatest F1, then recall, then precision, then the smaller threshold."""
    return swept.orderBy(F.desc("f1"), F.desc("recall"), F.desc("precision"), F.asc("threshold")).limit(1)


def best_at_min_precision(swept: DataFrame, least: float, required: bool = False) -> DataFrame:
    """AG8: of those with enough precision greatest recall, then F1, then precision, then the smaller threshold; if none has, the table
    is empty, or it fails if one is required."""
    if not 0 <= least <= 1:
        raise ValueError("min_precision must be within 0 and 1")
    if required and swept.where(F.col("precision") >= least).isEmpty():
        raise ValueError("no threshold reaches min_precision")
    return swept.where(F.col("precision") >= least).orderBy(F.desc("recall"), F.desc("f1"), F.desc("precision"), F.asc("threshold")).limit(1)
