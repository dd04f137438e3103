"""Quality gates and routing (PF3-PF5, PF9-PF13, PF15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import non_blank
from ..functions.vision import bbox_area_ratio, segmentation_area, valid_keypoints

ACTIONS = ("reject", "uncertain")


def margin_decision(margin: Column, threshold: float) -> Column:
    """PF4: accept from the threshold on; NaN and null are rejected."""
    return F.when((margin >= threshold) & ~F.isnan(margin), "accept").otherwise("reject")


def resolve_threshold(argument: float | None, report: dict | None, config: dict) -> tuple[float, str]:
    """PF5: the argument, then the report's best threshold, then the config; with where it came from."""
    for value, source in ((argument, "cli"), ((report or {}).get("best_threshold"), "report"), (config.get("threshold"), "config")):
        if value is not None:
            return float(value), source
    raise ValueError("no threshold is given")


def _reasons(*pairs: tuple[Column, str]) -> Column:
    return F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), name) for c, name in pairs)), lambda x: x.isNotNull())


def pose_gate(person: Column, pose: Column, width: Column, height: Column, area_override: Column | None = None, *, min_score: float = 0.25, min_keypoints: int = 12, keypoint_threshold: float = 0.5, min_area: float = 0.05, max_area: float = 1.0) -> Column:
    """PF9: struct of decision, reject_reasons, bbox_area_ratio, roi_source, valid_keypoints.

    The person's box counts if the person's score is enough, else that of the pose, whatever its score.
    """
    ok = lambda d: F.coalesce((d["score"] >= min_score) & ~F.isnan(d["score"]), F.lit(False))
    person_ok, pose_ok = ok(person), ok(pose)
    chosen = F.when(person_ok, person["box"]).otherwise(pose["box"])
    area = bbox_area_ratio(chosen, width, height)
    source = F.lit("bbox")
    if area_override is not None:
        area, source = F.coalesce(area_override, area), F.when(area_override.isNotNull(), "segmentation").otherwise("bbox")
    count = F.when(pose_ok, valid_keypoints(pose["keypoints"], keypoint_threshold)).otherwise(0)
    reasons = _reasons((~person_ok & ~pose_ok, "no_person_detected"), (area < min_area, "bbox_too_small"), (area > max_area, "bbox_too_large"), (pose_ok & (count < min_keypoints), "insufficient_keypoints"), (~pose_ok, "pose_missing"))
    decision = F.when(F.size(reasons) == 0, "accept").otherwise("reject")
    return F.struct(decision.alias("decision"), reasons.alias("reject_reasons"), area.alias("bbox_area_ratio"), source.alias("roi_source"), count.alias("valid_keypoints"))


def single_gate(box: Column, keypoints: Column, width: Column, height: Column, *, min_keypoints: int = 12, keypoint_threshold: float = 0.5, min_area: float = 0.05, max_area: float = 1.0) -> Column:
    """PF10: one detection, without checks of presence."""
    area, count = bbox_area_ratio(box, width, height), valid_keypoints(keypoints, keypoint_threshold)
    reasons = _reasons((area < min_area, "bbox_too_small"), (area > max_area, "bbox_too_large"), (count < min_keypoints, "insufficient_keypoints"))
    return F.struct(F.when(F.size(reasons) == 0, "accept").otherwise("reject").alias("decision"), reasons.alias("reject_reasons"), area.alias("bbox_area_ratio"), count.alias("valid_keypoints"))


def route(reasons: Column, actions: dict[str, str]) -> Column:
    """PF12: accept without reasons; reject if any reason is one to reject or unknown; else uncertain. Bad actions fail at once."""
    for reason, action in actions.items():
        if action not in ACTIONS:
            raise ValueError(f"{reason}: {action} is no action")
    soft = F.array(*(F.lit(r) for r, a in actions.items() if a == "uncertain")).cast("array<string>")
    return F.when(F.size(reasons) == 0, "accept").when(F.forall(reasons, lambda r: F.array_contains(soft, r)), "uncertain").otherwise("reject")


def size_reasons(width: Column, height: Column, *, max_width: int = 0, max_height: int = 0, max_long_edge: int = 0) -> Column:
    """PF15: what is too large, comma-joined; 0 is no limit, a negative limit fails."""
    if min(max_width, max_height, max_long_edge) < 0:
        raise ValueError("limits must not be negative")
    each = [(width, max_width, "width"), (height, max_height, "height"), (F.greatest(width, height), max_long_edge, "long_edge")]
    return F.concat_ws(",", *(F.when(c > most, f"{name}>{most}") for c, most, name in each if most))


def failed(reason: str, min_keypoints: int = 12, keypoint_threshold: float = 0.5) -> Column:
    """PF13: the result of a row whose image or model failed: rejected for that reason, with zeros."""
    return F.struct(F.lit("reject").alias("decision"), F.lit("reject").alias("raw_gate_decision"), F.lit(0.0).alias("person_score"), F.lit(0.0).alias("pose_score"), F.lit(0.0).alias("bbox_area_ratio"), F.lit("none").alias("roi_source"), F.lit(0).alias("valid_keypoints"), F.lit(min_keypoints).alias("min_keypoints"), F.lit(keypoint_threshold).alias("keypoint_score_threshold"), F.array(F.lit(reason)).alias("reject_reasons"))


def gated_rows(rows: DataFrame, actions: dict[str, str], *, min_score: float = 0.25, min_keypoints: int = 12, keypoint_threshold: float = 0.5, min_area: float = 0.05, max_area: float = 1.0) -> DataFrame:
    """PF3, PF9, PF11-PF13: the second filter's score table.

    rows: sample_id, image_path, width, height, person, pose (detections or null), and the error of each step, null if it went well:
    image_error, pose_error, detection_error; area (a text or null) overrides the box. The first error decides.
    """
    ok = pose_gate(F.col("person"), F.col("pose"), F.col("width"), F.col("height"), segmentation_area(F.col("area")), min_score=min_score, min_keypoints=min_keypoints, keypoint_threshold=keypoint_threshold, min_area=min_area, max_area=max_area)
    score = lambda d: F.coalesce(F.col(f"{d}.score"), F.lit(0.0))
    gate = rows.withColumn("g", ok)
    good = F.struct(route(F.col("g.reject_reasons"), actions).alias("decision"), F.col("g.decision").alias("raw_gate_decision"), score("person").alias("person_score"), score("pose").alias("pose_score"), F.col("g.bbox_area_ratio"), F.col("g.roi_source"), F.col("g.valid_keypoints"), F.lit(min_keypoints).alias("min_keypoints"), F.lit(keypoint_threshold).alias("keypoint_score_threshold"), F.col("g.reject_reasons"))
    bad = lambda reason: failed(reason, min_keypoints, keypoint_threshold)
    out = F.when(F.col("image_error").isNotNull(), bad("image_read_error")).when(F.col("pose_error").isNotNull(), bad("pose_inference_error")).when(F.col("detection_error").isNotNull(), bad("detection_inference_error")).otherwise(good)
    return gate.select("sample_id", "image_path", out.alias("r")).select("sample_id", "image_path", "r.*")


def anchors_by_size(rows: DataFrame, files: DataFrame | None, path_field: str, **limits: int) -> DataFrame:
    """PF15: rows with reason, blank for those that stay: missing_path_field:X, missing_file, or what is too large.

    rows: width, height and the path field; files: path of every file that is there (None: all are).
    """
    path = non_blank(F.col(path_field))
    there = F.lit(True)
    if files is not None:
        rows = rows.join(files.select(F.col("path").alias(path_field), F.lit(True).alias("_there")).distinct(), path_field, "left")
        there = F.coalesce("_there", F.lit(False))
    reason = F.when(path.isNull(), f"missing_path_field:{path_field}").when(~there, "missing_file").otherwise(size_reasons(F.col("width"), F.col("height"), **limits))
    return rows.withColumn("reason", reason).drop("_there")


def anchor_stats(rows: DataFrame) -> DataFrame:
    """PF15: how many there were, stay, and go by reason."""
    count = lambda c: F.count(F.when(c, 1))
    r = F.col("reason")
    return rows.agg(F.count(F.lit(1)).alias("total"), count(r == "").alias("kept"), count(r == "missing_file").alias("missing_file"), count(r.startswith("missing_path_field")).alias("missing_path_field"), count(r.contains(">")).alias("too_large"))


def decision_counts(rows: DataFrame, column: str = "decision") -> DataFrame:
    """AG10."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
