"""Expressions over logits, boxes, keypoints, detections and labels (AG2-AG3, PF6-PF8, PF11, PF14, SF12-SF16, UD11)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .decimals import number_text, once
from .label_text import coco_lines

KEYPOINTS = 17


def top_k_mean(values: Column, k: int) -> Column:
    """AG2: the mean of the k greatest, added from the greatest down; null for an empty array."""
    if k <= 0:
        raise ValueError("k must be positive")
    best = F.slice(F.sort_array(values, asc=False), 1, k)
    return F.when(F.size(values) > 0, F.aggregate(best, F.lit(0.0), lambda a, x: a + x) / F.size(best))


def margin(positive: Column, negative: Column, k: int = 3) -> Column:
    """AG3: struct of pos_score, neg_score, margin and effective_k."""
    p, n = top_k_mean(positive, k), top_k_mean(negative, k)
    return F.struct(p.alias("pos_score"), n.alias("neg_score"), (p - n).alias("margin"), F.least(F.lit(k), F.size(positive)).alias("effective_k"))


def bbox_area_ratio(box: Column, width: Column, height: Column) -> Column:
    """PF6: not clamped to 1; 0 for a bad size or fewer than 4 coordinates; a null coordinate is 0."""
    at = lambda i: F.coalesce(F.get(box, F.lit(i)), F.lit(0.0))
    side = lambda i: F.greatest(F.lit(0.0), at(i + 2) - at(i))
    sound = (width > 0) & (height > 0) & (F.size(box) >= 4)
    return F.coalesce(F.when(sound, side(0) * side(1) / (width * height).cast("double")), F.lit(0.0))


def valid_keypoints(keypoints: Column, threshold: float) -> Column:
    """PF7: points with three values whose score reaches the threshold; NaN never does."""
    score = lambda k: F.coalesce(F.get(k, F.lit(2)), F.lit(-1.0))
    return F.coalesce(F.size(F.filter(keypoints, lambda k: (F.size(k) >= 3) & (score(k) >= threshold) & ~F.isnan(score(k)))), F.lit(0))


def best_detection(detections: Column, least: float, label: int = 1) -> Column:
    """PF8: the detection of the label with the greatest score of at least `least`; the first of equals; null if none."""
    fits = lambda d: (d["label"] == label) & (d["score"] >= least) & ~F.isnan(d["score"])
    ranked = F.transform(detections, lambda d, i: F.struct(d["score"].alias("score"), (-i).alias("turn"), d.alias("d")))
    return F.array_max(F.filter(ranked, lambda r: fits(r["d"])))["d"]


def segmentation_area(value: Column) -> Column:
    """PF11: within 0 and 1; null for what is no number."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), F.least(F.greatest(number, F.lit(0.0)), F.lit(1.0)))


def candidates(xyxy: Column, scores: Column, classes: Column, points: Column, confidences: Column) -> Column:
    """PF14: detections of class 0 with keypoints of x, y and confidence, which is 0 where it is missing."""
    joined = F.arrays_zip(xyxy.alias("box"), scores.alias("score"), classes.alias("cls"), points.alias("xy"), confidences.alias("conf"))
    point = lambda d: F.transform(d["xy"], lambda p, i: F.array(F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.coalesce(F.get(d["conf"], i), F.lit(0.0))))
    shape = lambda d: F.struct(F.lit(1).alias("label"), d["score"].alias("score"), d["box"].alias("box"), F.coalesce(point(d), F.array().cast("array<array<double>>")).alias("keypoints"))
    return F.transform(F.filter(joined, lambda d: d["cls"] == 0), shape)


def visible_keypoints(flat: Column) -> Column:
    """SF16: of x, y, v triples those with v above 0."""
    return F.size(F.filter(flat, lambda x, i: (i % 3 == 2) & (x > 0)))


def visibility(confidence: Column, threshold: float) -> Column:
    """SF13: 2 from the threshold on, 1 above 0, else 0."""
    sure = lambda least: least & ~F.isnan(confidence)  # noqa: E731  NaN is above every number here
    return F.when(sure(confidence >= threshold), 2).when(sure(confidence > 0), 1).otherwise(0)


def pose_label_line(box: Column, points: Column, confidences: Column, threshold: float) -> Column:
    """SF13: 0 cx cy w h and 17 keypoints of x y and visibility, all of them normalized already; missing confidences are 0."""
    at = lambda k, j: F.coalesce(F.get(F.get(points, k), F.lit(j)), F.lit(0.0))
    xy = F.flatten(F.transform(_places(), lambda k: F.array(at(k, 0), at(k, 1))))
    sure = F.transform(_places(), lambda k: visibility(F.coalesce(F.get(confidences, k), F.lit(0.0)), threshold))
    return _line(F.transform(F.concat(F.slice(box, 1, 4), xy), lambda v: number_text(v)), sure)


def segment_line(label: Column, flat: Column) -> Column:
    """SF15: class x y x y ... with six places."""
    return F.concat_ws(" ", label.cast("string"), F.concat_ws(" ", F.transform(flat, lambda v: number_text(v.cast("double")))))


def polygons(result: Column, classes: list[str]) -> Column:
    """SF14: of an annotation's results (array of type and value with polygonlabels and points) the polygons of known classes, in order:
    structs of class number and flat points. The first label counts; polygons with fewer than three sound points are left out."""
    number = F.create_map(*(x for k, c in enumerate(classes) for x in (F.lit(c), F.lit(k))))
    label = lambda r: F.try_element_at(number, F.get(r["value"]["polygonlabels"], F.lit(0)))
    made = F.transform(F.filter(result, lambda r: r["type"] == "polygonlabels"), lambda r: F.struct(label(r).alias("label"), polygon_points(r["value"]["points"]).alias("points")))
    return F.coalesce(F.filter(made, lambda p: p["label"].isNotNull() & p["points"].isNotNull()), F.array().cast("array<struct<label:int,points:array<double>>>"))


def cosine(a: Column, b: Column) -> Column:
    """UD11: the cosine of two vectors; null where one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def _unit(c: Column) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def _places() -> Column:
    return F.sequence(F.lit(0), F.lit(KEYPOINTS - 1))


def _line(texts: Column, seen: Column) -> Column:
    """0, the four texts of the box, and for each keypoint its two texts and its visibility; null where one of them is null."""

    def joined(both: Column) -> Column:
        t, s = both["texts"], both["seen"]
        points = F.transform(_places(), lambda k: F.concat(F.lit(" "), F.get(t, k * 2 + 4), F.lit(" "), F.get(t, k * 2 + 5), F.lit(" "), F.get(s, k).cast("string")))
        whole = F.concat(F.lit("0 "), F.concat_ws(" ", F.slice(t, 1, 4)), F.array_join(points, ""))
        return F.when((F.size(t) == 4 + 2 * KEYPOINTS) & ~F.exists(t, lambda x: x.isNull()), whole)

    return once(F.struct(texts.alias("texts"), seen.alias("seen")), joined)


def coco_label_line(box: Column, flat: Column, width: Column, height: Column) -> Column:
    """SF12: 0 cx cy w h and 17 keypoints of x y v, normalized and within 0 and 1; null where the box or the size lacks a number.

    38 numbers of exact text a line: made by whole Arrow batches (label_text.py), as lambdas of expressions are interpreted one by one.
    """

    @F.arrow_udf("string")
    def line(b: pa.Array, k: pa.Array, w: pa.Array, h: pa.Array) -> pa.Array:
        return coco_lines(b, k, w, h)

    return line(box.cast("array<double>"), flat.cast("array<double>"), width.cast("double"), height.cast("double"))


def polygon_points(points: Column) -> Column:
    """SF14: percent to 0..1, flat; points with fewer than two values are left out, fewer than three points give null."""
    sound = F.filter(points, lambda p: F.size(p) >= 2)
    flat = F.flatten(F.transform(sound, lambda p: F.array(_unit(F.get(p, F.lit(0)) / 100), _unit(F.get(p, F.lit(1)) / 100))))
    return F.when(F.size(sound) >= 3, flat)
