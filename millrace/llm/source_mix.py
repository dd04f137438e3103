"""Mixing sources to target weights by Pareto order sampling.

1. Sizes are counted in one pass over the texts; what follows reads ids, sizes and keys only.
2. Each source gets its target: its weight's share of the mix, at most `most` times its size; what that cuts off is shared by weight
   among the others. In whole numbers, so that targets don't depend on the order of any sum.
3. Every document is taken floor(target / size of the source) times: certain whole copies. What is left of the target is a sample. A
   document's inclusion probability p is the rest's share of its source, times its relative weight where one is given; those with
   p >= 1 come first. Documents are ranked by U/(1-U) over p/(1-p), U uniform and drawn from a hash, and the first ones whose words fill
   the rest are the sample: its size is fixed in words, since targets are given in words. The rank is cut without sorting a source:
   words are summed by ranges of the rank, the range where the rest ends is cut into ranges again, and only a range of few documents
   is sorted. One more document is taken where that brings the words nearer to the target.

Defined results: null and empty texts have size 0; a null source is a source, the last one; without words in a source its target is 0;
rows that are repeated are documents of their own, and each run takes as many of them; a null, negative or NaN weight counts as 0, so
that its documents come last; a document is taken floor(target / size of its source) or one more times, so never more than `most` times;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Bits that one step cuts a range of ranks into, and documents of a range that may be sorted together.
STEP, FEW = 12, 4096
#: Sources whose table may go to every task whole; beyond that it is joined by salted keys.
SMALL = 1 << 16
#: One of relative weights.
ONE = 1 << 20


def targets(sources: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """s (1, 2, ... by code point, null last), source, source_size, and the target num / den in whole numbers. One row for each source.

    A source is cut to most * size if its share is larger. In the order of size over weight these are the first ones, so that a
    running sum tells what is left for a source and those after it.
    """
    wide = lambda x: (F.col(x) if isinstance(x, str) else x).cast("decimal(38,0)")
    t = sources.withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    t = t.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("s") - 1) % len(weights) + 1).cast("int")).cast("long"))
    order = Window.orderBy(wide("source_size") * F.element_at(F.create_map(*(F.lit(x).cast("long") for w in set(weights) for x in (w, math.lcm(*weights) // w))), F.col("weight")), "s")
    every, size = Window.partitionBy(), wide("source_size")
    t = t.withColumns({"before": F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "left": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)), "all": F.sum(size).over(every)})
    cut = F.col("weight") * wide(percent * F.col("all") - 100 * most * F.col("before")) > wide("left") * (100 * most) * size
    t = t.withColumn("cut", cut)
    t = t.withColumns({"held": F.coalesce(F.sum(F.when(F.col("cut"), size)).over(every), F.lit(0)), "free": F.coalesce(F.sum(F.when(~F.col("cut"), F.col("weight"))).over(every), F.lit(1))})
    num = F.when(F.col("cut"), wide(most * size)).otherwise(wide(F.col("weight") * wide(percent * F.col("all") - 100 * most * F.col("held"))))
    den = F.when(F.col("cut"), F.lit(1)).otherwise(100 * F.col("free"))
    return t.select("s", "source", "source_size", num.alias("num"), wide(den).alias("den"))


def _joined(docs: DataFrame, table: DataFrame, on: Column, small: bool) -> DataFrame:
    """docs with what the table has of their sources, in one row each; a hot source is never one task's."""
    if small:
        return docs.join(F.broadcast(table), on, "left")
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(31))))
    return docs.withColumn("_salted", F.pmod(F.xxhash64("row"), F.lit(32)).cast("int")).join(salted, on & (F.col("_salted") == F.col("_salt")), "left").drop("_salt", "_salted")


def _digits() -> list[Column]:
    """The order of the documents of a source, from place, u and h, in digits of STEP bits."""
    return [F.shiftright(c, at).bitwiseAND((1 << STEP) - 1).cast("int") for c in ("place", "u", "h") for at in (36, 24, 12, 0)]


def _cut(ranked: DataFrame, rest: DataFrame, small: bool, few: int) -> DataFrame:
    """t, path, last, gap of each source: documents whose digits come before the path are in, those on it up to `last`; the gap is left."""
    digits = _digits()
    state = rest.select(F.col("s").alias("t"), F.array().cast("array<int>").alias("path"), F.col("rest").alias("gap"))
    for depth, digit in enumerate(digits, 1):
        there = _joined(ranked, state, F.col("s") == F.col("t"), small).where(F.array(*digits[: depth - 1]).cast("array<int>") == F.col("path"))
        ranges = there.groupBy("s", digit.alias("digit")).agg(F.sum("size").alias("words"), F.count("row").alias("n"))
        running = ranges.withColumn("upto", F.sum("words").over(Window.partitionBy("s").orderBy("digit")))
        ends = _joined(running.withColumn("row", F.lit(0)), state, F.col("s") == F.col("t"), True).where(F.col("upto") > F.col("gap"))
        ends = ends.groupBy("s").agg(F.min(F.struct("digit", (F.col("upto") - F.col("words")).alias("before"), "n")).alias("x"))
        beyond = F.lit(1 << STEP)  # no digit comes after it: all documents are in
        state = state.join(ends, F.col("s") == F.col("t"), "left").select("t", F.concat("path", F.array(F.coalesce("x.digit", beyond))).alias("path"), (F.col("gap") - F.coalesce("x.before", F.lit(0))).alias("gap"), F.coalesce("x.n", F.lit(0)).alias("n"))
        state = stored(state)
        most = state.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        state = state.drop("n")
        if most <= few:
            break
    order = F.struct("place", "u", "h", "row")
    there = _joined(ranked, state, F.col("s") == F.col("t"), small).where(F.array(*digits[:depth]) == F.col("path"))
    late = there.withColumn("upto", F.sum("size").over(Window.partitionBy("s").orderBy("place", "u", "h", "row").rowsBetween(Window.unboundedPreceding, 0))).where(F.col("upto") <= F.col("gap"))
    late = late.groupBy("s").agg(F.max(order).alias("last"), F.sum("size").alias("words"))
    return stored(state.join(late, F.col("s") == F.col("t"), "left").select("t", "path", "last", (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap")))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2, seed: int = 13, weight: Column | None = None, few: int = FEW) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of each document the mix takes, repeats counted.

    The sources share `percent` of all words by their weights; weight: relative inclusion odds of the documents of one source.
    """
    if not weights or any(w < 1 for w in weights) or percent < 0 or percent > 100 * most:
        raise ValueError("weights must be positive, and the mix at most `most` times its sources")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    w = F.lit(1.0) if weight is None else weight.cast("double")
    w = F.when(w.isNull() | F.isnan(w) | (w < 0), 0.0).otherwise(F.least(w, F.lit(float(ONE))))
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text.cast("binary"))))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.conv(F.substring(drawn, 1, 12), 16, 10).cast("long").alias("u"), F.floor(w * ONE).cast("long").alias("w"))
    sized = stored(sized.withColumn("row", F.monotonically_increasing_id()))
    sums = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size").cast("decimal(38,0)") * F.col("w")).cast("double").alias("weighed")))
    small = sums.count() <= SMALL
    shared = targets(sums.select("source", "source_size"), weights, percent, most).withColumnRenamed("source", "name")
    table = sums.join(shared.drop("source_size"), F.col("source").eqNullSafe(F.col("name")))
    copies = F.when(F.col("source_size") > 0, F.expr("num div (den * source_size)")).otherwise(0).cast("long")
    target = F.col("num").cast("double") / F.col("den").cast("double")
    table = stored(table.select("s", "name", "source_size", target.alias("target"), "weighed", copies.alias("copies"), F.round(target - copies * F.col("source_size")).cast("long").alias("rest")))
    # the rank as a whole number: larger odds give no smaller one
    p = F.when((F.col("rest") > 0) & (F.col("weighed") > 0), F.col("rest") * F.col("w") / F.col("weighed")).otherwise(0.0)
    uniform = (F.col("u") + 0.5) / float(1 << 48)
    odds = F.when(p >= 1, 0.0).when(p <= 0, float("inf")).otherwise(uniform / (1 - uniform) / (p / (1 - p)))
    place = F.least(F.floor((1 - 1 / (1 + odds)) * float(1 << 48)), F.lit((1 << 48) - 1)).cast("long")
    ranked = _joined(sized, table, F.col("source").eqNullSafe(F.col("name")), small)
    ranked = stored(ranked.select("s", "row", "doc_id", "size", "u", "source_size", "target", "copies", place.alias("place"), F.xxhash64("row").bitwiseAND((1 << 48) - 1).alias("h")))
    state = _cut(ranked, table.where("rest > 0").select("s", "rest"), small, few)
    chosen = _joined(ranked, state, F.col("s") == F.col("t"), small)
    depth = state.agg(F.coalesce(F.max(F.size("path")), F.lit(0))).first()[0]
    digits = F.array(*_digits()[:depth]).cast("array<int>")
    taken = (digits < F.col("path")) | ((digits == F.col("path")) & (F.struct("place", "u", "h", "row") <= F.col("last")))
    chosen = chosen.withColumn("sampled", F.coalesce(taken, F.lit(False)))
    # one more where that is nearer to the target, the one that comes nearest
    nearer = chosen.where(~F.col("sampled") & (F.col("size") > 0) & (F.col("size") < 2 * F.col("gap")))
    extra = nearer.groupBy("s").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "u", "doc_id", "size", "row")).alias("x"))
    extra = stored(extra.select(F.col("s").alias("es"), F.col("x.row").alias("extra")))
    out = _joined(chosen, extra, F.col("s") == F.col("es"), small)
    more = (F.col("sampled") | F.coalesce(F.col("extra") == F.col("row"), F.lit(False))).cast("long")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("copies") + more)).alias("taken"))
