"""Joins, splits, unions and numbering (JN1-JN8, PF16-PF18, SO1-SO6, WN2-WN6, SC8, AG11, AG17, AG18, AG20-AG22, AG25, SL2, SL3, OR13)."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import basename, non_blank, padded_id, stem


def first_of_each(rows: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key in a complete order (JN4, AG25, WN6)."""
    return rows.withColumn("_turn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_turn = 1").drop("_turn")


def annotation_counts(annotations: DataFrame, key: str) -> DataFrame:
    """SC8, AG11."""
    return annotations.groupBy(key).agg(F.count(F.lit(1)).alias("n_annotations"))


def resolve_label(images: DataFrame, coco: DataFrame, counts: DataFrame, path: str = "image_path") -> DataFrame:
    """JN1: images with coco_image_id and n_annotations by file name or base name, and by stem only where no name matches.

    coco: id, file_name; counts: image_id, n_annotations. A match must be one id with annotations, or the columns are null.
    """
    names = coco.select(F.explode(F.array_distinct(F.array("file_name", basename(F.col("file_name"))))).alias("_name"), "id").groupBy("_name").agg(F.min("id").alias("_name_id"), F.max("id").alias("_name_max"))
    stems = coco.select(stem(F.col("file_name")).alias("_stem"), "id").groupBy("_stem").agg(F.min("id").alias("_stem_id"), F.max("id").alias("_stem_max"))
    found = images.withColumn("_name", basename(F.col(path))).withColumn("_stem", stem(F.col(path))).join(names, "_name", "left").join(stems, "_stem", "left")
    # the least and the greatest id tell whether there is one, however many rows share a name
    alone = lambda c: F.when(F.col(f"_{c}_id") == F.col(f"_{c}_max"), F.col(f"_{c}_id"))
    one = found.withColumn("_id", F.when(F.col("_name_id").isNotNull(), alone("name")).otherwise(alone("stem"))).join(counts.select(F.col("image_id").alias("_id"), F.col("n_annotations").alias("_n")), "_id", "left")
    return one.select(*images.columns, F.when(F.col("_n") > 0, F.col("_id")).alias("coco_image_id"), F.when(F.col("_n") > 0, F.col("_n")).alias("n_annotations"))


def with_files(rows: DataFrame, files: DataFrame, on: list[str]) -> DataFrame:
    """PF17, JN7: rows whose file is there."""
    return rows.join(files.select(*on).distinct(), on, "left_semi")


def without_files(rows: DataFrame, files: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(files.select(*on).distinct(), on, "left_anti")


def labelled(rows: DataFrame, labels: DataFrame, on: list[str], label: str, require: bool) -> DataFrame:
    """PF18, JN2: every row with its label; rows without one only unless labels are required."""
    found = rows.join(labels, on, "left")
    return found.where(F.col(label).isNotNull()) if require else found


def group_annotations(annotations: DataFrame, images: DataFrame, key: str, keep: Column, value: Column, order: Column) -> DataFrame:
    """PF16, JN8, AG20: of existing images the values of the annotations to keep, in order."""
    kept = with_files(annotations.where(keep), images, [key])
    pair = F.struct(order.alias("o"), value.alias("v"))
    return kept.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["v"]).alias("values"))


#: Rows of one task of a join, about.
TASK_ROWS = 1_000_000


def subset(keys: DataFrame, key: str, images: DataFrame, annotations: DataFrame, licences: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """OR13: of the chosen images (key) the images, their annotations and the licences they use. images: key, license; annotations: key;
    licences: id. Partitions follow the number of annotations: narrow rows shrink so much on their way that bytes don't tell how many meet."""
    parts = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-annotations.count() // TASK_ROWS))
    dealt = lambda df: df.repartition(parts, key)
    chosen = dealt(keys.select(key).distinct())
    kept = dealt(images).join(chosen, key, "left_semi")
    used = kept.select(F.col("license").alias("id")).distinct()
    return kept, dealt(annotations).join(chosen, key, "left_semi"), licences.join(used, "id", "left_semi")


def single_only(annotations: DataFrame, key: str, keep: Column) -> DataFrame:
    """OR13: keys with exactly one annotation to keep."""
    return annotations.where(keep).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n = 1").select(key)


# splits


def split_size(total: Column, ratio: float | None = None, count: int | None = None, at_least_one: bool = False) -> Column:
    """SO5: how many of a counted total a split takes: a count, which must not exceed it, or a share of it, rounded down; else none."""
    if ratio is not None and count is not None:
        raise ValueError("give a ratio or a count")
    if count is not None and count < 0 or ratio is not None and not 0 <= ratio < 1:
        raise ValueError("a count must not be negative, a ratio must be within 0 and 1")
    if count is not None:
        return F.when(total >= count, F.lit(count).cast("long")).otherwise(F.raise_error(F.lit("count must be within the total")).cast("long"))
    least = F.least(total, F.lit(int(at_least_one and bool(ratio))))
    return F.greatest(least, F.floor(total * F.lit(float(ratio or 0)))).cast("long")


def hashed_rank(column: Column, seed: int) -> list[Column]:
    return [F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string"))), column]


def fixed(rows: DataFrame) -> DataFrame:
    """rows, computed once and kept in the shared folder (spark.checkpoint.dir): every later use sees the same rows. Ranges need this, as
    their bounds are drawn anew each time they are computed."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = rows.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="millrace-"))
    return rows.checkpoint()


def ranked(ids: DataFrame, column: str, order: list[Column]) -> DataFrame:
    """ids with rank from 1 over all rows, without one task that sorts them all: sorted ranges are numbered, then shifted."""
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = fixed(ids.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    parts = parts.withColumn("_own", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return parts.join(F.broadcast(before), "_part").withColumn("rank", F.col("_own") + F.col("_before")).drop("_part", "_own", "_before")


def ranked_within(rows: DataFrame, by: list[str], order: list[Column], name: str = "turn") -> DataFrame:
    """WN4: rows with their place from 1 within each group, without one task that has a whole group.

    Ranges of (group, order) are sorted and their rows numbered; a row's place is its number less that of its group's first row in the
    range, and what earlier ranges have of the group. Only the first group of a range can have begun before it, so that as few carries
    as ranges go to all tasks.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*(F.col(b) for b in by), *order]
    number = F.monotonically_increasing_id()
    parts = fixed(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_number", number))
    parts = parts.withColumn("_part", F.shiftright("_number", 33))
    firsts = parts.groupBy(*by, "_part").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    same = lambda other: [F.col(b).eqNullSafe(F.col(f"{other}_{b}")) for b in by] + [F.col("_part") == F.col(f"{other}_part")]
    named = lambda df, other, *keep: df.select(*(F.col(c).alias(f"{other}_{c.lstrip('_')}") for c in [*by, "_part"]), *keep)
    carries = named(firsts.withColumn("_before", before).where("_before > 0"), "_c", "_before")
    both = parts.join(named(firsts, "_f", "_first"), same("_f")).join(F.broadcast(carries), same("_c"), "left")
    return both.select(*rows.columns, (F.col("_number") - F.col("_first") + 1 + F.coalesce("_before", F.lit(0))).cast("int").alias(name))


def split_train_val(ids: DataFrame, column: str, ratio: float, seed: int) -> DataFrame:
    """SO4: split is val for the max(1, floor(n * ratio)) ids of least hash, else train. ids are distinct."""
    size = ids.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * F.lit(float(ratio)))).alias("_val"))
    return ranked(ids.select(column), column, hashed_rank(F.col(column), seed)).crossJoin(F.broadcast(size)).select(column, F.when(F.col("rank") <= F.col("_val"), "val").otherwise("train").alias("split"))


def split_with_holdout(ids: DataFrame, column: str, val_ratio: float, seed: int, test_ratio: float | None = None, test_count: int | None = None) -> DataFrame:
    """SO5, SO6: the test ids first, train and val from the rest with the next seed."""
    size = ids.agg(split_size(F.count(F.lit(1)), test_ratio, test_count, at_least_one=True).alias("_test"))
    first = ranked(ids.select(column), column, hashed_rank(F.col(column), seed)).crossJoin(F.broadcast(size))
    test = first.where(F.col("rank") <= F.col("_test")).select(column, F.lit("test").alias("split"))
    return test.unionByName(split_train_val(first.where(F.col("rank") > F.col("_test")).select(column), column, val_ratio, seed + 1))


# unions and numbers


def union_manifests(*manifests: DataFrame) -> DataFrame:
    """SO1: all rows, missing columns as null, with _file in the given order."""
    out = None
    for k, m in enumerate(manifests):
        part = m.withColumn("_file", F.lit(k))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def mixed_dataset(real: DataFrame, synthetic: DataFrame, holdout: DataFrame | None = None) -> DataFrame:
    """SO2, SO3: name, split of real_ and synth_ files. With a shared holdout train is the union of both and val the holdout's files.

    real, synthetic and holdout have name and split.
    """
    named = lambda d, prefix: d.select(F.concat(F.lit(prefix), "name").alias("name"), "split")
    both = named(real, "real_").unionByName(named(synthetic, "synth_"))
    if holdout is None:
        return both.where(F.col("split").isin("train", "val"))
    return both.where("split = 'train'").unionByName(holdout.select("name", F.lit("val").alias("split")))


def numbered(rows: DataFrame, order: list[Column], prefix: str, width: int, start: int = 0) -> DataFrame:
    """WN2, WN3: rows with a padded id by their place in the order."""
    return ranked(rows, order[0], order).withColumn("generated_id", padded_id(prefix, F.col("rank") - 1 + start, width)).drop("rank")


def last_rows(rows: DataFrame, key: str, pos: str) -> DataFrame:
    """AG25: one row for each key: the last one, at the place of the first, in pos."""
    every = [c for c in rows.columns if c not in (key, pos)]
    one = rows.groupBy(key).agg(F.min(pos).alias(pos), F.max_by(F.struct(*every), pos).alias("_last"))
    return one.select(key, pos, *(F.col(f"_last.{c}").alias(c) for c in every))


def limited(rows: DataFrame, most: int, *order: str) -> DataFrame:
    """SL2, SL3: the first rows in an order; 0 is no limit, a negative one fails."""
    if most < 0:
        raise ValueError("a limit must not be negative")
    return rows.orderBy(*order).limit(most) if most else rows


# lineage


def dimensions(synthetic: DataFrame, real: DataFrame) -> DataFrame:
    """JN3: synthetic rows with the size of the last real row of their guide image, and whether it is their own size.

    synthetic: guide_image_id, width, height; real: sample_id, width, height, pos.
    """
    last = first_of_each(real, ["sample_id"], F.desc("pos")).select(F.col("sample_id").alias("guide_image_id"), F.col("width").alias("anchor_width"), F.col("height").alias("anchor_height"))
    same = (F.col("width") == F.col("anchor_width")) & (F.col("height") == F.col("anchor_height"))
    return synthetic.join(last, "guide_image_id", "left").withColumn("size_match_anchor", same)


def size_counts(rows: DataFrame) -> DataFrame:
    """JN3: how many rows of dimensions() could be compared, and how many have the size of their guide image."""
    same = F.col("size_match_anchor")
    return rows.agg(F.count(same).alias("checked"), F.count(F.when(same, 1)).alias("matching"), F.count(F.when(~same, 1)).alias("differing"))


def exact_matches(files: DataFrame, refs: DataFrame) -> DataFrame:
    """JN4: each file's first reference of its name, and how many there are. files: name; refs: name, ref_id, pos."""
    many = refs.groupBy("name").agg(F.min_by("ref_id", F.struct("pos", "ref_id")).alias("ref_id"), F.count(F.lit(1)).alias("candidates"))
    return files.join(many, "name")


def chosen_runs(refs: DataFrame) -> DataFrame:
    """AG18: of each prefix the run with the most references, the later of equals. refs: prefix, run, run_order."""
    return refs.groupBy("prefix", "run", "run_order").agg(F.count(F.lit(1)).alias("n")).groupBy("prefix").agg(F.max_by("run", F.struct("n", "run_order")).alias("run"))


def rank_pairs(files: DataFrame, refs: DataFrame, how: str = "inner") -> DataFrame:
    """JN5, WN4: files of a prefix by counter with references of the prefix by id, place by place. files: prefix, name, counter. how: left
    keeps files without a reference.

    Places are counted over ranges, and pairs meet by prefix and place, so that one prefix may have all files.
    """
    return ranked_within(files, ["prefix"], [F.col("counter"), F.col("name")]).join(ranked_within(refs, ["prefix"], [F.col("ref_id")]), ["prefix", "turn"], how)


def job_count(rows: DataFrame, column: str) -> DataFrame:
    """AG17: different non-blank ids, or all rows if there is none."""
    ids = F.count_distinct(non_blank(F.col(column)))
    return rows.agg(F.when(ids > 0, ids).otherwise(F.count(F.lit(1))).alias("jobs"))


def job_plan(anchors: DataFrame, target: int, seed: int, start: int = 0) -> DataFrame:
    """JN9, WN5: so many jobs from a number on; job i takes anchor i mod n and seed + i. anchors: anchor_id, turn from 0 to n - 1. Without
    anchors there are no jobs."""
    n = anchors.agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    jobs = anchors.sparkSession.range(start, start + target).crossJoin(F.broadcast(n)).withColumn("turn", F.col("id") % F.col("_n"))
    return jobs.join(anchors, "turn").select(F.col("id").alias("job"), "anchor_id", (F.col("id") + seed).alias("seed"))


def copied(files: DataFrame) -> DataFrame:
    """AG21: samples of a copied split: half of its images and labels together. files: kind (images or labels)."""
    return files.agg(F.floor(F.count(F.when(F.col("kind").isin("images", "labels"), 1)) / 2).alias("copied"))


def stub_plan(real: DataFrame, each: int, seed: int, most: int = 0, files: DataFrame | None = None) -> DataFrame:
    """JN10, UD10: `each` jobs for every real row, seed + pos * 100 + k, limited in order (0: all); none if each is not positive.

    real: sample_id, pos; files: path of every file that is there, and then real has image_path: rows whose file is missing have no job,
    but their places count.
    """
    if files is not None:
        real = real.join(files.select(F.col("path").alias("image_path")).distinct(), "image_path", "left_semi")
    turns = F.sequence(F.lit(0), F.lit(each - 1)) if each > 0 else F.array().cast("array<int>")
    jobs = real.select("sample_id", "pos", F.explode(turns).alias("k")).withColumn("seed", seed + F.col("pos") * 100 + F.col("k"))
    return jobs.orderBy("pos", "k").limit(most) if most else jobs


def duplicated(rows: DataFrame, column: str) -> DataFrame:
    """AG22: values that more than one row has, and how many."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_unique(rows: DataFrame, column: str, owner: str) -> DataFrame:
    """AG22: rows, if no value occurs twice; else it fails and names two owners of the least such value."""
    twice = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.min(owner).alias("a"), F.max(owner).alias("b")).where("n > 1").orderBy(column).first()
    if twice:
        raise ValueError(f"{twice[0]} belongs to {twice.a} and {twice.b}")
    return rows
