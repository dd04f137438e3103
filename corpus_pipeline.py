"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the documents of the next.

Toxic documents go; of each group of near copies one document stays; bytes that repeat elsewhere are cut out; documents that hold
benchmark items go; what is left is packed into sequences. Each stage works on all that its predecessor kept. All stages but the
last return the columns of documents; n_chars always tells the characters of the text at hand, null where the text is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from millrace.llm import toxicity as network
from millrace.llm.common import Batches, hash_filter, longs, mapped, may_hold, stored
from millrace.llm.edit_matching import decontaminate
from millrace.llm.packing import best_fit_packing
from millrace.llm.prefix_tree_join import prefix_tree_join
from millrace.llm.queries import table, vocabulary
from millrace.llm.suffix_dedup import suffix_array_dedup

#: SQL cannot express the network nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_row_key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5. The network learns from the labelled documents of the input at hand."""
    return network.without_toxic(docs, network.train(docs, table(spark, sf_dir, "labels")))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id (null comes last), then the least key.

    Of repeated rows of it, all but one go, too. All documents without words stay.
    """
    found = stored(prefix_tree_join(docs).where("n_shingles > 0").select("doc_id", "key", "group"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("key").alias("_row_key")))
    groups = stored(found.groupBy("group").agg(least.alias("least"), F.count("key").alias("k")))
    several = stored(found.join(groups.where("k > 1").select("group"), "group").select("key"))
    stays = groups.select("least._id", "least._row_key")
    filters = spark.sparkContext.broadcast((hash_filter(several, several.count()), hash_filter(stays.select("_row_key"), groups.count())))

    def marked(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = longs(b.column("_row_key")).view(np.uint64)
            doubt, stay = (may_hold(f, key) for f in filters.value)
            words = b.column("_words").to_numpy(zero_copy_only=False).astype(bool)
            b = b.drop_columns("_words").append_column("_doubt", pa.array(doubt & words))
            yield b.filter(pa.array(stay | ~words))

    # only texts that may have near copies are sent to the rows that stay, and of these only those that may stay; those of groups of one row stay anyway
    keyed = _keyed(docs).withColumn("_words", F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    rows = keyed.transform(mapped, marked, StructType([*keyed.drop("_words").schema.fields, StructField("_doubt", BooleanType())]))
    once = rows.where("_doubt").withColumn("_id", F.coalesce("doc_id", F.lit(-1))).dropDuplicates(["_row_key", "_id"])
    return once.join(stays, ["_row_key", "_id"], "left_semi").select(*docs.columns).unionByName(rows.where("not _doubt").select(*docs.columns))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 200 bytes that occur again; characters that are cut through go as a whole."""
    found = suffix_array_dedup(docs, as_text=True).select("doc_id", "key", F.col("kept").alias("_kept"), F.col("n_removed").alias("_removed")).dropDuplicates(["doc_id", "key"])
    cut = found.where("_removed > 0").select(F.coalesce("doc_id", F.lit(-1)).alias("_id"), F.col("key").alias("_row_key"), "_kept")
    joined = _keyed(docs).withColumn("_id", F.coalesce("doc_id", F.lit(-1))).join(cut, ["_row_key", "_id"], "left")
    text = F.coalesce("_kept", "text")
    return joined.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its budget of edits."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return best_fit_packing(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
