"""The corpus pipeline: quality classifier, line dedup, near-dedup, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandforge.llm.common import NO_ID, clear, held, stored, table
from strandforge.llm.decontamination import contaminated
from strandforge.llm.line_dedup import line_dedup
from strandforge.llm.near_dedup import near_dedup
from strandforge.llm.packing import pack
from strandforge.llm.quality_classifier import quality_scores

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier scores 0.3 or above. Null, empty and blank texts have the score of a text
    without words; repeated rows are judged each, null ids like others. Without labels of both kinds all documents have
    the labels' share as score (0.5 without any)."""
    return quality_scores(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines; every document stays, n_chars follows the text. A null text stays null, with null n_chars;
    equal rows count as one document and each stay, null ids are told apart by their texts."""
    kept = line_dedup(docs).withColumnRenamed("kept_text", "text")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def row_keyed(docs: DataFrame) -> DataFrame:
    """With _id, 62 bits, and _h, 64 more, of hashes of doc_id and text: never null, and only equal rows share both."""
    told = [F.coalesce("doc_id", F.lit(NO_ID)), F.col("doc_id").isNull(), F.col("text"), F.col("text").isNull()]
    return docs.withColumns({"_id": F.xxhash64(*told).bitwiseAND(F.lit(2**62 - 1)), "_h": F.xxhash64(F.lit(1), *told)})


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group (a null id is the least); of equal rows, one. Null, empty and
    blank texts are no duplicates of anything but equal rows."""
    docs = row_keyed(docs)
    groups = near_dedup(docs.select(F.col("_id").alias("doc_id"), "text")).select(F.col("doc_id").alias("_id"), F.col("component_id").alias("group")).distinct()
    least = docs.select("_id", "doc_id").join(groups, "_id").groupBy("group").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "_id")).alias("m"))
    return docs.join(least.select("m._id"), "_id", "left_semi").dropDuplicates(["_id", "_h"]).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; null ids are dropped like others, and only with their own text."""
    docs = row_keyed(docs)
    found = contaminated(docs.select(F.col("_id").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(found, "_id", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batches: doc_id, n_tokens, bucket, bucket_length, batch_id, slot, n_padding; a row for every document given,
    equal rows and null ids included. A null or empty text is one token, its end. No documents, no batches."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("packing", packing),
]

#: Classifier, signatures and dynamic programming are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again. What a stage stored
    on its way is removed when its result is written, and so is the stage before."""
    docs, others = table(spark, sf_dir, "documents"), held()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        clear(spark, others | {docs._stored_at})
    return STAGES[-1][1](spark, docs, sf_dir)
