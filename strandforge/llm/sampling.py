"""Folds by doc_id, and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(of: int, doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod `of`; null for a null doc_id."""
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % of).cast("int")


def held_out(of: int) -> Column:
    return F.coalesce(fold(of) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int], of: int = 5) -> DataFrame:
    """(doc_id, text, label): labelled ids outside the held-out fold, for each label value at most most[value] of them,
    those with the least hash, with one text each: rows that share an id count as one, the one with the least hash of
    its text. The ids are a few ten thousand at most by these bounds, so they may be broadcast. Labels that contradict
    each other for one doc_id are left out; null labels and ids too."""
    own = labels.select("doc_id", F.col(label).cast("int").alias("_label")).where("doc_id is not null and _label is not null")
    own = own.where(fold(of) != 0).groupBy("doc_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other")).where("_label = _other").drop("_other")
    picks = None
    for value, n in most.items():
        part = own.where(F.col("_label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picks = part if picks is None else picks.unionByName(part)
    picked = [(r.doc_id, r._label) for r in picks.collect()]
    small = docs.sparkSession.createDataFrame(picked, "doc_id long, _label int")
    rows = docs.select("doc_id", "text").join(F.broadcast(small), "doc_id")
    # partial minima first, so an id with very many rows sends one text a partition
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"), F.min("_label").alias("label"))
    return one.select("doc_id", "t.text", "label")
