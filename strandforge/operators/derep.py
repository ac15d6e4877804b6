"""Dereplication: records of one sequence become one. Candidates rank by depth of lineage, then by specimens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def candidates(frame: DataFrame) -> DataFrame:
    """(sequence, taxa, n, first_pos): the distinct lineages of each sequence. Takes sequence, taxa, pos."""
    return frame.groupBy("sequence", "taxa").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))


def groups(frame: DataFrame) -> DataFrame:
    return candidates(frame).groupBy("sequence").agg(F.sum("n").alias("specimens"), F.count(F.lit(1)).alias("lineages"), F.min("first_pos").alias("first_pos"))


def _best(frame: DataFrame) -> DataFrame:
    """Candidates of the highest precedence."""
    c = candidates(frame).withColumn("rank_key", F.struct(F.size("taxa").alias("depth"), "n"))
    top = c.groupBy("sequence").agg(F.max("rank_key").alias("top"))
    return c.join(top, "sequence").where("rank_key = top")


def keep_first(frame: DataFrame) -> DataFrame:
    """Of equal candidates the first in input order."""
    return _best(frame).groupBy("sequence").agg(F.min_by("taxa", "first_pos").alias("taxa"))


def shared_beginning(a: Column, b: Column) -> Column:
    """What two arrays have in common from their first position on, up to the first difference."""
    places = F.sequence(F.lit(1), F.greatest(F.least(F.size(a), F.size(b)), F.lit(1)))
    return F.slice(a, F.lit(1), F.size(F.filter(places, lambda i: (i <= F.least(F.size(a), F.size(b))) & (F.slice(a, F.lit(1), i) == F.slice(b, F.lit(1), i)))))


def known_part(taxa: Column) -> Column:
    """Without the unknown ranks at the end."""
    return F.slice(taxa, F.lit(1), F.coalesce(F.array_max(F.transform(taxa, lambda x, i: F.when(x != "", i + 1).otherwise(0))), F.lit(0)))


def common(frame: DataFrame) -> DataFrame:
    """Equal candidates give way to their last common ancestor: rank by rank from the coarsest, up to the first rank at
    which they differ; an unknown rank and a name differ.

    In the order of arrays the least and the greatest of some have in common what all have, so nothing is gathered."""
    tied = _best(frame).groupBy("sequence").agg(F.min("taxa").alias("a"), F.max("taxa").alias("b"))
    return tied.select("sequence", known_part(shared_beginning(F.col("a"), F.col("b"))).alias("taxa"))


def discard(frame: DataFrame) -> DataFrame:
    """Sequences with equal candidates are dropped."""
    return _best(frame).groupBy("sequence").agg(F.count(F.lit(1)).alias("k"), F.min("taxa").alias("taxa")).where("k = 1").select("sequence", "taxa")
