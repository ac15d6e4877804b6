"""Connected components of a link table, as DataFrame steps (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v. large: each node's larger neighbours move to its least neighbour; small: its smaller ones."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    out = both.join(least, "u")
    if large:
        moved = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _told(edges: DataFrame) -> tuple:
    """Number and 128 bits of hashes of an edge set: two that agree in these are the same."""
    h = lambda *c: F.bit_xor(F.xxhash64(*c))
    return tuple(edges.agg(F.count(F.lit(1)), h("u", "v"), h("v", "u", F.lit(1))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, v) links of long ids -> (id, component): the least id reachable, for every id with a link.

    Each round writes its edges to the shared folder, so lineage stays short. Neighbour lists are never collected:
    a hub is a sum over its edges. The number of rounds grows with the logarithm of the longest chain."""
    edges = stored(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    told = _told(edges)
    while True:
        new = stored(_star(_star(edges, True), False), "edges")
        # done when nothing moved: every edge is then node -> least id
        before, told = told, _told(new)
        discard(edges)
        if before == told:
            break
        edges = new
    return new.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        new.select(F.col("v").alias("id"), F.col("v").alias("component"))
    ).groupBy("id").agg(F.min("component").alias("component"))
