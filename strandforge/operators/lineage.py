"""Lineages in headers, and their consensus within clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import contains_lineage, header_taxa
from ..sources.scratch import written


def truncate_missing_rank(frame: DataFrame) -> DataFrame:
    """Headers are cut before the first empty rank inside; removed marks those left without a taxon."""
    cut = F.when(F.col("header").rlike(r"[|][|]"), F.regexp_extract("header", r"^(>.*?)[|][|]", 1)).otherwise(F.col("header"))
    return frame.withColumn("truncated", cut).withColumn("removed", F.col("header").rlike(r"[|][|]") & (F.instr("truncated", "|") == 0))


def replace_names(frame: DataFrame, pairs: DataFrame, columns: list[str] | None = None, ranks: list[str] | None = None) -> DataFrame:
    """pairs: (taxon_rank, taxon_to_replace, taxon_to_use), of any number. Where a row's name at a rank is listed, the
    old name is replaced everywhere in the row: in all of `columns`, which are all text columns unless given, rank by
    rank in the order of `ranks` (the standard ranks that there are); the lookup uses the row as it came. Of several
    pairs for one name the last in order of their new names counts."""
    columns = columns or [f.name for f in frame.schema.fields if f.dataType.typeName() == "string"]
    ranks = ranks or [c for c in ("kingdom", "phylum", "class", "order", "order_name", "family", "genus", "species") if c in columns]
    out, new = frame, {}
    for i, rank in enumerate(ranks):
        own = pairs.where((F.col("taxon_rank") == rank.removesuffix("_name")) & (F.coalesce("taxon_to_replace", F.lit("")) != ""))
        own = own.groupBy(F.col("taxon_to_replace").alias(f"_old{i}")).agg(F.max("taxon_to_use").alias(f"_new{i}"))
        out = out.join(own, out[rank] == own[f"_old{i}"], "left")  # Spark broadcasts a small list of names by its size
        new[rank] = F.col(f"_new{i}")
    cells = {c: F.col(c) for c in columns}
    for rank in ranks:
        cells = {c: F.when(new[rank].isNotNull(), F.replace(x, F.col(rank), new[rank])).otherwise(x) for c, x in cells.items()}
    return out.select(*[cells[c].alias(c) if c in cells else F.col(c) for c in frame.columns])


def with_taxa(frame: DataFrame) -> DataFrame:
    return frame.withColumn("taxa", header_taxa(F.col("header")))


def lineage_counts(members: DataFrame) -> DataFrame:
    """(cluster, taxa, count). Of members with a header, those of one header in one cluster are one, their sequences
    having been joined."""
    own = members.select("cluster", "taxa", "header").distinct() if "header" in members.columns else members
    return own.groupBy("cluster", "taxa").agg(F.count(F.lit(1)).alias("count"))


def _ordered(counts: DataFrame) -> DataFrame:
    """Per cluster its distinct lineages, the most specific, then the most frequent, then the greatest text first. What
    is gathered are distinct lineages with counts, not members."""
    item = F.struct((-F.size("taxa")).alias("a"), (-F.col("count")).alias("b"), F.array_join("taxa", "|").alias("t"), "taxa", "count")
    by = lambda x, y: F.when(x["a"] != y["a"], x["a"] - y["a"]).when(x["b"] != y["b"], F.signum(x["b"] - y["b"]).cast("int")).when(x["t"] > y["t"], -1).when(x["t"] < y["t"], 1).otherwise(0)
    return counts.groupBy("cluster").agg(F.collect_list(item).alias("l")).select("cluster", F.array_sort("l", by).alias("l"))


def _fold(counts: DataFrame, step) -> DataFrame:
    taxa = F.transform("l", lambda x: x["taxa"])
    return _ordered(counts).select("cluster", F.aggregate(F.slice(taxa, 2, F.greatest(F.size(taxa) - 1, F.lit(1))), F.get(taxa, F.lit(0)), step).alias("taxa"))


def congruent(counts: DataFrame) -> DataFrame:
    """Lowest taxon with a congruent lineage: a contained lineage changes nothing, another leaves the common part."""
    return _fold(counts, lambda acc, x: F.when(contains_lineage(acc, x), acc).otherwise(F.array_intersect(acc, x)))


def common_ancestor(counts: DataFrame) -> DataFrame:
    return _fold(counts, F.array_intersect)


def majority(counts: DataFrame) -> DataFrame:
    """The most frequent lineage; of equal ones the first in the order of `_ordered`."""
    best = F.aggregate("l", F.get("l", F.lit(0)), lambda acc, x: F.when(x["count"] > acc["count"], x).otherwise(acc))
    return _ordered(counts).select("cluster", best["taxa"].alias("taxa"))


def support(counts: DataFrame) -> DataFrame:
    """(cluster, taxa, count, support): own count and those of the lineages contained in it.

    A contained lineage's rarest name in its cluster is among the names of all that contain it, so pairs meet at that
    name only, and never all of a cluster. The lineage without names is contained in all and is added as a number.
    Everything here has rows of all clusters, of which files tell a small part only: joins are merges, nothing is sent."""
    counts = written(counts, "counts")  # read several times below
    names = counts.select("cluster", "taxa", "count", F.explode(F.array_distinct("taxa")).alias("name"))
    often = names.groupBy("cluster", "name").agg(F.count(F.lit(1)).alias("often"))
    rarest = names.join(often.hint("merge"), ["cluster", "name"]).groupBy("cluster", "taxa").agg(F.min(F.struct("often", "name"))["name"].alias("name"), F.first("count").alias("n"))
    inside = rarest.select("cluster", "name", F.col("taxa").alias("other"), "n")
    # a lineage with a repeated name contains nothing
    holders = names.where(F.size(F.array_distinct("taxa")) == F.size("taxa")).select("cluster", "name", "taxa")
    pairs = holders.join(inside.hint("merge"), ["cluster", "name"]).where(F.size(F.array_distinct("other")) <= F.size("taxa"))
    more = pairs.where((F.col("taxa") != F.col("other")) & contains_lineage(F.col("taxa"), F.col("other"))).groupBy("cluster", "taxa").agg(F.sum("n").alias("more"))
    bare = counts.where(F.size("taxa") == 0).select("cluster", F.col("count").alias("bare"))
    out = counts.join(more.hint("merge"), ["cluster", "taxa"], "left").join(bare.hint("merge"), "cluster", "left")
    free = (F.size("taxa") > 0) & (F.size(F.array_distinct("taxa")) == F.size("taxa"))
    return out.select("cluster", "taxa", "count", (F.col("count") + F.coalesce("more", F.lit(0)) + F.when(free, F.coalesce("bare", F.lit(0))).otherwise(0)).alias("support"))


def by_ratio(counts: DataFrame, ratio: float) -> DataFrame:
    """The best supported lineage if it has `ratio` times the support of the next, else the most specific one."""
    item = F.struct((-F.col("support")).alias("s"), F.array_join("taxa", "|").alias("t"), "taxa")
    by = lambda x, y: F.when(x["s"] != y["s"], F.signum(x["s"] - y["s"]).cast("int")).when(x["t"] > y["t"], -1).when(x["t"] < y["t"], 1).otherwise(0)
    # specific: the first in the order of `_ordered`; unless contained ones are skipped nothing moves it
    specific = F.max_by("taxa", F.struct(F.size("taxa"), "count", F.array_join("taxa", "|")))
    ranked = support(counts).groupBy("cluster").agg(F.array_sort(F.collect_list(item), by).alias("r"), specific.alias("specific"))
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    return ranked.select("cluster", F.when(second.isNotNull() & (first["s"] / second["s"] >= ratio), first["taxa"]).otherwise(F.col("specific")).alias("taxa"))


def without_conflict(counts: DataFrame) -> DataFrame:
    """Clusters with one lineage only."""
    return counts.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("taxa").alias("taxa")).where("n = 1").select("cluster", "taxa")


def curate(members: DataFrame) -> DataFrame:
    """Every member with its cluster's congruent lineage and the count of its own. taxon_original is the header's text
    behind the identifier, with the empty ranks at its end."""
    counts = lineage_counts(members)
    own = members.join(counts, ["cluster", "taxa"]).join(congruent(counts).withColumnRenamed("taxa", "agreed"), "cluster")
    text = F.regexp_extract("header", r"^>?[^|]*\|(.*)$", 1) if "header" in members.columns else F.array_join("taxa", "|")
    return own.select("identifier", "cluster", text.alias("taxon_original"), F.array_join("agreed", "|").alias("taxon_curated"), F.col("count").alias("count_original"), F.lit("choose_by_lowest_taxon_with_congruent_lineage").alias("processing_method"), "sequence")


def curated_fasta(curated: DataFrame) -> DataFrame:
    """(header, sequence) of curated members: the identifier and the cluster's lineage."""
    return curated.select(F.concat(F.lit(">"), "identifier", F.lit("|"), "taxon_curated").alias("header"), "sequence")


def removed_table(truncated: DataFrame) -> DataFrame:
    """Header, cut header and sequence of records left without a taxon: the columns of their table."""
    return truncated.where("removed").select("header", F.col("truncated").alias("truncated_header"), "sequence")
