"""Output layouts as projections, and a writer for each. Layouts of the classifiers follow their public documentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANKS = ["kingdom", "phylum", "class", "order_name", "family", "genus", "species"]
_LETTERS = dict(zip(RANKS, "kpcofgs", strict=True))


def fasta_text(frame: DataFrame) -> DataFrame:
    """One text value per record: header line and one sequence line."""
    return frame.select(F.concat("header", F.lit("\n"), "sequence").alias("value"))


def qiime2_taxonomy(frame: DataFrame) -> DataFrame:
    """feature_id and k__..; s__.. taxon text; the sequences go to a plain FASTA by identifier."""
    return frame.select(F.col("identifier").alias("feature_id"), F.concat_ws("; ", *[F.concat(F.lit(f"{_LETTERS[r]}__"), F.coalesce(F.col(r), F.lit(""))) for r in RANKS]).alias("taxon"))


def kraken2(frame: DataFrame) -> DataFrame:
    """Headers with the taxon id of the NCBI taxonomy; rows without one cannot be used by the classifier."""
    return frame.where("taxon_id is not null").select(F.concat(F.lit(">"), "identifier", F.lit("|kraken:taxid|"), F.col("taxon_id").cast("string")).alias("header"), "sequence")


def _known() -> Column:
    """Taxa down to the first unknown rank."""
    return F.regexp_replace(F.concat_ws(";", *[F.coalesce(F.col(r), F.lit("")) for r in RANKS[:6]]), "(^|;);.*$", "$1")


def dada2_taxonomy(frame: DataFrame) -> DataFrame:
    return frame.select(F.concat(F.lit(">"), F.regexp_replace(_known(), ";$", ""), F.lit(";")).alias("header"), "sequence")


def dada2_species(frame: DataFrame) -> DataFrame:
    return frame.where("species != ''").select(F.concat(F.lit(">"), "identifier", F.lit(" "), "species").alias("header"), "sequence")


def sintax(frame: DataFrame) -> DataFrame:
    letters = ["d", "p", "c", "o", "f", "g", "s"]
    tax = F.concat_ws(",", *[F.when(F.coalesce(F.col(r), F.lit("")) != "", F.concat(F.lit(f"{x}:"), F.replace(F.col(r), F.lit(" "), F.lit("_")))) for r, x in zip(RANKS, letters, strict=True)])
    return frame.select(F.concat(F.lit(">"), "identifier", F.lit(";tax="), tax, F.lit(";")).alias("header"), "sequence")


def comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per record the lineage before and after harmonization, and whether it changed. Records are told apart by `pos`
    where there is one, else by identifiers, which then must not repeat."""
    key = "pos" if "pos" in before.columns and "pos" in after.columns else "identifier"
    a = before.select("identifier", *[key] * (key == "pos"), F.col("lineage").alias("lineage_before"))
    b = after.select(key, F.col("lineage").alias("lineage_after"))
    return a.join(b, key, "left").select("identifier", "lineage_before", "lineage_after").withColumn("changed", ~F.col("lineage_before").eqNullSafe(F.col("lineage_after")))


def write_fasta(frame: DataFrame, path: str) -> None:
    """In order of `pos`, where there is such a column: the first occurrence of each header in the input. Files are
    ranges of positions, whose names sort as these do."""
    fasta_text(frame.orderBy("pos") if "pos" in frame.columns else frame).write.text(path)


def write_tsv(frame: DataFrame, path: str, header: bool = True) -> None:
    """Fields are joined by tabs without quoting, as they are; in order of `pos`, which is left out, where there is one."""
    if "pos" in frame.columns:
        frame = frame.orderBy("pos").drop("pos")
    frame.write.option("sep", "\t").option("header", header).option("quote", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


TABLE = ["identifier", "kingdom", "phylum", "class", "order_name", "family", "genus", "species", "country", "location", "latitude", "longitude", "source", "taxon_id", "specimens", "sequence"]


def table(frame: DataFrame) -> DataFrame:
    """The columns of the output table, as far as there are any."""
    return frame.select(*[c for c in [*TABLE, "pos"] if c in frame.columns])


def lineage_fasta(frame: DataFrame) -> DataFrame:
    """>identifier|kingdom|...|species; unknown ranks at the end are left out, inner ones stay empty."""
    line = F.regexp_replace(F.concat_ws("|", "identifier", *[F.coalesce(F.col(r), F.lit("")) for r in RANKS]), r"[|]+$", "")
    return frame.select(F.concat(F.lit(">"), line).alias("header"), "sequence", *[c for c in ("pos",) if c in frame.columns])
