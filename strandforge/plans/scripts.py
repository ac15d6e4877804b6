"""The single steps as commands: python -m strandforge script <name> <options>. Inputs and outputs are paths of any store
Spark knows; outputs are folders of files whose names sort as their rows do."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import CONSENSUS, header_taxa
from ..operators import contaminants, lineage, sequence
from ..sources import readers, writers
from ..sources.scratch import clear, held, written

RANKS = ("kingdom", "phylum", "class", "order", "family", "genus", "species")


def _fasta(spark: SparkSession, path: str) -> DataFrame:
    return readers.fasta(spark, path)


def _put(frame: DataFrame, path: str | None) -> None:
    if path:
        writers.write_fasta(frame, path)


def concat(spark, o):
    """Files of a folder as one, each header behind its file's name, the extension included."""
    parts = readers.records(spark, o.input).withColumn("header", readers.tagged(F.col("file"), F.col("header")))
    _put(readers.assemble(parts), o.output)


def degap(spark, o):
    _put(sequence.degap(_fasta(spark, o.input)), o.output)


def underscore(spark, o):
    _put(sequence.underscore_headers(_fasta(spark, o.input)), o.output)


def filter_ns(spark, o):
    given = _fasta(spark, o.input)
    _put(sequence.max_char(given, "N", o.max), o.output)
    _put(sequence.max_char(given, "N", o.max, discarded=True) if o.discarded else given, o.discarded)


def length_filter(spark, o):
    given = _fasta(spark, o.input)
    _put(sequence.length_range(given, o.min, o.max), o.output)
    if o.discarded:
        writers.write_tsv(sequence.length_range(given, o.min, o.max, discarded=True).select("header", "sequence", "length", "pos"), o.discarded)


def truncate(spark, o):
    """Lineages end before the first missing rank; records left without a taxon go to a table."""
    cut = lineage.truncate_missing_rank(_fasta(spark, o.input))
    _put(cut.where("not removed").select(F.col("truncated").alias("header"), "sequence", "pos"), o.output)
    if o.discarded:
        writers.write_tsv(cut.where("removed").select("header", F.col("truncated").alias("truncated_header"), "sequence", "pos"), o.discarded, header=False)


def stop_codons(spark, o):
    """Records with an internal stop codon go; those on the other strand are turned."""
    given = _fasta(spark, o.input)
    told = sequence.stop_codon_info(given, o.genetic_code, o.consensus_seq)
    _put(told.where("not discarded").select("header", F.col("oriented_sequence").alias("sequence"), "pos"), o.output)
    if o.filter_info:
        writers.write_tsv(sequence.stop_codon_table(given, o.genetic_code, o.consensus_seq), o.filter_info)


def check_clusters(spark, o):
    """Curated headers of clustered FASTA, and the table about them."""
    given = readers.clustered(spark, o.input).withColumn("header", F.concat(F.lit(">"), "member"))
    members = given.withColumn("identifier", F.substring_index("member", "|", 1)).withColumn("taxa", header_taxa(F.col("header")))
    curated = lineage.curate(members)
    _put(lineage.curated_fasta(curated), o.output)
    if o.processing_output:
        writers.write_tsv(curated, o.processing_output)


def replace_names(spark, o):
    """Names in a specimen table, from a file of replacements or from lists `old,old` and `new,new` for a rank."""
    head = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(o.input)
    table = head.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in head.columns], readers.place().alias("pos"))
    pairs = [(r, a, b) for r in RANKS if getattr(o, f"{r}_to_replace") for a, b in _paired(r, getattr(o, f"{r}_to_replace"), getattr(o, f"{r}_to_use") or "")]
    listed = spark.createDataFrame(pairs, "taxon_rank string, taxon_to_replace string, taxon_to_use string")
    if o.replacement_file:
        listed = listed.unionByName(readers.replacements(spark, o.replacement_file))
    writers.write_tsv(lineage.replace_names(table, listed, head.columns, [r for r in RANKS if r in head.columns]), o.output)


def _paired(rank: str, old: str, new: str) -> list[tuple[str, str]]:
    a, b = old.split(","), new.split(",") if new else []
    if len(a) != len(b):
        raise ValueError(f"{rank}: each name to replace needs a name to use")
    return list(zip(a, b, strict=True))


def remove_contaminants(spark, o):
    """Records that are nearly one of the contaminants go to `matched`; `report` tells which they match."""
    given = _fasta(spark, o.input)
    against = _fasta(spark, o.db).select(F.regexp_replace("header", "^>", "").alias("identifier"), "sequence")
    hits = written(contaminants.hits(given, against, o.id), "hits")
    found = given.join(hits, "sequence")
    _put(given.join(hits.select("sequence"), "sequence", "left_anti"), o.output)
    _put(found, o.matched)
    if o.report:
        writers.write_tsv(found.select("header", "contaminant", "identity", "columns", "pos"), o.report)


_IO = (("-i", "--input", str, None), ("-o", "--output", str, None))
#: Name -> what it does, and its options: short and long name, kind, default.
SCRIPTS = {
    "concat_clusters": (concat, _IO),
    "degap_fasta": (degap, _IO),
    "underscore_fasta": (underscore, _IO),
    "filter_Ns": (filter_ns, (*_IO, ("-m", "--max", int, 0), ("-d", "--discarded", str, None))),
    "length_filter": (length_filter, (*_IO, ("-l", "--min", int, None), ("-L", "--max", int, None), ("-d", "--discarded", str, None))),
    "remove_lower_than_missing_taxon_info": (truncate, (*_IO, ("-d", "--discarded", str, None))),
    "stop_codon_filter": (stop_codons, (*_IO, ("-c", "--genetic_code", int, 5), ("-f", "--filter_info", str, None), ("-C", "--consensus_seq", str, CONSENSUS), ("-n", "--num_cores", int, None))),
    "check_clusters": (check_clusters, (*_IO, ("-p", "--processing_output", str, None))),
    "replace_taxon_name_for_rank": (replace_names, (*_IO, ("-r", "--replacement_file", str, None), *[(f"--{r}_to_replace", f"--{r[:3]}_to_replace", str, None) for r in RANKS], *[(f"--{r}_to_use", f"--{r[:3]}_to_use", str, None) for r in RANKS])),
    "contaminants": (remove_contaminants, (*_IO, ("-b", "--db", str, None), ("-m", "--matched", str, None), ("-r", "--report", str, None), ("-I", "--id", float, 0.9))),
}


def main(spark: SparkSession, words: list[str]) -> list[str]:
    """Does one of `SCRIPTS` and names what it wrote."""
    if not words or words[0] not in SCRIPTS:
        raise ValueError(f"name one of {', '.join(SCRIPTS)}")
    do, options = SCRIPTS[words[0]]
    parser = argparse.ArgumentParser(prog=words[0], allow_abbrev=False)
    for short, long, kind, default in options:
        parser.add_argument(short, long, type=kind, default=default)
    o = parser.parse_args(words[1:])
    for name in ("input", "output", *(["db"] if "db" in o else [])):
        if not getattr(o, name):
            raise ValueError(f"{words[0]} needs --{name}")
    others = held()
    do(spark, o)
    clear(spark, others)
    return [getattr(o, k) for k in ("output", "discarded", "filter_info", "processing_output", "matched", "report") if getattr(o, k, None)]
