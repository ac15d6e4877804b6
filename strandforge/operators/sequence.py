"""Sequence projections and filters. Nothing here shuffles but the join of similarities to distinct sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import CONSENSUS, STRAND_TOLERANCE, count_char, internal_stops, jaro_winkler, reverse_complement, translate


def degap(frame: DataFrame) -> DataFrame:
    return frame.withColumn("sequence", F.replace("sequence", F.lit("-"), F.lit("")))


def underscore_headers(frame: DataFrame) -> DataFrame:
    return frame.withColumn("header", F.replace("header", F.lit(" "), F.lit("_")))


def max_char(frame: DataFrame, char: str, most: int, discarded: bool = False) -> DataFrame:
    """Records with at most `most` times `char` (case matters), or the others."""
    keep = count_char(F.col("sequence"), char) <= most
    return frame.where(~keep if discarded else keep)


def length_range(frame: DataFrame, least: int | None = None, most: int | None = None, discarded: bool = False) -> DataFrame:
    """Records of a length in the inclusive range (gaps count), or the others with their length."""
    size = F.length("sequence")
    keep = F.lit(True)
    if least is not None:
        keep = keep & (size >= least)
    if most is not None:
        keep = keep & (size <= most)
    return frame.where(~keep).withColumn("length", size) if discarded else frame.where(keep)


_FRAMES = [(strand, frame) for strand in ("forward", "reverse") for frame in (1, 2, 3)]


def _proteins(frame: DataFrame, code: int) -> DataFrame:
    """(sequence, proteins): of each distinct sequence the proteins of its six frames, in the order of `_FRAMES`."""
    base = frame.select("sequence").where("sequence is not null").distinct().withColumn("back", reverse_complement(F.col("sequence")))
    return base.select("sequence", F.array(*[translate(F.col("sequence" if s == "forward" else "back"), f, code) for s, f in _FRAMES]).alias("proteins"))


def _candidates(proteins: DataFrame, consensus: str) -> DataFrame:
    """(sequence, c): the six as structs; similarities come from one call over a batch of sequences."""
    told = proteins.withColumn("similarities", jaro_winkler("proteins", F.lit(consensus)))
    return told.select("sequence", F.array(*[
        F.struct(F.lit(s).alias("strand"), F.lit(f).alias("frame"), F.get("proteins", F.lit(i)).alias("protein"), internal_stops(F.get("proteins", F.lit(i))).alias("stop_count"),
                 F.get("similarities", F.lit(i)).alias("similarity")) for i, (s, f) in enumerate(_FRAMES)]).alias("c"))


def frames(frame: DataFrame, code: int = 5) -> DataFrame:
    """A row per distinct sequence, strand and frame with its protein and internal stops."""
    each = _proteins(frame, code).select("sequence", F.explode(F.array(*[
        F.struct(F.lit(s).alias("strand"), F.lit(f).alias("frame"), F.get("proteins", F.lit(i)).alias("protein")) for i, (s, f) in enumerate(_FRAMES)])).alias("x"))
    return each.select("sequence", "x.*").withColumn("stop_count", internal_stops(F.col("protein")))


def similarities(frame: DataFrame, code: int = 5, consensus: str = CONSENSUS) -> DataFrame:
    told = _proteins(frame, code).withColumn("similarities", jaro_winkler("proteins", F.lit(consensus)))
    each = told.select("sequence", F.posexplode(F.arrays_zip("proteins", "similarities")).alias("i", "x"))
    strand = F.when(F.col("i") < 3, F.lit("forward")).otherwise(F.lit("reverse"))
    out = each.select("sequence", strand.alias("strand"), (F.col("i") % 3 + 1).alias("frame"), F.col("x.proteins").alias("protein"), F.col("x.similarities").alias("similarity"))
    return out.withColumn("stop_count", internal_stops(F.col("protein")))


def _best(strand: str) -> Column:
    """The most similar frame of a strand; the lower frame wins a tie."""
    own = F.filter("c", lambda x: x["strand"] == strand)
    key = F.transform(own, lambda x: F.struct(x["similarity"].alias("s"), (-x["frame"]).alias("f"), x.alias("x")))
    return F.array_max(key)["x"]


def best_frames(frame: DataFrame, code: int = 5, consensus: str = CONSENSUS) -> DataFrame:
    """A row per distinct sequence and strand: the most similar frame."""
    c = _candidates(_proteins(frame, code), consensus)
    return c.select("sequence", F.explode(F.array(_best("forward"), _best("reverse"))).alias("x")).select("sequence", "x.*")


def choose_strand(frame: DataFrame, code: int = 5, consensus: str = CONSENSUS, tolerance: float = STRAND_TOLERANCE) -> DataFrame:
    """Per distinct sequence the strand to trust: reverse only if clearly more similar, or fairly so with fewer internal
    stops. Six frames of one sequence are compared within its row, so the only shuffle makes sequences distinct."""
    wide = _candidates(_proteins(frame, code), consensus).select("sequence", _best("forward").alias("f"), _best("reverse").alias("r"))
    gain = F.col("r.similarity") - F.col("f.similarity")
    use = (F.col("f.similarity") < F.col("r.similarity")) & ((gain > tolerance) | ((gain > tolerance / 2) & (F.col("r.stop_count") < F.col("f.stop_count"))))
    pick = F.when(use, F.col("r")).otherwise(F.col("f"))
    return wide.select("sequence", F.coalesce(use, F.lit(False)).alias("reversed"), pick["frame"].alias("frame"), pick["protein"].alias("protein"), pick["stop_count"].alias("stop_count"), pick["similarity"].alias("similarity"))


def stop_codon_info(frame: DataFrame, code: int = 5, consensus: str = CONSENSUS) -> DataFrame:
    """Every record with its chosen strand, discarded where that has an internal stop. The sequence stays as it was;
    oriented_sequence follows the strand. Similarities are computed once per distinct sequence."""
    joined = frame.join(choose_strand(frame, code, consensus), "sequence", "left")
    return joined.withColumn("discarded", F.coalesce(F.col("stop_count") > 0, F.lit(False))).withColumn(
        "oriented_sequence", F.when(F.col("reversed"), reverse_complement(F.col("sequence"))).otherwise(F.col("sequence")))


def stop_codon_table(frame: DataFrame, code: int = 5, consensus: str = CONSENSUS) -> DataFrame:
    """The ten columns of the table about the stop codon filter, a row per record."""
    info = stop_codon_info(frame, code, consensus)
    return info.select(
        "header", "discarded", F.coalesce("reversed", F.lit(False)).alias("reversed"), F.col("sequence").alias("nuc_seq"), F.col("protein").alias("prot_seq"),
        F.col("similarity").alias("distance_to_consensus"), F.col("stop_count").alias("stop_codon_count"), "frame",
        F.when(F.col("reversed"), reverse_complement(F.col("sequence"))).alias("nuc_reverse_complement_seq"), F.lit(consensus).alias("used_consensus_seq"))
