"""From sources to reference databases: read, harmonize, filter, select by place, dereplicate, write."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import derep, region, sequence, taxonomy
from ..sources import readers, writers
from ..sources.scratch import clear, held, written
from .config import Parameters, run_folder

RANKS = [taxonomy.COLUMNS[r] for r in reversed(taxonomy.RANKS)]


#: Folders of downloads, where they are not called like their source.
_FOLDERS = {"genbank": "NCBIGENBANK"}


def sources(spark: SparkSession, params: Parameters, downloaded: str = "downloads", taxa: list[str] | None = None) -> dict[str, DataFrame]:
    """Records of each source that the parameters name: from the folder given for it, or from the newest download that
    holds the taxon. `taxa`: the taxon and what lies above it, from the root down."""
    of = {"marker": params.marker}
    read = {"gbol": (readers.gbol, {}), "bold": (readers.bold_downloads, of), "genbank": (readers.genbank, of), "midori": (readers.midori, of)}
    out = {}
    for name in params.sources:
        if name == "bold" and (path := params.folders.get("bold_release")):
            out[name] = readers.bold_release(spark, path, **of)
        else:
            path = params.folders.get(name) or readers.covering(readers.manifest(spark, f"{downloaded}/{_FOLDERS.get(name, name.upper())}"), taxa or [params.taxon])
            reader, more = read[name]
            out[name] = reader(spark, path, **more)
    # rows as they come, source after source
    return {name: df.withColumn("pos", F.struct(F.lit(i).alias("source"), "pos")) for i, (name, df) in enumerate(out.items())}


def harmonized(records: DataFrame, params: Parameters, backbone: DataFrame | None, lines: DataFrame | None = None) -> DataFrame:
    """Standard ranks as the chosen taxonomy has them, restricted to the taxon asked for."""
    if backbone is None:
        told = taxonomy.harmonized(records, None)
        return told.where(reduce(lambda a, b: a | b, [F.col(r) == params.taxon for r in RANKS]))
    lines = taxonomy.lineages(backbone) if lines is None else lines
    told = taxonomy.harmonized(records, None if params.taxonomy == "unmapped" else backbone, params.retain, params.synonyms_allowed, lines)
    return taxonomy.subset(told, params.taxon, backbone, lines=lines)


def filtered(records: DataFrame, params: Parameters) -> DataFrame:
    out = records
    if params.max_n is not None:
        out = sequence.max_char(out, "N", params.max_n)
    if params.max_g is not None:
        out = sequence.max_char(out, "-", params.max_g)
    if params.min_length is not None or params.max_length is not None:
        out = sequence.length_range(out, params.min_length, params.max_length)
    return taxonomy.at_least(out, params.taxon_rank) if params.taxon_rank else out


def placed(records: DataFrame, params: Parameters, countries: DataFrame | None = None, polygons: dict[str, DataFrame] | None = None) -> DataFrame:
    """Records of the places asked for: of one of the countries or continents, and inside one of the regions of each
    kind. `polygons` holds the shapes of realms and ecoregions; a custom shapefile is read."""
    out, asked = records, params.region
    if asked.get("continents"):
        out = region.by_continent(out, countries, list(asked["continents"]), list(asked.get("countries", ())))
    elif asked.get("countries"):
        out = region.by_country(out, list(asked["countries"]))
    shapes = [(polygons[k], list(asked[k])) for k in ("realms", "ecoregions") if asked.get(k)]
    if params.shapefile:
        own = params.shapefile
        shapes.append((readers.shapefile(records.sparkSession, own["path"], own["attribute"], list(own["values"])), list(own["values"])))
    for shape, names in shapes:
        # in one of them is enough: one region of all names, so no record comes twice
        whole = shape.where(F.col("name").isin(names)).withColumn("name", F.lit("any"))
        out = region.by_polygon(out, whole).drop("region")
    return out


def dereplicated(records: DataFrame, strategy: str | None) -> DataFrame:
    """One record per sequence by the strategy, with the number of specimens; the identifier, source and place of the
    first record that has the lineage, or of the first with the sequence where the lineage is a common ancestor."""
    if strategy is None:
        return records.withColumn("specimens", F.lit(1).cast("long"))
    taxa = F.array(*[F.coalesce(F.col(r), F.lit("")) for r in RANKS])
    # unknown ranks at the end do not count for the depth; an inner gap stays
    known = F.transform(F.split(F.regexp_replace(F.array_join(taxa, "|"), r"[|]+$", ""), r"\|", -1), lambda x: x)
    told = records.withColumn("taxa", F.when(F.array_join(taxa, "") == "", F.array().cast("array<string>")).otherwise(known))
    kept = {"lca": derep.common, "first": derep.keep_first, "discard": derep.discard}[strategy](told).select("sequence", F.col("taxa").alias("agreed"))
    first = told.join(kept, "sequence").groupBy("sequence").agg(
        F.first("agreed").alias("agreed"), F.count(F.lit(1)).alias("specimens"), F.min("pos").alias("pos"),
        F.min(F.struct((F.col("taxa") != F.col("agreed")).alias("other"), "pos", "identifier", "source", "country", "location", "latitude", "longitude", "taxon_id")).alias("r"))
    rank = {c: F.coalesce(F.get("agreed", F.lit(i)), F.lit("")) for i, c in enumerate(RANKS)}
    return first.select(F.col("r.identifier").alias("identifier"), *[x.alias(c) for c, x in rank.items()], "r.country", "r.location", "r.latitude", "r.longitude", "sequence", "r.source",
                        F.when(~F.col("r.other"), F.col("r.taxon_id")).alias("taxon_id"), "specimens", "pos")


def comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per record its lineage as it came and as it was harmonized. Records are told apart by `pos`, as identifiers may
    repeat."""
    line = lambda df: df.select("pos", "identifier", "source", F.regexp_replace(F.concat_ws("|", *[F.coalesce(F.col(r), F.lit("")) for r in RANKS]), r"[|]+$", "").alias("lineage"))
    a, b = line(before), line(after)
    out = a.withColumnRenamed("lineage", "lineage_before").join(b.select("pos", F.col("lineage").alias("lineage_after")), "pos")
    return out.withColumn("changed", F.col("lineage_before") != F.col("lineage_after"))


def classify(given: dict[str, DataFrame], params: Parameters, backbone: DataFrame | None = None, countries: DataFrame | None = None, polygons: dict[str, DataFrame] | None = None, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """The outputs asked for, by name. `given`: records of each source. Cheap filters come before the taxonomy and the
    places; what several outputs share is written once."""
    if params.region and (unknown := _unknown(params, countries, polygons or {})):
        raise ValueError(f"unknown places: {', '.join(unknown)}")
    records = readers.union_sources(*given.values())
    if "pos" not in records.columns:
        records = records.withColumn("pos", F.monotonically_increasing_id())
    records = written(records, "records")  # numbers of rows hold from here on
    cheap = filtered(records, params)
    told = harmonized(placed(cheap, params, countries, polygons), params, backbone, lines)
    told = filtered(told, Parameters(taxon_rank=params.taxon_rank))  # harmonizing may leave fewer ranks
    told = written(told, "harmonized")
    final = dereplicated(told, params.strategy())
    if params.strategy():
        final = written(final, "dereplicated")
    make = {
        "table": lambda: writers.table(final), "fasta": lambda: writers.lineage_fasta(final), "comparison": lambda: comparison(records, told), "qiime2": lambda: writers.qiime2_taxonomy(final),
        "kraken2": lambda: writers.kraken2(final), "dada2_taxonomy": lambda: writers.dada2_taxonomy(final), "dada2_species": lambda: writers.dada2_species(final), "sintax": lambda: writers.sintax(final),
    }
    out = {name: make[name]() for name in params.outputs}
    if "qiime2" in out:
        out["qiime2_fasta"] = final.select(F.concat(F.lit(">"), "identifier").alias("header"), "sequence", "pos")
    return out


def _unknown(params: Parameters, countries: DataFrame | None, polygons: dict[str, DataFrame]) -> list[str]:
    """Names of places that are none. Countries are taken as they are where there is no table of them; everything else
    needs its table."""
    found, asked = [], params.region
    for column, kind, table in (("country", "countries", countries), ("continent", "continents", countries), *[("name", k, polygons.get(k)) for k in ("realms", "ecoregions")]):
        if asked.get(kind):
            if table is not None:
                found += [r.name for r in region.unknown_names(table.sparkSession, list(asked[kind]), table, column).collect()]
            elif kind != "countries":
                raise ValueError(f"there is no table of {kind}")
    return found


#: Output -> end of its file's name, and how it is written.
_FILES = {"table": ("output.tsv", writers.write_tsv), "fasta": ("output.fas", writers.write_fasta), "comparison": ("comparison.tsv", writers.write_tsv), "qiime2": ("qiime2_taxonomy.txt", lambda df, p: writers.write_tsv(df, p, header=False)),
          "qiime2_fasta": ("qiime2_taxonomy.fas", writers.write_fasta), "kraken2": ("kraken2.fas", writers.write_fasta), "dada2_taxonomy": ("dada2_taxonomy.fas", writers.write_fasta), "dada2_species": ("dada2_species.fas", writers.write_fasta), "sintax": ("sintax.fas", writers.write_fasta)}


def run(spark: SparkSession, params: Parameters, folder: str, at: datetime, backbone: DataFrame | None = None, countries: DataFrame | None = None, polygons: dict[str, DataFrame] | None = None, downloaded: str = "downloads") -> dict[str, str]:
    """Classifies and writes everything under `folder`/<taxon>-<time>: paths by output. Files are called merged_... or,
    if dereplicated, <taxon>_derep_all_...; without merging each source has files of its own. The parameters, and how
    many records each source gave, lie beside them."""
    params, others = params.checked(), held()
    lines = taxonomy.lineages(backbone) if backbone is not None else None
    taxa = taxonomy.ancestors(lines, taxonomy.taxon(backbone, params.taxon)[0]) if lines is not None else None
    base, given, out = f"{folder}/{run_folder(params.taxon, at)}", sources(spark, params, downloaded, taxa), {}
    groups = {(f"{params.taxon}_derep_all" if params.strategy() else "merged"): given} if params.merge else {name: {name: df} for name, df in given.items()}
    for name, own in groups.items():
        for kind, frame in classify(own, params, backbone, countries, polygons, lines).items():
            end, write = _FILES[kind]
            out[f"{name}_{end}"] = path = f"{base}/{name}_{end}"
            write(frame, path)
    told = {"parameters.txt": params.described(), "parameters.json": params.kept()} | {f"{name}_download_info.txt": f"records: {df.count()}" for name, df in given.items()}
    for name, text in told.items():
        out[name] = f"{base}/{name}"
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(out[name])
    clear(spark, others)  # all that was written on the way
    return out


def again(spark: SparkSession, run_: str, folder: str, at: datetime, **tables) -> dict[str, str]:
    """Another run with the parameters of an earlier one, whose folder is `run_`. `tables`: what `run` takes."""
    text = "\n".join(r.value for r in spark.read.text(f"{run_}/parameters.json").collect())
    return run(spark, Parameters.of(text), folder, at, **tables)
