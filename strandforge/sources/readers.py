"""FASTA, specimen tables, shapefiles and download folders as DataFrames."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shapefile as shapes
from .genbank import marker_sequence

SPECIMEN = (
    "identifier string, kingdom string, phylum string, class string, `order` string, family string, genus string, species string, "
    "location string, latitude double, longitude double, sequence string"
)


def file_name() -> Column:
    """The name of a row's file, as it is written in its folder."""
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def place(name: Column | None = None) -> Column:
    """Where a row of a file stands: files by name, blocks by where they begin, rows as they come. Orders rows as the
    input has them, however Spark deals the blocks, and no task sees more than its own."""
    name = file_name() if name is None else name
    return F.struct(name.alias("file_name"), "_metadata.file_path", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def _below(spark: SparkSession, path: str) -> Column:
    """A row's file as it is named below `path`, folders included; of a path that is no folder the file's name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    depth = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).depth()
    within = F.regexp_extract("_metadata.file_path", f"^(?:[^:/]+:)?(?://[^/]*)?(?:/[^/]*){{{depth}}}/(.+)$", 1)
    return F.when(within != "", F.url_decode(F.replace(within, F.lit("+"), F.lit("%2B")))).otherwise(file_name())


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row per FASTA record as written: file, pos (`place`), header (with '>'), sequence, n_lines. Files may be
    gzipped. A folder in the folder is one file in parts, as writers leave it, and goes by its own name. Windows line
    ends are removed."""
    name = _below(spark, path)
    text = spark.read.option("lineSep", "\n>").text(path, recursiveFileLookup=True).select(F.substring_index(name, "/", 1).alias("file"), place(name).alias("pos"), F.replace("value", F.lit("\r"), F.lit("")).alias("value"))
    clean = text.withColumn("value", F.when(F.startswith("value", F.lit(">")), F.expr("substring(value, 2)")).otherwise(F.col("value"))).where("value != ''")
    head, ends = F.substring_index("value", "\n", 1), F.length("value") - F.length(F.replace("value", F.lit("\n"), F.lit("")))
    sequence = F.replace(F.substr("value", F.length(head) + 1), F.lit("\n"), F.lit(""))
    # a file's last record keeps its final line end, behind which is no line
    n = ends - F.when((ends > 1) & F.endswith("value", F.lit("\n")), 1).otherwise(0)
    # one empty piece alone is a blank line, or at a file's end no line at all
    blocks = clean.groupBy("pos.file_path", "pos.block").agg(F.max("pos.row").alias("last"))
    last = F.broadcast(blocks.groupBy("file_path").agg(F.max_by("last", "block").alias("last")))  # a row a file
    at_end = (n == 1) & (sequence == "") & (F.col("pos.row") == F.col("last"))
    out = clean.join(last, F.col("pos.file_path") == F.col("file_path"), "left")
    return out.select("file", "pos", F.concat(F.lit(">"), head).alias("header"), sequence.alias("sequence"), F.when(at_end, 0).otherwise(n).alias("n_lines"))


def assemble(parts: DataFrame) -> DataFrame:
    """(header, sequence, pos): records of one header are joined in input order, headers without a body line dropped.
    Takes header, sequence, n_lines, pos."""
    kept = parts.where("n_lines > 0")
    return kept.groupBy("header").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sequence"))), lambda x: x["sequence"]), "").alias("sequence"), F.min("pos").alias("pos")
    )


def fasta(spark: SparkSession, path: str) -> DataFrame:
    return assemble(records(spark, path))


def tagged(file: Column, header: Column) -> Column:
    return F.concat(F.lit(">"), file, F.lit("|"), F.regexp_replace(header, "^>", ""))


def fasta_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All files of a folder; the file's name without its extension is put before each header."""
    read = records(spark, folder).withColumn("header", tagged(F.regexp_replace("file", r"\.[^.]*$", ""), F.col("header")))
    return assemble(read)


def clustered(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, member, header, sequence, pos) of clustered FASTA, headers >cluster|member. A header without a pipe
    begins no record: its line and those behind it are lines of the record before, in the same file. What stands before
    a file's first header with a pipe belongs to nothing and is left out."""
    return cluster_parts(assemble(_carried(records(spark, path)))).select("cluster", "member", "header", "sequence", "pos")


def _carried(parts: DataFrame) -> DataFrame:
    """Records without a pipe as further lines of the last record with one. The last header of each block of a file goes
    from block to block, a row a block; only blocks that hold such records are sorted, of other records the headers."""
    parts = parts.withColumn("piped", F.instr("header", "|") > 0)
    told = parts.select("file", "pos", F.col("pos.file_path").alias("path"), F.col("pos.block").alias("block"), F.when(F.col("piped"), F.col("header")).alias("own"),
                        F.when(~F.col("piped"), F.concat("header", "sequence")).alias("sequence"), (F.col("n_lines") + 1).alias("n_lines"))
    blocks = told.groupBy("path", "block").agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.col("pos.row"))).alias("last"), F.max(F.col("own").isNull()).alias("loose"))
    before = F.last("last", ignorenulls=True).over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    carried = blocks.select("path", "block", "loose", before.alias("before")).where("loose")
    inside = F.last("own", ignorenulls=True).over(W.partitionBy("path", "block").orderBy("pos.row"))
    loose = told.join(F.broadcast(carried), ["path", "block"]).withColumn("header", F.coalesce(inside, "before")).where("own is null and header is not null")
    return parts.where("piped").select("file", "pos", "header", "sequence", "n_lines").unionByName(loose.select("file", "pos", "header", "sequence", "n_lines"))


def cluster_parts(frame: DataFrame) -> DataFrame:
    """Adds cluster, member and rejected: the part before the header's first pipe, the rest, and whether there is no pipe."""
    bare = F.regexp_replace("header", "^>", "")
    return frame.withColumns({
        "cluster": F.when(F.instr(bare, "|") > 0, F.substring_index(bare, "|", 1)),
        "member": F.when(F.instr(bare, "|") > 0, F.regexp_extract(bare, r"^[^|]*\|(.*)$", 1)),
        "rejected": F.instr(bare, "|") == 0,
    })


def specimens(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated specimen table with a header row, whose columns may stand in any order; further ones are left out,
    missing ones empty. Quotes are text like any other. Blank coordinates are null, blank text stays empty."""
    names = [f.name for f in T.StructType.fromDDL(SPECIMEN).fields]
    read = _tsv(spark, path, names, placed=True)
    text = {c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names if c not in ("latitude", "longitude")}
    return read.withColumns(text | {c: F.expr(f"try_cast({c} AS double)") for c in ("latitude", "longitude")})


#: What sources call a marker; names of genes and products in lower case, with blanks for what joins words.
MARKERS = {"co1": {
    "bold": "COI-5P", "midori": "co1", "genes": frozenset(["co1", "coi", "cox1", "coxi", "cox 1", "co i", "coi 5p", "mt co1", "mtco1"]),
    "products": frozenset(f"{enzyme} subunit {n}" for enzyme in ("cytochrome c oxidase", "cytochrome oxidase", "cytochrome c oxydase") for n in ("1", "i"))}}
#: Names of genes in names of MIDORI's files.
MIDORI_GENES = ["A6", "A8", "CO1", "CO2", "CO3", "Cytb", "ND1", "ND2", "ND3", "ND4", "ND4L", "ND5", "ND6", "lrRNA", "srRNA"]

#: What every source comes to: the columns of `SPECIMEN` with order_name for `order`, country, marker and source.
RECORD = ["identifier", "kingdom", "phylum", "class", "order_name", "family", "genus", "species", "country", "location", "latitude", "longitude", "sequence", "source"]


def _record(frame: DataFrame, source: str, given: dict[str, Column]) -> DataFrame:
    """Columns of `RECORD`: names and sequences are never null, "None" and blanks are empty; places may be null."""
    text = lambda c: F.coalesce(F.when(~F.lower(F.trim(c)).isin("none", "null", "n/a"), F.trim(c)), F.lit(""))
    out = {c: text(given.get(c, F.lit(""))) for c in RECORD}
    out |= {c: F.when(out[c] != "", out[c]) for c in ("country", "location")}
    out |= {c: given.get(c, F.lit(None)).try_cast("double") for c in ("latitude", "longitude")} | {"source": F.lit(source)}
    return frame.select(*[out[c].alias(c) for c in RECORD], *[c for c in ("pos",) if c in frame.columns]).where("sequence != ''")


def _tsv(spark: SparkSession, path: str, columns: list[str], placed: bool = False) -> DataFrame:
    """The named columns of a tab-separated table with a header row, as text; further ones are not read, missing ones
    are null. Cells hold no quotes of the format's own. `placed` adds pos (`place`)."""
    head = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)
    return head.select(*[place().alias("pos")] * placed, *[F.col(f"`{c}`").cast("string").alias(c) if c in head.columns else F.lit(None).cast("string").alias(c) for c in columns])


def specimen_records(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A specimen table (`specimens`) as records; the country is the last part of the location."""
    given = {c: F.col(f"`{c}`") for c in ("identifier", "kingdom", "phylum", "class", "family", "genus", "species", "location", "latitude", "longitude", "sequence")}
    return _record(specimens(spark, path), source, given | {"order_name": F.col("order"), "country": F.trim(F.element_at(F.split("location", ","), -1))})


def bold_release(spark: SparkSession, path: str, marker: str = "co1") -> DataFrame:
    """The table of a BOLD data package: records of one marker. Coordinates stand in brackets, latitude first."""
    names = ["kingdom", "phylum", "class", "order", "family", "genus", "species"]
    t = _tsv(spark, path, ["processid", *names, "marker_code", "nuc", "country/ocean", "province/state", "coord"], placed=True)
    number = lambda k: F.regexp_extract("coord", r"(-?\d+(?:\.\d+)?)[^\d.-]+(-?\d+(?:\.\d+)?)", k)
    given = {("order_name" if c == "order" else c): F.col(c) for c in names}
    given |= {"identifier": F.col("processid"), "country": F.col("`country/ocean`"), "location": F.col("`province/state`"), "latitude": number(1), "longitude": number(2), "sequence": F.col("nuc")}
    return _record(t.where(F.col("marker_code") == MARKERS[marker]["bold"]), "BOLD", given)


def bold_downloads(spark: SparkSession, path: str, marker: str = "co1") -> DataFrame:
    """Files of a BOLD download folder, one per taxon: tables of specimens and sequences. All of BOLD's are animals."""
    ranks = ["phylum", "class", "order", "family", "genus", "species"]
    t = _tsv(spark, path, ["processid", *[f"{r}_name" for r in ranks], "country", "province_state", "lat", "lon", "markercode", "nucleotides"], placed=True)
    given = {("order_name" if r == "order" else r): F.col(f"{r}_name") for r in ranks}
    given |= {"identifier": F.col("processid"), "kingdom": F.lit("Animalia"), "country": F.col("country"), "location": F.col("province_state"), "latitude": F.col("lat"), "longitude": F.col("lon"), "sequence": F.col("nucleotides")}
    return _record(t.where(F.col("markercode") == MARKERS[marker]["bold"]), "BOLD", given)


def gbol(spark: SparkSession, path: str) -> DataFrame:
    """A GBOL dataset release: tab-separated, higher taxa in one cell from the kingdom down, joined by commas, the
    species in its own; Germany's barcodes."""
    t = _tsv(spark, path, ["CatalogueNumber", "HigherTaxa", "Species", "Location", "Latitude", "Longitude", "BarcodeSequence"], placed=True)
    taxa = F.split(F.coalesce("HigherTaxa", F.lit("")), r"\s*,\s*")
    given = {c: F.get(taxa, F.lit(i)) for i, c in enumerate(["kingdom", "phylum", "class", "order_name", "family"])}
    species = F.trim(F.col("Species"))
    given |= {"identifier": F.col("CatalogueNumber"), "genus": F.regexp_extract(species, r"^(\S+)", 1), "species": F.when(F.instr(species, " ") > 0, species), "country": F.lit("Germany"),
              "location": F.col("Location"), "latitude": F.col("Latitude"), "longitude": F.col("Longitude"), "sequence": F.col("BarcodeSequence")}
    return _record(t, "GBOL", given)


def genbank(spark: SparkSession, path: str, marker: str = "co1") -> DataFrame:
    """GenBank flat files, plain or gzipped: the marker as the feature table of each record tells where it lies, so it is
    cut out of whole genomes, and records of other genes are left out. Files may lie in folders below `path`. The lineage's ranks are not named there: species
    and genus come from the organism's name, the others are left to the taxonomy."""
    t = spark.read.option("lineSep", "\n//").text(path, recursiveFileLookup=True).select("value", place().alias("pos")).where(F.col("value").rlike(r"(?m)^ORIGIN"))
    own = lambda pattern: F.regexp_extract("value", pattern, 1)
    organism = own(r"(?m)^  ORGANISM  (.*)$")
    origin = own(r'/(?:geo_loc_name|country)="([^"]*)"')
    side = lambda k: F.regexp_extract("value", r'/lat_lon="([\d.]+) ([NS]) ([\d.]+) ([EW])"', k)
    degrees = lambda k, minus: F.when(side(k) != "", F.concat(F.when(side(k + 1) == minus, F.lit("-")).otherwise(F.lit("")), side(k)))
    named = organism.rlike(r"^[A-Z][a-z]+ [a-z-]+$")  # two words: not "sp.", no codes
    given = {"identifier": own(r"(?m)^ACCESSION   (\S+)"), "genus": F.when(organism.rlike(r"^[A-Z][a-z]+"), F.regexp_extract(organism, r"^([A-Z][a-z]+)", 1)), "species": F.when(named, organism),
             "country": F.trim(F.substring_index(origin, ":", 1)), "location": F.when(F.instr(origin, ":") > 0, F.trim(F.regexp_replace(origin, r"^[^:]*:", ""))), "latitude": degrees(1, "S"), "longitude": degrees(3, "W")}
    cut = marker_sequence(MARKERS[marker]["genes"], MARKERS[marker]["products"])
    return _record(t.withColumn("sequence", cut("value")), "GENBANK", given | {"sequence": F.col("sequence")})


def midori(spark: SparkSession, path: str, marker: str = "co1") -> DataFrame:
    """A MIDORI archive: FASTA whose headers end in root;kingdom;phylum;class;order;family;genus;species, each with the
    taxon's id behind an underscore. Placeholders for missing ranks, which repeat a name of a coarser one, are empty.
    Files whose names name another gene are left out."""
    gene = F.regexp_extract("file", rf"(?i)_({'|'.join(MIDORI_GENES)})_", 1)
    parts = records(spark, path).where((gene == "") | (F.lower(gene) == MARKERS[marker]["midori"]))
    t = degapped(assemble(parts))
    line = F.regexp_extract("header", r"(root(?:_\d+)?;.*)$", 1)
    parts = F.transform(F.split(line, ";"), lambda x: F.regexp_replace(F.regexp_replace(x, r"_\d+$", ""), "^(?:phylum|class|order|family|genus|species)_.*$", ""))
    given = {c: F.get(parts, F.lit(i + 1)) for i, c in enumerate(["kingdom", "phylum", "class", "order_name", "family", "genus", "species"])}
    return _record(t, "MIDORI", given | {"identifier": F.regexp_extract("header", r"^>([^.\s#]+)", 1), "sequence": F.col("sequence")})


def degapped(frame: DataFrame) -> DataFrame:
    return frame.withColumn("sequence", F.replace("sequence", F.lit("-"), F.lit("")))


TAXONOMY = ["taxon_id", "parent_id", "name", "rank", "status", "accepted_id", "is_extinct"]


def ncbi_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """nodes.dmp and names.dmp of the NCBI taxonomy as a backbone: the scientific name of each taxon, and its synonyms as
    taxa of their own (ids from their place in the list, negative), accepted as the taxon they stand for."""
    cut = lambda name: spark.read.text(f"{folder}/{name}").select(F.split(F.regexp_replace("value", r"\t?\|\s*$", ""), r"\t\|\t", -1).alias("c"))
    at = lambda i: F.get("c", F.lit(i))
    nodes = cut("nodes.dmp").select(at(0).cast("long").alias("taxon_id"), at(1).cast("long").alias("parent_id"), at(2).alias("rank"))
    names = cut("names.dmp").select(at(0).cast("long").alias("taxon_id"), at(1).alias("name"), at(3).alias("kind"))
    nodes = nodes.withColumn("parent_id", F.when(F.col("parent_id") != F.col("taxon_id"), F.col("parent_id")))  # the root is its own parent
    good = nodes.join(names.where("kind = 'scientific name'").drop("kind"), "taxon_id").select("taxon_id", "parent_id", "name", "rank", F.lit("accepted").alias("status"), F.lit(None).cast("long").alias("accepted_id"), F.lit(False).alias("is_extinct"))
    other = names.where("kind = 'synonym'").select(F.col("taxon_id").alias("accepted_id"), "name").distinct()
    # some ten thousand million apart from real ids, and the same whenever it is read
    other = other.join(nodes.withColumnRenamed("taxon_id", "accepted_id"), "accepted_id").select(
        (-F.abs(F.xxhash64("accepted_id", "name") % F.lit(2**62)) - 1).alias("taxon_id"), "parent_id", "name", "rank", F.lit("synonym").alias("status"), "accepted_id", F.lit(False).alias("is_extinct"))
    return good.unionByName(other).select(*TAXONOMY)


def gbif_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """Taxon.tsv of the GBIF backbone, with what SpeciesProfile.tsv says of extinction. Doubtful taxa count as accepted,
    all else that names an accepted taxon as a synonym."""
    t = _tsv(spark, f"{folder}/Taxon.tsv", ["taxonID", "parentNameUsageID", "acceptedNameUsageID", "canonicalName", "taxonRank", "taxonomicStatus"])
    gone = _tsv(spark, f"{folder}/SpeciesProfile.tsv", ["taxonID", "isExtinct"]).where("isExtinct = 'true'").select(F.col("taxonID").cast("long").alias("taxon_id")).distinct().withColumn("gone", F.lit(True))
    accepted = F.col("acceptedNameUsageID").cast("long")
    out = t.where("canonicalName is not null").select(F.col("taxonID").cast("long").alias("taxon_id"), F.col("parentNameUsageID").cast("long").alias("parent_id"), F.col("canonicalName").alias("name"),
                                                      F.lower("taxonRank").alias("rank"), F.when(accepted.isNull(), F.lit("accepted")).otherwise(F.lit("synonym")).alias("status"), accepted.alias("accepted_id"))
    return out.join(gone, "taxon_id", "left").withColumn("is_extinct", F.coalesce("gone", F.lit(False))).select(*TAXONOMY)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, taxon, time) of the downloads in a folder, wherever Spark can list. Names are <taxon>-<time>; what has no
    such name, or is called a release, holds a source whole and has no taxon. Numbers of releases count as times."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [x.getPath() for x in files.listStatus(path)] if files.exists(path) else []
    rows = spark.createDataFrame([(x.toString(), x.getName()) for x in found], "path string, name string")
    timed = r"^(.*)-(\d{8}(?:T\d{4,6})?)$"
    taxon = F.regexp_extract("name", timed, 1)
    number = F.regexp_extract("name", r"(\d+)\D*$", 1)
    return rows.select("path", F.when((taxon != "") & ~F.lower(taxon).contains("release"), F.replace(taxon, F.lit("_"), F.lit(" "))).alias("taxon"),
                       F.when(F.regexp_extract("name", timed, 2) != "", F.regexp_extract("name", timed, 2)).otherwise(F.lpad(number, 8, "0")).alias("time"))


def covering(downloads: DataFrame, taxa: list[str]) -> str:
    """The newest download that holds a taxon: one of a whole source, or one whose taxon is among `taxa`, which are the
    taxon's own name and those of its ancestors. Of equally new ones the one of the lowest taxon."""
    known = downloads.where(F.col("taxon").isNull() | F.col("taxon").isin(taxa))
    depth = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in taxa]), F.col("taxon")), F.lit(0))
    first = known.orderBy(F.desc("time"), F.desc(depth), F.desc("path")).limit(1).collect()
    if not first:
        raise ValueError(f"no download holds {taxa[-1]}")
    return first[0].path


def replacements(spark: SparkSession, path: str) -> DataFrame:
    """A replacement file: taxon_rank, taxon_to_replace, taxon_to_use."""
    return _tsv(spark, path, ["taxon_rank", "taxon_to_replace", "taxon_to_use"])


def union_sources(*frames: DataFrame) -> DataFrame:
    first, *rest = frames
    for x in rest:
        first = first.unionByName(x, allowMissingColumns=True)
    return first


def shapefile(spark: SparkSession, path: str, attribute: str, values: list[str]) -> DataFrame:
    """(name, shape, rings): the polygons whose `attribute` is one of `values`, each with all its rings, holes among
    them. `path` names the .shp; .shx and .dbf lie beside it. Tasks read ranges of shapes as the index tells. Where that is
    missing, or the store is one that only Spark knows, the files are read whole, 2 GB at most, by one task."""
    if shapes.splittable(path):
        spark.dataSource.register(shapes.Shapefile)
        push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
        read = spark.read.format("shapefile").option("attribute", attribute).option("values", json.dumps(list(values))).option("push", push).load(path)
        return read.where(F.col("name").isin(list(values)))
    stem = path.removesuffix(".shp")
    shp = spark.read.format("binaryFile").load(path).select(F.col("content").alias("shp"))
    dbf = spark.read.format("binaryFile").load(f"{stem}.dbf").select(F.col("content").alias("dbf"))

    def parse(batches):
        for b in batches:
            for data, table in zip(b.column("shp").to_pylist(), b.column("dbf").to_pylist(), strict=True):
                own, at, i, rows = shapes.attribute(table[: int.from_bytes(table[8:10], "little")], attribute), 100, 0, []
                while at + 8 <= len(data):
                    size, begin = 2 * int.from_bytes(data[at + 4: at + 8], "big"), own.head + i * own.width + own.offset
                    name = table[begin: begin + own.size].decode("utf-8", "replace").strip()
                    if name in values:
                        rows.append((name, i, shapes.rings(data[at + 8: at + 8 + size])))
                    at, i = at + 8 + size, i + 1
                kind = pa.list_(pa.list_(pa.struct([("lon", pa.float64()), ("lat", pa.float64())])))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), kind))], ["name", "shape", "rings"])

    return shp.join(dbf).mapInArrow(parse, shapes.SCHEMA)  # one row on either side
