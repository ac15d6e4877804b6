"""Named queries over the driver's tables, each with the SQL it is held against.

The tables are not biological: a portable `barcode` view derives specimens from orders, and a small backbone taxonomy
and country table from the same tables. Both are texts that Spark and DuckDB run alike.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import genetic_code, header_taxa, reverse_complement
from ..operators import contaminants, derep, lineage, region, sequence, taxonomy
from ..sources import readers, writers
from ..sources.scratch import put, shared_path, written
from . import classify as chain
from .config import Parameters

BARCODE = """
SELECT o.o_orderkey AS pos, concat('SPC', CAST(o.o_orderkey AS STRING)) AS identifier,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'GBOL' WHEN 1 THEN 'BOLD' ELSE 'GENBANK' END AS source,
  'Animalia' AS kingdom, r.r_name AS phylum, n.n_name AS class,
  CASE WHEN o.o_orderkey % 17 = 0 THEN '' ELSE c.c_mktsegment END AS order_name,
  concat('Fam', CAST(c.c_custkey % 40 AS STRING)) AS family,
  CASE WHEN o.o_orderkey % 11 = 0 THEN '' ELSE concat('Gen', CAST(c.c_custkey % 80 AS STRING)) END AS genus,
  CASE WHEN o.o_orderkey % 11 = 0 OR o.o_orderkey % 4 = 0 THEN ''
       ELSE concat('Gen', CAST(c.c_custkey % 80 AS STRING), ' sp', CAST(o.o_orderkey % 2 AS STRING)) END AS species,
  CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE n.n_name END AS country,
  CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE CAST(o.o_orderkey * 37 % 180 - 90 AS DOUBLE) END AS latitude,
  CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE CAST(o.o_orderkey * 53 % 360 - 180 AS DOUBLE) END AS longitude,
  concat(CASE WHEN o.o_orderkey % 13 = 0 THEN 'NNNNN' ELSE '' END,
         translate(concat(md5(concat('a', CAST(c.c_custkey % 300 AS STRING))), md5(concat('b', CAST(c.c_custkey % 300 AS STRING)))), '0123456789abcdef', 'ACGTACGTACGTACGT'),
         CASE WHEN o.o_orderkey % 7 = 0 THEN '---' ELSE '' END,
         translate(md5(concat('c', CAST(c.c_custkey % 300 AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT')) AS sequence
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey"""

BACKBONE = """
SELECT 1 AS taxon_id, CAST(NULL AS INT) AS parent_id, 'Animalia' AS name, 'kingdom' AS rank, 'accepted' AS status, CAST(NULL AS INT) AS accepted_id, FALSE AS is_extinct
UNION ALL SELECT 100 + r_regionkey, 1, r_name, 'phylum', 'accepted', CAST(NULL AS INT), FALSE FROM {region}
UNION ALL SELECT 200 + n_nationkey, 100 + n_regionkey, n_name, 'class', 'accepted', CAST(NULL AS INT), FALSE FROM {nation}
UNION ALL SELECT DISTINCT CAST(1000 + c_custkey % 40 AS INT), CAST(200 + c_custkey % 25 * 0 + c_custkey % 40 % 25 AS INT), concat('Fam', CAST(c_custkey % 40 AS STRING)), 'family', 'accepted', CAST(NULL AS INT), c_custkey % 40 = 7 FROM {customer}
UNION ALL SELECT DISTINCT CAST(3000 + c_custkey % 40 AS INT), CAST(1000 + c_custkey % 40 AS INT), concat('Sub', CAST(c_custkey % 40 AS STRING)), 'subfamily', 'accepted', CAST(NULL AS INT), FALSE FROM {customer}
UNION ALL SELECT DISTINCT CAST(4000 + c_custkey % 10 AS INT), CAST(3000 + (c_custkey + 1) % 10 AS INT), concat('Tri', CAST(c_custkey % 10 AS STRING)), 'tribe', 'accepted', CAST(NULL AS INT), FALSE FROM {customer}
UNION ALL SELECT DISTINCT CAST(2000 + c_custkey % 80 AS INT), CAST(3000 + c_custkey % 40 AS INT), concat('Gen', CAST(c_custkey % 80 AS STRING)), 'genus',
  CASE WHEN c_custkey % 80 % 7 = 0 THEN 'synonym' ELSE 'accepted' END, CASE WHEN c_custkey % 80 % 7 = 0 THEN CAST(2000 + (c_custkey % 80 + 1) % 80 AS INT) END, FALSE FROM {customer}
UNION ALL SELECT DISTINCT CAST(5000 + c_custkey % 10 AS INT), CAST(4000 + c_custkey % 10 AS INT), concat('Gen', CAST(c_custkey % 10 AS STRING)), 'genus', 'accepted', CAST(NULL AS INT), FALSE FROM {customer}
UNION ALL SELECT DISTINCT CAST(6000 + c_custkey % 80 AS INT), CAST(2000 + c_custkey % 80 AS INT), concat('Gen', CAST(c_custkey % 80 AS STRING), ' sp1'), 'species', 'accepted', CAST(NULL AS INT), FALSE FROM {customer}"""

COUNTRIES = "SELECT n.n_name AS country, r.r_name AS continent FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey"

_TABLES = ("orders", "customer", "nation", "region")

#: Shapes as rings (lon, lat), the first around the others, by layer and name; some are concave, some have holes.
POLYGONS = {
    "realm": {"Nearctic": [[(-170.0, 15.0), (-50.0, 15.0), (-50.0, 80.0), (-170.0, 80.0)]], "Palaearctic": [[(-15.0, 25.0), (175.0, 25.0), (175.0, 80.0), (-15.0, 80.0)]], "Neotropic": [[(-110.0, -55.0), (-35.0, -55.0), (-35.0, 15.0), (-110.0, 15.0)]]},
    "ecoregion": {"Horseshoe": [[(0.5, 0.5), (60.5, 0.5), (60.5, 60.5), (40.5, 60.5), (40.5, 20.5), (20.5, 20.5), (20.5, 60.5), (0.5, 60.5)]]},
    "custom": {"Plot": [[(-100.5, -70.5), (60.5, -70.5), (60.5, 40.5), (-100.5, 40.5)], [(-60.5, -40.5), (-60.5, 10.5), (20.5, 10.5), (20.5, -40.5)]], "Elsewhere": [[(100.5, -40.5), (120.5, -70.5), (130.5, -10.5)]]},
}
RENAMES = [("genus", "Gen3", "Novum"), ("phylum", "ASIA", "Asiata"), ("class", "NATION_4", "Sina"), ("species", "Gen4 sp1", "Gen4 prima")]
RATIO = 1.5


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES if f"{{{t}}}" in text})


def _plain(text: str) -> str:
    return text.format(**{t: t for t in _TABLES})


def barcode(spark, sf_dir):
    return _sql(spark, sf_dir, BARCODE)


def backbone(spark, sf_dir):
    return _sql(spark, sf_dir, BACKBONE)


def countries(spark, sf_dir):
    return _sql(spark, sf_dir, COUNTRIES)


HEADER = "concat('>', concat_ws('|', identifier, kingdom, phylum, class, order_name, family, genus, species))"


def headed(spark, sf_dir):
    return barcode(spark, sf_dir).withColumn("header", F.expr(HEADER))


def members(spark, sf_dir):
    """Specimens clustered by sequence."""
    return headed(spark, sf_dir).withColumn("taxa", header_taxa(F.col("header"))).withColumn("cluster", F.substring(F.md5("sequence"), 1, 12)).select("cluster", "identifier", "header", "taxa", "sequence", "pos")


def polygons(spark, layer):
    rows = [(n, [[{"lon": x, "lat": y} for x, y in ring] for ring in rings]) for n, rings in POLYGONS[layer].items()]
    return spark.createDataFrame(rows, "name string, rings array<array<struct<lon:double,lat:double>>>")


def counts(spark, sf_dir):
    return lineage.lineage_counts(members(spark, sf_dir))


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("taxa", F.array_join("taxa", "|"))


_Q, _O = {}, {}


def query(name: str, sql: str | None):
    """Registers a query and its oracle; the oracle may use the views barcode, headed, members, counts, ordered, backbone."""
    def put(f):
        _Q[name] = f
        if sql is not None:
            _O[name] = _with(sql)
        return f
    return put


_TAXA = "CASE WHEN strpos(rtrim(substr(header, 2), '|'), '|') > 0 THEN string_split(substr(rtrim(substr(header, 2), '|'), strpos(substr(header, 2), '|') + 1), '|') ELSE [] END"
_VIEWS = {
    "barcode": _plain(BARCODE),
    "backbone": _plain(BACKBONE),
    "countries": _plain(COUNTRIES),
    "headed": f"SELECT *, {HEADER} AS header FROM barcode",
    "members": f"SELECT substr(md5(sequence), 1, 12) AS cluster, identifier, header, {_TAXA} AS taxa, sequence, pos FROM headed",
    "counts": "SELECT cluster, taxa, count(*) AS count FROM members GROUP BY cluster, taxa",
    "ordered": "SELECT cluster, list(taxa ORDER BY len(taxa) DESC, count DESC, array_to_string(taxa, '|') DESC) AS l, list(count ORDER BY len(taxa) DESC, count DESC, array_to_string(taxa, '|') DESC) AS n FROM counts GROUP BY cluster",
}
_NEEDS = {"headed": ["barcode"], "members": ["headed"], "counts": ["members"], "ordered": ["counts"]}


def _with(sql: str) -> str:
    used: list[str] = []

    def need(v):
        for x in _NEEDS.get(v, []):
            need(x)
        if v not in used:
            used.append(v)
    for v in _VIEWS:
        if f" {v}" in sql or f"({v}" in sql:
            need(v)
    ctes = ", ".join(f"{v} AS ({_VIEWS[v]})" for v in used)
    if sql.startswith("WITH "):
        rest = sql[5:]
        recursive = rest.startswith("RECURSIVE ")
        rest = rest.removeprefix("RECURSIVE ")
        return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}, {rest}"
    return f"WITH {ctes} {sql}"


def _contains(a: str, b: str) -> str:
    return f"(len(list_distinct({a})) = len({a}) AND list_has_all({a}, {b}))"


def _begin(a: str, b: str) -> str:
    """Rank by rank from the coarsest, up to the first difference."""
    return f"{a}[1 : len(list_filter(range(1, least(len({a}), len({b})) + 1), lambda i: {a}[1:i] = {b}[1:i]))]"


#: Without unknown ranks at the end.
_KNOWN_PART = "t[1 : coalesce(list_max(list_transform(range(1, len(t) + 1), lambda i: CASE WHEN t[i] <> '' THEN i ELSE 0 END)), 0)]"


def _meet(a: str, b: str) -> str:
    kept = f"list_filter({a}, lambda e: list_contains({b}, e))"
    return f"list_filter({kept}, lambda e, i: list_position({kept}, e) = i)"


_RC = "translate(reverse(sequence), 'ACGTacgt', 'TGCATGCA')"


def _protein(s: str, frame: int) -> str:
    at = [f"strpos('TCAG', substr(upper({s}), CAST(i * 3 + {frame + k} AS BIGINT), 1))" for k in range(3)]
    return (f"CASE WHEN length({s}) < {frame + 2} THEN '' ELSE array_to_string(list_transform(range(0, (length({s}) - {frame - 1}) // 3), lambda i: CASE WHEN least({', '.join(at)}) = 0 THEN 'X' "
            f"ELSE substr('{genetic_code(5)}', ({at[0]} - 1) * 16 + ({at[1]} - 1) * 4 + {at[2]}, 1) END), '') END")


_STOPS = "CAST(CASE WHEN length(protein) > 2 THEN length(substr(protein, 2, length(protein) - 2)) - length(replace(substr(protein, 2, length(protein) - 2), '*', '')) ELSE 0 END AS INT)"
_FRAMES = "WITH distinct_seq AS (SELECT DISTINCT sequence FROM barcode), proteins AS (" + " UNION ALL ".join(
    f"SELECT sequence, '{name}' AS strand, {f} AS frame, {_protein('sequence' if name == 'forward' else _RC, f)} AS protein FROM distinct_seq" for name in ("forward", "reverse") for f in (1, 2, 3)
) + f"), framed AS (SELECT *, {_STOPS} AS stop_count FROM proteins)"
from ..functions.expressions import CONSENSUS  # noqa: E402

_SCORED = f"{_FRAMES}, scored AS (SELECT *, CASE WHEN protein = '' THEN 0.0 ELSE jaro_winkler_similarity(protein, '{CONSENSUS}') END AS similarity FROM framed)"
_BEST = f"{_SCORED}, best AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY sequence, strand ORDER BY similarity DESC, frame) AS r FROM scored) WHERE r = 1)"
_STRAND = (
    f"{_BEST}, wide AS (SELECT f.sequence, f.frame AS ff, f.protein AS fp, f.stop_count AS fs, f.similarity AS fm, r.frame AS rf, r.protein AS rp, r.stop_count AS rs, r.similarity AS rm "
    "FROM best f JOIN best r ON f.sequence = r.sequence AND f.strand = 'forward' AND r.strand = 'reverse'), "
    "used AS (SELECT *, rm > fm AND (rm - fm > 0.05 OR (rm - fm > 0.025 AND rs < fs)) AS rev FROM wide), "
    "chosen AS (SELECT sequence, rev AS reversed, CASE WHEN rev THEN rf ELSE ff END AS frame, CASE WHEN rev THEN rp ELSE fp END AS protein, CASE WHEN rev THEN rs ELSE fs END AS stop_count, round(CASE WHEN rev THEN rm ELSE fm END, 9) AS similarity FROM used)"
)


# ---- sources -------------------------------------------------------------------------------------------------

@query("fasta_assemble", "SELECT header, sequence FROM headed")
def _(spark, d):
    """Records written with their sequences over two lines, and read from these files."""
    path = shared_path(spark, "fasta")
    half = (F.length("sequence") / 2).cast("int")
    writers.write_fasta(headed(spark, d).select("header", F.concat(F.substring("sequence", F.lit(1), half), F.lit("\n"), F.substring("sequence", half + 1, F.length("sequence"))).alias("sequence")), path)
    return readers.fasta(spark, path).select("header", "sequence")


@query("concat_clusters", "SELECT concat('>', source, '|', substr(header, 2)) AS header, sequence FROM headed")
def _(spark, d):
    """A folder of one file per source, each written in parts."""
    folder, h = shared_path(spark, "clusters"), headed(spark, d)
    for source in ("BOLD", "GBOL", "GENBANK"):
        writers.write_fasta(h.where(F.col("source") == source).drop("pos"), f"{folder}/{source}.fas")
    return readers.fasta_folder(spark, folder).select("header", "sequence")


_HALF = "CAST(length(sequence) // 2 AS INT)"


@query("cluster_parse", "SELECT header, substr(header, 2, strpos(header, '|') - 2) AS cluster, substr(header, strpos(header, '|') + 1) AS member, "
       f"CASE WHEN pos % 6 = 0 THEN concat(substr(sequence, 1, {_HALF}), '>none', substr(sequence, {_HALF} + 1)) ELSE sequence END AS sequence FROM headed")
def _(spark, d):
    """Clustered FASTA in which some records are cut in two by a header without a pipe."""
    path, half = shared_path(spark, "clustered"), (F.length("sequence") / 2).cast("int")
    cut = F.concat(F.substring("sequence", F.lit(1), half), F.lit("\n>none\n"), F.substring("sequence", half + 1, F.length("sequence")))
    writers.write_fasta(headed(spark, d).select("header", F.when(F.col("pos") % 6 == 0, cut).otherwise(F.col("sequence")).alias("sequence"), "pos"), path)
    return readers.clustered(spark, path).select("header", "cluster", "member", "sequence")


@query("input_order", "SELECT header, row_number() OVER (ORDER BY source, pos) AS place FROM headed")
def _(spark, d):
    """First occurrences over files in parts of unequal size, of which Spark reads the largest first: numbered as written."""
    folder, h = shared_path(spark, "ordered"), headed(spark, d)
    for source in ("GBOL", "GENBANK", "BOLD"):
        writers.write_fasta(h.where(F.col("source") == source), f"{folder}/{source}.fas")
    read = readers.fasta(spark, folder)
    before = read.select("pos.file_path", "pos.block").groupBy("file_path", "block").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("file_path", "block", (F.sum("n").over(W.orderBy("file_path", "block")) - F.col("n")).alias("before"))  # a row a block
    own = F.row_number().over(W.partitionBy("pos.file_path", "pos.block").orderBy("pos"))
    return read.withColumns({"file_path": F.col("pos.file_path"), "block": F.col("pos.block"), "own": own}).join(before, ["file_path", "block"]).select("header", (F.col("before") + F.col("own")).alias("place"))


_COLS = ["identifier", "kingdom", "phylum", "class", "order_name", "family", "genus", "species", "country", "latitude", "longitude", "sequence"]


def _specimen_file(spark, d) -> str:
    """Columns in an order of their own, one that is not read, and cells that hold or begin with quotes."""
    path, b = shared_path(spark, "specimens"), barcode(spark, d)
    location = F.concat(F.when(F.col("pos") % 5 == 0, F.lit('"Near" ')).when(F.col("pos") % 7 == 0, F.lit('"')).otherwise(F.lit("")), F.lit("Town, "), F.coalesce("country", F.lit("")))
    writers.write_tsv(b.select("sequence", "latitude", "kingdom", F.lit('"').alias("remark"), "phylum", location.alias("location"), "class", "species", F.col("order_name").alias("order"), "family", "genus", "longitude", "identifier"), path)
    return path


_LOCATION = "concat(CASE WHEN pos % 5 = 0 THEN '\"Near\" ' WHEN pos % 7 = 0 THEN '\"' ELSE '' END, 'Town, ', coalesce(country, ''))"


@query("tsv_scan", f"SELECT identifier, kingdom, phylum, class, order_name, family, genus, species, {_LOCATION} AS location, latitude, longitude, sequence FROM barcode")
def _(spark, d):
    return readers.specimens(spark, _specimen_file(spark, d)).withColumnRenamed("order", "order_name").drop("pos")


@query("src_specimens", f"SELECT {', '.join(_COLS)}, 'TABLE' AS source FROM barcode")
def _(spark, d):
    return readers.specimen_records(spark, _specimen_file(spark, d), "TABLE").select(*_COLS, "source")


def bold_file(spark, d) -> str:
    """The barcodes of BOLD as the table of a data package, with rows of another marker."""
    path, b = shared_path(spark, "bold"), barcode(spark, d).where("source = 'BOLD'")
    coord = F.when(F.col("latitude").isNotNull(), F.concat(F.lit("["), "latitude", F.lit(", "), "longitude", F.lit("]"))).otherwise(F.lit("None"))
    cols = [F.col("identifier").alias("processid"), "kingdom", "phylum", "class", F.col("order_name").alias("order"), "family", "genus", F.when(F.col("species") == "", "None").otherwise(F.col("species")).alias("species"),
            F.coalesce("country", F.lit("None")).alias("country/ocean"), F.lit("").alias("province/state"), coord.alias("coord"), F.col("sequence").alias("nuc")]
    rows = b.select(*cols, F.lit("COI-5P").alias("marker_code")).unionByName(b.limit(9).select(*cols, F.lit("ITS").alias("marker_code")))
    writers.write_tsv(rows, path)
    return path


def bold_folder(spark, d) -> str:
    path, b = shared_path(spark, "bold-downloads"), barcode(spark, d).where("source = 'BOLD'")
    names = [F.col("order_name" if r == "order" else r).alias(f"{r}_name") for r in ("phylum", "class", "order", "family", "genus", "species")]
    writers.write_tsv(b.select(F.col("identifier").alias("processid"), *names, F.coalesce("country", F.lit("")).alias("country"), F.lit("").alias("province_state"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.lit("COI-5P").alias("markercode"), F.col("sequence").alias("nucleotides")), path)
    return path


def gbol_file(spark, d) -> str:
    path, b = shared_path(spark, "gbol"), barcode(spark, d).where("source = 'GBOL'")
    writers.write_tsv(b.select(F.col("identifier").alias("CatalogueNumber"), F.concat_ws(", ", "kingdom", "phylum", "class", "order_name", "family").alias("HigherTaxa"), F.when(F.col("species") != "", F.col("species")).otherwise(F.col("genus")).alias("Species"),
                               F.lit("Bonn").alias("Location"), F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"), F.col("sequence").alias("BarcodeSequence")), path)
    return path


_LETTERS = "translate({}, '0123456789', 'abcdefghij')"


def genbank_file(spark, d) -> str:
    """Flat files of genomes with three genes each. The marker is one piece, or on the other strand, or two pieces of which
    the first lies behind the other, or both; in every tenth record its place is not named, and the gene is another.
    Names have letters for digits, as names of organisms have no digits."""
    path, b = shared_path(spark, "genbank"), barcode(spark, d).where("source = 'GENBANK'")
    organism = F.expr(_LETTERS.format("CASE WHEN species <> '' THEN species WHEN genus <> '' THEN concat(genus, ' sp. X') ELSE 'uncultured thing' END"))
    side = lambda c, plus, minus: F.concat(F.abs(F.col(c)).cast("string"), F.when(F.col(c) < 0, minus).otherwise(plus))
    b = b.withColumns({"kind": F.col("pos") % 4, "n": F.length("sequence"), "front": F.expr("substring(translate(md5(identifier), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 30)")})
    half = F.lit(40)
    first, second = F.substring("sequence", F.lit(1), half), F.substring("sequence", half + 1, F.col("n"))
    shuffled = F.concat(second, F.lit("GG"), first)  # from 31 on: the second piece, two bases, the first
    back = lambda x: F.translate(F.reverse(x), "ACGT", "TGCA")
    inner = F.when(F.col("kind") == 0, F.col("sequence")).when(F.col("kind") == 1, back(F.col("sequence"))).when(F.col("kind") == 2, shuffled).otherwise(back(shuffled))
    span = lambda a, z: F.concat(a.cast("string"), F.lit(".."), z.cast("string"))
    n, at = F.col("n"), F.lit(31)
    two = F.concat(F.lit("join("), span(at + n - 40 + 2, at + n + 1), F.lit(",\n" + " " * 21), span(at, at + n - 41), F.lit(")"))
    # on the other strand the first piece comes first again
    place = F.when(F.col("kind") == 0, F.concat(F.lit("<"), at.cast("string"), F.lit("..>"), (at + n - 1).cast("string"))).when(F.col("kind") == 1, F.concat(F.lit("complement("), span(at, at + n - 1), F.lit(")"))).when(F.col("kind") == 2, two).otherwise(
        F.concat(F.lit("order(complement("), span(at, at + 39), F.lit("),complement("), span(at + 42, at + n + 1), F.lit("))")))
    genome = F.lower(F.concat("front", inner, F.lit("ACGTTTTACG")))
    gene = lambda kind, where, name, product: F.concat(F.rpad(F.lit(f"     {kind}"), 21, " "), where, F.lit("\n" + " " * 21 + '/gene="'), F.lit(name), F.lit('"\n' + " " * 21 + '/product="'), F.lit(product), F.lit('"'))
    marker = F.when(F.col("pos") % 10 == 1, gene("CDS", place, "CYTB", "cytochrome b")).when(F.col("pos") % 3 == 0, gene("CDS", place, "COX1", "cytochrome c oxidase")).otherwise(gene("CDS", place, "x", "cytochrome c oxidase\n" + " " * 21 + "subunit I"))
    lines = F.concat_ws("\n", F.concat(F.lit("LOCUS       "), "identifier"), F.concat(F.lit("ACCESSION   "), "identifier", F.lit(" OLD1")), F.concat(F.lit("  ORGANISM  "), organism), F.lit("FEATURES             Location/Qualifiers"),
                        F.lit("     source          1..30\n" + " " * 21 + '/note="not ""COX1"" /gene="'),
                        F.concat(F.lit(" " * 21 + '/geo_loc_name="'), "country", F.lit(': Hill Town"')), F.concat(F.lit(" " * 21 + '/lat_lon="'), side("latitude", " N ", " S "), side("longitude", " E", " W"), F.lit('"')),
                        gene("CDS", F.lit("1..30"), "ND2", "NADH dehydrogenase subunit 2"), marker, gene("gene", F.lit("complement(3..9)"), "COX2", "cytochrome c oxidase subunit II"),
                        F.lit("ORIGIN      "), F.concat(F.lit("        1 "), F.substring(genome, 1, 10), F.lit(" "), F.substring(genome, 11, 50)), F.concat(F.lit("       61 "), F.substring(genome, F.lit(61), F.length(genome))), F.lit("//"))
    b.select(lines.alias("value")).write.text(path)
    return path


def midori_file(spark, d) -> str:
    """Gzipped FASTA; missing ranks have placeholders."""
    path, h = shared_path(spark, "midori"), barcode(spark, d)
    ranks = ["kingdom", "phylum", "class", "order_name", "family", "genus", "species"]
    parts = [F.concat(F.when(F.col(r) != "", F.col(r)).otherwise(F.concat(F.lit(f"{r.removesuffix('_name')}_"), "class")), F.lit(f"_{7 + i}")) for i, r in enumerate(ranks)]
    writers.fasta_text(h.select(F.concat(F.lit(">"), "identifier", F.lit(".1.<1.>99###root_1;"), F.concat_ws(";", *parts)).alias("header"), "sequence")).write.option("compression", "gzip").text(path)
    return path


_RANKS = "kingdom, phylum, class, order_name, family, genus, species"


@query("src_bold", f"SELECT identifier, {_RANKS}, country, latitude, longitude, sequence, source FROM barcode WHERE source = 'BOLD'")
def _(spark, d):
    return readers.bold_release(spark, bold_file(spark, d)).drop("location", "pos")


@query("src_bold_downloads", f"SELECT identifier, {_RANKS}, country, latitude, longitude, sequence, source FROM barcode WHERE source = 'BOLD'")
def _(spark, d):
    return readers.bold_downloads(spark, bold_folder(spark, d)).drop("location", "pos")


@query("src_gbol", f"SELECT identifier, {_RANKS}, 'Germany' AS country, 'Bonn' AS location, latitude, longitude, sequence, source FROM barcode WHERE source = 'GBOL'")
def _(spark, d):
    return readers.gbol(spark, gbol_file(spark, d)).drop("pos")


@query("src_genbank", f"SELECT identifier, {_LETTERS.format('genus')} AS genus, {_LETTERS.format('species')} AS species, country, CASE WHEN country IS NOT NULL THEN 'Hill Town' END AS location, latitude, longitude, sequence, source FROM barcode WHERE source = 'GENBANK' AND pos % 10 <> 1")
def _(spark, d):
    return readers.genbank(spark, genbank_file(spark, d)).drop("kingdom", "phylum", "class", "order_name", "family", "pos")


@query("src_midori", f"SELECT identifier, {_RANKS}, replace(sequence, '-', '') AS sequence, 'MIDORI' AS source FROM barcode")
def _(spark, d):
    return readers.midori(spark, midori_file(spark, d)).drop("country", "location", "latitude", "longitude", "pos")


@query("src_union", "SELECT identifier, source, sequence FROM barcode WHERE source <> 'GENBANK' OR pos % 10 <> 1")
def _(spark, d):
    params = Parameters(sources=("all",), folders={"bold_release": bold_file(spark, d), "gbol": gbol_file(spark, d), "genbank": genbank_file(spark, d)}).checked()
    return readers.union_sources(*chain.sources(spark, params).values()).select("identifier", "source", "sequence")


@query("taxonomy_load", "SELECT taxon_id, parent_id, name, rank, status, CAST(NULL AS BIGINT) AS accepted_id, is_extinct FROM (SELECT taxon_id, parent_id, name, rank, status, FALSE AS is_extinct FROM backbone WHERE accepted_id IS NULL) "
       "UNION ALL SELECT NULL, g.parent_id, s.name, g.rank, 'synonym', g.taxon_id, FALSE FROM backbone s JOIN backbone g ON s.accepted_id = g.taxon_id AND g.accepted_id IS NULL")
def _(spark, d):
    """nodes.dmp and names.dmp, written and imported. Synonyms have no id of their own there."""
    folder, b = shared_path(spark, "ncbi"), backbone(spark, d)
    line = lambda *c: F.concat(F.concat_ws("\t|\t", *c), F.lit("\t|")).alias("value")
    b.where("accepted_id is null").select(line(F.col("taxon_id").cast("string"), F.coalesce("parent_id", "taxon_id").cast("string"), "rank")).write.text(f"{folder}/nodes.dmp")
    b.select(line(F.coalesce("accepted_id", "taxon_id").cast("string"), "name", F.lit(""), F.when(F.col("accepted_id").isNull(), "scientific name").otherwise("synonym"))).write.text(f"{folder}/names.dmp")
    return readers.ncbi_taxonomy(spark, folder).withColumn("taxon_id", F.when(F.col("status") == "accepted", F.col("taxon_id")))


@query("taxonomy_load_gbif", "SELECT CAST(taxon_id AS BIGINT) AS taxon_id, CAST(parent_id AS BIGINT) AS parent_id, name, rank, status, CAST(accepted_id AS BIGINT) AS accepted_id, is_extinct FROM backbone")
def _(spark, d):
    folder, b = shared_path(spark, "gbif"), backbone(spark, d)
    writers.write_tsv(b.select(F.col("taxon_id").alias("taxonID"), F.col("parent_id").alias("parentNameUsageID"), F.col("accepted_id").alias("acceptedNameUsageID"), F.col("name").alias("canonicalName"), F.upper("rank").alias("taxonRank"), F.col("status").alias("taxonomicStatus")), f"{folder}/Taxon.tsv")
    writers.write_tsv(b.select(F.col("taxon_id").alias("taxonID"), F.col("is_extinct").cast("string").alias("isExtinct")), f"{folder}/SpeciesProfile.tsv")
    return readers.gbif_taxonomy(spark, folder)


@query("homonym_table", "SELECT name, rank, count(*) AS taxa FROM backbone GROUP BY name, rank HAVING count(*) > 1")
def _(spark, d):
    return taxonomy.homonyms(backbone(spark, d))


# ---- projections and filters ------------------------------------------------------------------------------------

@query("degap", "SELECT identifier, replace(sequence, '-', '') AS sequence FROM barcode")
def _(spark, d):
    return sequence.degap(barcode(spark, d)).select("identifier", "sequence")


@query("underscore_headers", "SELECT replace(header, ' ', '_') AS header, sequence FROM headed")
def _(spark, d):
    return sequence.underscore_headers(headed(spark, d)).select("header", "sequence")


_TRUNC = "SELECT header, CASE WHEN strpos(header, '||') > 0 THEN substr(header, 1, strpos(header, '||') - 1) ELSE header END AS truncated FROM headed"


@query("truncate_missing_rank", f"SELECT header, truncated FROM ({_TRUNC}) WHERE NOT (strpos(header, '||') > 0 AND strpos(truncated, '|') = 0)")
def _(spark, d):
    return lineage.truncate_missing_rank(headed(spark, d)).where("not removed").select("header", "truncated")


@query("removed_no_taxon", "SELECT h AS header, split_part(h, '||', 1) AS truncated_header, sequence FROM (SELECT CASE WHEN pos % 5 = 0 THEN concat('>', identifier, '||', family) ELSE header END AS h, sequence FROM headed) WHERE strpos(h, '||') > 0 AND strpos(split_part(h, '||', 1), '|') = 0")
def _(spark, d):
    h = headed(spark, d).withColumn("header", F.when(F.col("pos") % 5 == 0, F.concat(F.lit(">"), "identifier", F.lit("||"), "family")).otherwise(F.col("header")))
    return lineage.removed_table(lineage.truncate_missing_rank(h))


def _rename_sql() -> str:
    ranks = ["kingdom", "phylum", "class", "order_name", "family", "genus", "species"]
    out = {c: c for c in ["identifier", *ranks, "country", "sequence"]}
    for rank in ranks:
        for r, old, new in RENAMES:
            if r == rank:
                out = {c: f"CASE WHEN {rank} = '{old}' THEN replace({x}, '{old}', '{new}') ELSE {x} END" for c, x in out.items()}
    return "SELECT " + ", ".join(f"{x} AS {c}" for c, x in out.items()) + " FROM barcode"


@query("replace_taxon_name", _rename_sql())
def _(spark, d):
    """The whole row: a class is named in the country's cell too."""
    ranks = ["kingdom", "phylum", "class", "order_name", "family", "genus", "species"]
    return lineage.replace_names(barcode(spark, d), _pairs(spark)).select("identifier", *ranks, "country", "sequence")


def _pairs(spark):
    path = shared_path(spark, "replacements")
    writers.write_tsv(spark.createDataFrame(RENAMES, "taxon_rank string, taxon_to_replace string, taxon_to_use string"), path)
    return readers.replacements(spark, path)


@query("replaced_table", f"SELECT concat_ws(chr(9), identifier, kingdom, phylum, class, order_name, family, genus, species) AS value FROM ({_rename_sql()})")
def _(spark, d):
    """The replaced table as written: fields joined by tabs, nothing quoted."""
    ranks, path = ["kingdom", "phylum", "class", "order_name", "family", "genus", "species"], shared_path(spark, "replaced")
    writers.write_tsv(lineage.replace_names(barcode(spark, d), _pairs(spark)).select("identifier", *ranks), path, header=False)
    return spark.read.text(path)


@query("reverse_complement", f"SELECT identifier, {_RC} AS sequence FROM barcode")
def _(spark, d):
    return barcode(spark, d).select("identifier", reverse_complement(F.col("sequence")).alias("sequence"))


@query("translate_frames", f"{_FRAMES} SELECT sequence, strand, frame, protein FROM framed")
def _(spark, d):
    return sequence.frames(barcode(spark, d)).select("sequence", "strand", "frame", "protein")


@query("internal_stops", f"{_FRAMES} SELECT sequence, strand, frame, stop_count FROM framed")
def _(spark, d):
    return sequence.frames(barcode(spark, d)).select("sequence", "strand", "frame", "stop_count")


@query("consensus_similarity", f"{_SCORED} SELECT sequence, strand, frame, round(similarity, 9) AS similarity FROM scored")
def _(spark, d):
    return sequence.similarities(barcode(spark, d)).select("sequence", "strand", "frame", F.round("similarity", 9).alias("similarity"))


@query("best_frame", f"{_BEST} SELECT sequence, strand, frame, protein, stop_count FROM best")
def _(spark, d):
    return sequence.best_frames(barcode(spark, d)).select("sequence", "strand", "frame", "protein", "stop_count")


@query("choose_strand", f"{_STRAND} SELECT * FROM chosen")
def _(spark, d):
    out = sequence.choose_strand(barcode(spark, d))
    return out.withColumn("similarity", F.round("similarity", 9))


_INFO = f"{_STRAND} SELECT identifier, b.sequence, reversed, frame, stop_count, stop_count > 0 AS discarded FROM barcode b JOIN chosen USING (sequence)"


@query("stop_codon_info", _INFO)
def _(spark, d):
    return sequence.stop_codon_info(barcode(spark, d)).select("identifier", "sequence", "reversed", "frame", "stop_count", "discarded")


@query("stop_codon_table", f"{_STRAND} SELECT header, stop_count > 0 AS discarded, reversed, h.sequence AS nuc_seq, protein AS prot_seq, similarity AS distance_to_consensus, stop_count AS stop_codon_count, frame, CASE WHEN reversed THEN translate(reverse(h.sequence), 'ACGTacgt', 'TGCATGCA') END AS nuc_reverse_complement_seq, '{CONSENSUS}' AS used_consensus_seq FROM headed h JOIN chosen c ON h.sequence = c.sequence")
def _(spark, d):
    return sequence.stop_codon_table(headed(spark, d)).withColumn("distance_to_consensus", F.round("distance_to_consensus", 9))


@query("stop_codon_filter", f"{_STRAND} SELECT identifier, b.sequence FROM barcode b JOIN chosen USING (sequence) WHERE stop_count = 0")
def _(spark, d):
    return sequence.stop_codon_info(barcode(spark, d)).where("not discarded").select("identifier", "sequence")


@query("header_taxa", "SELECT identifier, array_to_string(taxa, '|') AS taxa, len(taxa) AS n FROM members")
def _(spark, d):
    return members(spark, d).select("identifier", F.array_join("taxa", "|").alias("taxa"), F.size("taxa").cast("long").alias("n"))


for _name, _char, _most, _disc in (("filter_ns", "N", 3, False), ("filter_ns_discarded", "N", 3, True), ("filter_gaps", "-", 2, False)):
    def _chars(spark, d, c=_char, m=_most, x=_disc):
        return sequence.max_char(barcode(spark, d), c, m, x).select("identifier", "sequence")
    query(_name, f"SELECT identifier, sequence FROM barcode WHERE length(sequence) - length(replace(sequence, '{_char}', '')) {'>' if _disc else '<='} {_most}")(_chars)


@query("length_filter", "SELECT identifier, sequence FROM barcode WHERE length(sequence) BETWEEN 97 AND 101")
def _(spark, d):
    return sequence.length_range(barcode(spark, d), 97, 101).select("identifier", "sequence")


@query("length_discarded", "SELECT header, sequence, CAST(length(sequence) AS INT) AS length FROM headed WHERE NOT length(sequence) BETWEEN 97 AND 101")
def _(spark, d):
    return sequence.length_range(headed(spark, d), 97, 101, discarded=True).select("header", "sequence", "length")


def contaminant_file(spark, d) -> str:
    """Contaminants as FASTA: sequences of some specimens with every 12th letter exchanged, of others with every 8th."""
    path, b = shared_path(spark, "contaminants"), barcode(spark, d)
    kind = F.expr("CAST(substring(family, 4) AS INT) % 10")
    letters = F.expr("replace(regexp_replace(sequence, '^N+', ''), '-', '')")
    apart = lambda n: F.array_join(F.transform(F.sequence(F.lit(1), F.length("s")), lambda i: F.when(i % n == 0, F.translate(F.substring("s", i, F.lit(1)), "ACGT", "CGTA")).otherwise(F.substring("s", i, F.lit(1)))), "")
    own = b.select(kind.alias("k"), letters.alias("s")).where("k < 2").distinct()
    writers.write_fasta(own.select(F.concat(F.lit(">"), F.md5("s")).alias("header"), F.when(F.col("k") == 0, apart(12)).otherwise(apart(8)).alias("sequence")), path)
    return path


_MIXED = "CAST(substr(family, 4) AS INT) % 10 = 0"


def _contaminants(spark, d):
    found = readers.fasta(spark, contaminant_file(spark, d))
    return found.select(F.regexp_replace("header", "^>", "").alias("identifier"), "sequence")


@query("contaminants_removed", f"SELECT identifier, sequence FROM barcode WHERE NOT {_MIXED}")
def _(spark, d):
    """Against contaminants of which a part is at an identity of 88/96, a part at 84/96; the others are not alike."""
    return contaminants.without_contaminants(barcode(spark, d), _contaminants(spark, d)).select("identifier", "sequence")


@query("contaminants_matched", f"SELECT identifier, round(88 / 96, 9) AS identity, CAST(96 AS INT) AS columns FROM barcode WHERE {_MIXED}")
def _(spark, d):
    return contaminants.matched(barcode(spark, d), _contaminants(spark, d)).select("identifier", F.round("identity", 9).alias("identity"), "columns")


@query("filter_taxon_rank", "SELECT identifier, genus, species FROM barcode WHERE genus <> '' OR species <> ''")
def _(spark, d):
    return taxonomy.at_least(barcode(spark, d), "genus").select("identifier", "genus", "species")


@query("taxon_subset", "SELECT identifier, family FROM barcode WHERE family = 'Fam5'")
def _(spark, d):
    return taxonomy.subset(barcode(spark, d), "Fam5", backbone(spark, d)).select("identifier", "family")


# ---- regions ----------------------------------------------------------------------------------------------------

@query("region_country", "SELECT identifier, country FROM barcode WHERE country IN ('NATION_3', 'NATION_7')")
def _(spark, d):
    return region.by_country(barcode(spark, d), ["NATION_3", "NATION_7"]).select("identifier", "country")


@query("region_continent", "SELECT identifier, country FROM barcode WHERE country IN (SELECT country FROM countries WHERE continent = 'AMERICA' OR country = 'NATION_4')")
def _(spark, d):
    return region.by_continent(barcode(spark, d), countries(spark, d), ["AMERICA"], ["NATION_4"]).select("identifier", "country")


def _inside_sql(layer: str, only: str | None = None) -> str:
    parts = []
    for name, rings in POLYGONS[layer].items():
        edges = " + ".join(f"(CASE WHEN ({y1} > latitude) <> ({y2} > latitude) AND longitude < ({x2 - x1}) * (latitude - ({y1})) / ({y2 - y1 or 1}) + ({x1}) THEN 1 ELSE 0 END)" for ring in rings for (x1, y1), (x2, y2) in zip(ring, ring[-1:] + ring[:-1]))
        if only in (None, name):
            parts.append(f"SELECT identifier, '{name}' AS region FROM barcode WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND ({edges}) % 2 = 1")
    return " UNION ALL ".join(parts)


for _name, _layer in (("region_realm", "realm"), ("region_ecoregion", "ecoregion")):
    def _inside(spark, d, layer=_layer):
        return region.by_polygon(barcode(spark, d), polygons(spark, layer)).select("identifier", "region")
    query(_name, _inside_sql(_layer))(_inside)


def shapefile_bytes(shapes: dict[str, list[list[tuple[float, float]]]], attribute: str = "NAME") -> tuple[bytes, bytes, bytes]:
    """The .shp, the .dbf and the .shx of some polygons."""
    shp, dbf, shx = b"", b"", b""
    for i, (name, rings) in enumerate(shapes.items()):
        points = [p for r in rings for p in r]
        starts = [sum(map(len, rings[:k])) for k in range(len(rings))]
        xs, ys = zip(*points)
        body = struct.pack(f"<i4d2i{len(rings)}i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points), *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        shx += struct.pack(">2i", (100 + len(shp)) // 2, len(body) // 2)
        shp += struct.pack(">2i", i + 1, len(body) // 2) + body
        dbf += b" " + name.encode().ljust(20)
    head = struct.pack("<BBBBIHH", 3, 0, 0, 0, len(shapes), 65, 21) + b"\0" * 20 + attribute.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([20]) + b"\0" * 15 + b"\r"
    return b"\0" * 100 + shp, head + dbf, b"\0" * 100 + shx


@query("region_shapefile", _inside_sql("custom", "Plot"))
def _(spark, d):
    """A shapefile with a hole in one of its polygons, written and read."""
    path = shared_path(spark, "shape")
    for end, data in zip(("shp", "dbf", "shx"), shapefile_bytes(POLYGONS["custom"])):
        put(spark, f"{path}.{end}", data)
    return region.by_polygon(barcode(spark, d), readers.shapefile(spark, f"{path}.shp", "NAME", ["Plot"])).select("identifier", "region")


@query("list_regions", "SELECT DISTINCT continent AS name FROM countries")
def _(spark, d):
    return region.catalogue(countries(spark, d), "continent")


@query("unknown_regions", "SELECT x AS name FROM (VALUES ('NATION_3'), ('ATLANTIS')) t(x) WHERE x NOT IN (SELECT country FROM countries)")
def _(spark, d):
    return region.unknown_names(spark, ["NATION_3", "ATLANTIS"], countries(spark, d), "country")


# ---- clusters ---------------------------------------------------------------------------------------------------

@query("lineage_counts", "SELECT cluster, array_to_string(taxa, '|') AS taxa, count FROM counts")
def _(spark, d):
    return _joined(counts(spark, d))


_CONGRUENT = f"SELECT cluster, list_reduce(l, lambda a, x: CASE WHEN {_contains('a', 'x')} THEN a ELSE {_meet('a', 'x')} END) AS taxa FROM ordered"
_LCA = f"SELECT cluster, list_reduce(l, lambda a, x: {_meet('a', 'x')}) AS taxa FROM ordered"


@query("cluster_congruent", f"SELECT cluster, array_to_string(taxa, '|') AS taxa FROM ({_CONGRUENT})")
def _(spark, d):
    return _joined(lineage.congruent(counts(spark, d)))


@query("cluster_lca", f"SELECT cluster, array_to_string(taxa, '|') AS taxa FROM ({_LCA})")
def _(spark, d):
    return _joined(lineage.common_ancestor(counts(spark, d)))


@query("cluster_majority", "SELECT cluster, array_to_string(l[list_position(n, list_max(n))], '|') AS taxa FROM ordered")
def _(spark, d):
    return _joined(lineage.majority(counts(spark, d)))


_SUPPORT = f"SELECT a.cluster, a.taxa, a.count, CAST(a.count + coalesce(sum(b.count) FILTER (WHERE b.taxa <> a.taxa AND {_contains('a.taxa', 'b.taxa')}), 0) AS BIGINT) AS support FROM counts a JOIN counts b ON a.cluster = b.cluster GROUP BY a.cluster, a.taxa, a.count"


@query("lineage_support", f"SELECT cluster, array_to_string(taxa, '|') AS taxa, count, support FROM ({_SUPPORT})")
def _(spark, d):
    return _joined(lineage.support(counts(spark, d)))


@query("cluster_ratio", f"WITH supported AS ({_SUPPORT}), ranked AS (SELECT cluster, list(taxa ORDER BY support DESC, array_to_string(taxa, '|') DESC) AS r, list(support ORDER BY support DESC, array_to_string(taxa, '|') DESC) AS s FROM supported GROUP BY cluster) SELECT cluster, array_to_string(CASE WHEN len(s) > 1 AND s[1] / s[2] >= {RATIO} THEN r[1] ELSE l[1] END, '|') AS taxa FROM ranked JOIN ordered USING (cluster)")
def _(spark, d):
    return _joined(lineage.by_ratio(counts(spark, d), RATIO))


@query("cluster_discard", "SELECT cluster, array_to_string(any_value(taxa), '|') AS taxa FROM counts GROUP BY cluster HAVING count(*) = 1")
def _(spark, d):
    return _joined(lineage.without_conflict(counts(spark, d)))


@query("cluster_curate", f"WITH agreed AS ({_CONGRUENT}) SELECT identifier, m.cluster, substr(m.header, strpos(m.header, '|') + 1) AS taxon_original, array_to_string(a.taxa, '|') AS taxon_curated, c.count AS count_original, 'choose_by_lowest_taxon_with_congruent_lineage' AS processing_method, sequence FROM members m JOIN counts c ON m.cluster = c.cluster AND m.taxa = c.taxa JOIN agreed a ON a.cluster = m.cluster")
def _(spark, d):
    return lineage.curate(members(spark, d))


@query("cluster_curated_fasta", f"WITH agreed AS ({_CONGRUENT}) SELECT concat('>', identifier, '|', array_to_string(a.taxa, '|')) AS header, sequence FROM members m JOIN agreed a ON a.cluster = m.cluster")
def _(spark, d):
    return lineage.curated_fasta(lineage.curate(members(spark, d)))


@query("lineage_setops", f"SELECT a.cluster, array_to_string({_meet('a.l[1]', 'a.l[2]')}, '|') AS common, len(list_distinct(list_concat(a.l[1], a.l[2]))) AS n_union FROM ordered a WHERE len(l) > 1")
def _(spark, d):
    o = lineage._ordered(counts(spark, d)).where(F.size("l") > 1)
    a, b = F.get("l", F.lit(0))["taxa"], F.get("l", F.lit(1))["taxa"]
    return o.select("cluster", F.array_join(F.array_intersect(a, b), "|").alias("common"), F.size(F.array_union(a, b)).cast("long").alias("n_union"))


# ---- dereplication ----------------------------------------------------------------------------------------------

_CAND = "cand AS (SELECT sequence, taxa, count(*) AS n, min(pos) AS first_pos FROM members GROUP BY sequence, taxa)"
_TIED = f"WITH {_CAND}, tied AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY sequence ORDER BY len(taxa) DESC, n DESC) AS r FROM cand) WHERE r = 1)"


@query("derep_groups", f"WITH {_CAND} SELECT sequence, CAST(sum(n) AS BIGINT) AS specimens, count(*) AS lineages, min(first_pos) AS first_pos FROM cand GROUP BY sequence")
def _(spark, d):
    return derep.groups(members(spark, d))


@query("derep_first", f"{_TIED} SELECT sequence, array_to_string(arg_min(taxa, first_pos), '|') AS taxa FROM tied GROUP BY sequence")
def _(spark, d):
    return _joined(derep.keep_first(members(spark, d)))


@query("derep_lca", f"{_TIED}, agreed AS (SELECT sequence, list_reduce(list(taxa ORDER BY first_pos), lambda a, x: {_begin('a', 'x')}) AS t FROM tied GROUP BY sequence) SELECT sequence, array_to_string({_KNOWN_PART}, '|') AS taxa FROM agreed")
def _(spark, d):
    return _joined(derep.common(members(spark, d)))


@query("derep_discard", f"{_TIED} SELECT sequence, array_to_string(any_value(taxa), '|') AS taxa FROM tied GROUP BY sequence HAVING count(*) = 1")
def _(spark, d):
    return _joined(derep.discard(members(spark, d)))


# ---- taxonomy ---------------------------------------------------------------------------------------------------

_WALK = "WITH RECURSIVE walk AS (SELECT taxon_id, parent_id, [name] AS path FROM backbone UNION ALL SELECT w.taxon_id, b.parent_id, list_concat([b.name], w.path) FROM walk w JOIN backbone b ON w.parent_id = b.taxon_id)"


@query("lineage_walk", f"{_WALK} SELECT taxon_id, array_to_string(path, '|') AS path FROM walk WHERE parent_id IS NULL")
def _(spark, d):
    return taxonomy.lineages(backbone(spark, d)).withColumn("path", F.array_join(F.transform("path", lambda x: x["name"]), "|"))


@query("resolve_synonyms", "SELECT t.taxon_id, coalesce(g.taxon_id, t.taxon_id) AS used_id, coalesce(g.name, t.name) AS used_name FROM backbone t LEFT JOIN backbone g ON t.accepted_id = g.taxon_id")
def _(spark, d):
    return taxonomy.resolve_synonyms(backbone(spark, d))


_UP = "up AS (SELECT taxon_id AS id, parent_id AS at, rank, name FROM backbone UNION ALL SELECT u.id, b.parent_id, b.rank, b.name FROM up u JOIN backbone b ON u.at = b.taxon_id)"
_KNOWN = (f"WITH RECURSIVE {_UP}, told AS (SELECT identifier, list_filter([struct_pack(rank := 'species', name := species), struct_pack(rank := 'genus', name := genus), struct_pack(rank := 'family', name := family), "
          "struct_pack(rank := 'order', name := order_name), struct_pack(rank := 'class', name := class), struct_pack(rank := 'phylum', name := phylum), struct_pack(rank := 'kingdom', name := kingdom)], lambda x: x.name <> '') AS k FROM barcode), "
          "finest AS (SELECT identifier, k[1].name AS finest_name, k[1].rank AS finest_rank, k[2:] AS above FROM told), "
          "found AS (SELECT f.*, t.taxon_id AS own_id, t.name AS own_name, coalesce(g.taxon_id, t.taxon_id) AS used_id, coalesce(g.name, t.name) AS used FROM finest f JOIN backbone t ON t.name = finest_name AND t.rank = finest_rank LEFT JOIN backbone g ON g.taxon_id = t.accepted_id), "
          "scored AS (SELECT f.identifier, f.own_id, count(*) FILTER (WHERE list_contains(f.above, struct_pack(rank := u.rank, name := u.name))) AS score FROM found f JOIN up u ON u.id = f.own_id GROUP BY f.identifier, f.own_id), "
          "best AS (SELECT * FROM (SELECT f.*, rank() OVER (PARTITION BY f.identifier ORDER BY score DESC) AS r FROM found f JOIN scored s ON s.identifier = f.identifier AND s.own_id = f.own_id) WHERE r = 1), "
          "hits AS (SELECT * EXCLUDE (r, n, lo, hi) FROM (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY own_id <> used_id, own_id) AS n, min(used_id) OVER (PARTITION BY identifier) AS lo, max(used_id) OVER (PARTITION BY identifier) AS hi FROM best) WHERE n = 1 AND lo = hi)")
for _name, _retain, _syn in (("harmonize", False, False), ("harmonize_retain", True, False), ("harmonize_synonyms", False, True)):
    def _harm(spark, d, r=_retain, s=_syn):
        return taxonomy.harmonize(barcode(spark, d), backbone(spark, d), r, s).select("identifier", "finest_name", "finest_rank", "taxon_id", "used_name")
    _cols = "own_id AS taxon_id, own_name AS used_name" if _syn else "used_id AS taxon_id, used AS used_name"
    query(_name, f"{_KNOWN} SELECT f.identifier, f.finest_name, f.finest_rank, {'h.used_id AS taxon_id, coalesce(h.used, f.finest_name) AS used_name' if _retain else _cols} FROM {'finest f LEFT JOIN hits h USING (identifier)' if _retain else 'hits f'}")(_harm)


_STANDARD = "standard AS (SELECT id, " + ", ".join(f"coalesce(max(name) FILTER (WHERE rank = '{r}'), '') AS {c}" for r, c in zip(reversed(taxonomy.RANKS), _RANKS.split(", "))) + " FROM up GROUP BY id)"
_HARMONIZED = _KNOWN.replace(", told AS", f", {_STANDARD}, told AS", 1)


@query("harmonized_lineage", f"{_HARMONIZED} SELECT h.identifier, {', '.join('s.' + c for c in _RANKS.split(', '))}, CAST(h.used_id AS BIGINT) AS taxon_id, h.used AS used_name FROM hits h JOIN standard s ON s.id = h.used_id")
def _(spark, d):
    return taxonomy.harmonized(barcode(spark, d), backbone(spark, d)).select("identifier", *_RANKS.split(", "), "taxon_id", "used_name")


@query("harmonize_unmapped", f"{_KNOWN} SELECT f.identifier, {', '.join('b.' + c for c in _RANKS.split(', '))}, CAST(NULL AS BIGINT) AS taxon_id, f.finest_name AS used_name FROM finest f JOIN barcode b USING (identifier)")
def _(spark, d):
    return taxonomy.harmonized(barcode(spark, d), None).select("identifier", *_RANKS.split(", "), "taxon_id", "used_name")


@query("taxon_descendants", f"{_HARMONIZED} SELECT h.identifier, CAST(h.used_id AS BIGINT) AS taxon_id FROM hits h WHERE h.used_id IN (SELECT id FROM up WHERE name = 'AMERICA' AND rank = 'phylum')")
def _(spark, d):
    b = backbone(spark, d)
    return taxonomy.subset(taxonomy.harmonized(barcode(spark, d), b), "AMERICA", b).select("identifier", "taxon_id")


# ---- sinks as projections -------------------------------------------------------------------------------------------

@query("out_fasta", "SELECT concat(header, chr(10), sequence) AS value FROM headed")
def _(spark, d):
    return writers.fasta_text(headed(spark, d))


@query("out_qiime2", "SELECT identifier AS feature_id, concat('k__', kingdom, '; p__', phylum, '; c__', class, '; o__', order_name, '; f__', family, '; g__', genus, '; s__', species) AS taxon FROM barcode")
def _(spark, d):
    return writers.qiime2_taxonomy(barcode(spark, d))


@query("out_kraken2", f"{_KNOWN} SELECT concat('>', identifier, '|kraken:taxid|', CAST(used_id AS VARCHAR)) AS header, sequence FROM hits JOIN barcode USING (identifier)")
def _(spark, d):
    return writers.kraken2(taxonomy.harmonize(barcode(spark, d), backbone(spark, d)))


@query("out_dada2_taxonomy", "SELECT concat('>', kingdom, ';', phylum, ';', class, ';', CASE WHEN order_name = '' THEN '' ELSE concat(order_name, ';', family, ';', CASE WHEN genus = '' THEN '' ELSE concat(genus, ';') END) END) AS header, sequence FROM barcode")
def _(spark, d):
    return writers.dada2_taxonomy(barcode(spark, d))


@query("out_dada2_species", "SELECT concat('>', identifier, ' ', species) AS header, sequence FROM barcode WHERE species <> ''")
def _(spark, d):
    return writers.dada2_species(barcode(spark, d))


@query("out_sintax", "SELECT concat('>', identifier, ';tax=d:', kingdom, ',p:', replace(phylum, ' ', '_'), ',c:', replace(class, ' ', '_'), CASE WHEN order_name = '' THEN '' ELSE concat(',o:', order_name) END, ',f:', family, CASE WHEN genus = '' THEN '' ELSE concat(',g:', genus) END, CASE WHEN species = '' THEN '' ELSE concat(',s:', replace(species, ' ', '_')) END, ';') AS header, sequence FROM barcode")
def _(spark, d):
    return writers.sintax(barcode(spark, d))


@query("out_comparison", f"{_KNOWN} SELECT f.identifier, f.finest_name AS lineage_before, h.used AS lineage_after, f.finest_name IS DISTINCT FROM h.used AS changed FROM finest f LEFT JOIN hits h USING (identifier)")
def _(spark, d):
    b = barcode(spark, d)
    after = taxonomy.harmonize(b, backbone(spark, d)).select("pos", "identifier", F.col("used_name").alias("lineage"))
    return writers.comparison(taxonomy.finest(b).select("pos", "identifier", F.col("finest_name").alias("lineage")), after)


# ---- the chain --------------------------------------------------------------------------------------------------

@query("post_filter_chain", f"{_STRAND}, degapped AS (SELECT replace(header, ' ', '_') AS header, replace(h.sequence, '-', '') AS sequence FROM headed h JOIN chosen USING (sequence) WHERE stop_count <= 0), cut AS (SELECT header, CASE WHEN strpos(header, '||') > 0 THEN substr(header, 1, strpos(header, '||') - 1) ELSE header END AS truncated, sequence FROM degapped WHERE length(sequence) - length(replace(sequence, 'N', '')) <= 3 AND length(sequence) BETWEEN 96 AND 1569) SELECT truncated AS header, sequence FROM cut WHERE NOT (strpos(header, '||') > 0 AND strpos(truncated, '|') = 0)")
def post_filter_chain(spark, d):
    """Underscores, stop codons (on sequences with their gaps, which lie within codons), degapping, Ns, length, lineage
    gaps. All but the stop codons look at one record alone, so they come first and fewer sequences are translated.
    Records are written once: filters would derive a record's sequence anew for each of their conditions, twice over."""
    x = sequence.underscore_headers(written(headed(spark, d).select("header", "sequence"), "records")).withColumn("_given", F.col("sequence"))
    x = sequence.length_range(sequence.max_char(sequence.degap(x), "N", 3), 96, 1569)
    x = lineage.truncate_missing_rank(x).where("not removed").select("truncated", F.col("sequence").alias("degapped"), F.col("_given").alias("sequence"))
    return sequence.stop_codon_info(x).where("not discarded").select(F.col("truncated").alias("header"), F.col("degapped").alias("sequence"))


_FINAL = ", ".join(f"coalesce(a[{i + 1}], '') AS {c}" for i, c in enumerate(_RANKS.split(", ")))
_CHAIN = f"""{_HARMONIZED}, kept AS (SELECT b.pos, b.identifier, b.sequence, h.used_id, {', '.join('s.' + c for c in _RANKS.split(', '))}
  FROM barcode b JOIN hits h USING (identifier) JOIN standard s ON s.id = h.used_id
  WHERE b.source <> 'GENBANK' AND length(b.sequence) - length(replace(b.sequence, 'N', '')) <= 3 AND length(b.sequence) BETWEEN 96 AND 101
    AND CASE WHEN b.source = 'GBOL' THEN 'Germany' ELSE b.country END IN ('Germany', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_9')
    AND (s.genus <> '' OR s.species <> '') AND h.used_id IN (SELECT id FROM up WHERE name = 'Animalia')),
lined AS (SELECT *, string_split(rtrim(concat_ws('|', {_RANKS}), '|'), '|') AS t FROM kept),
cand AS (SELECT sequence, t, count(*) AS n, min(pos) AS first_pos FROM lined GROUP BY sequence, t),
tied AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY sequence ORDER BY len(t) DESC, n DESC) AS r FROM cand) WHERE r = 1),
met AS (SELECT sequence, list_reduce(list(t ORDER BY first_pos), lambda a, x: {_begin('a', 'x')}) AS t FROM tied GROUP BY sequence),
agreed AS (SELECT sequence, {_KNOWN_PART} AS a FROM met),
picked AS (SELECT l.sequence, any_value(a) AS a, count(*) AS specimens, arg_min(identifier, CASE WHEN t = a THEN pos ELSE pos + 1000000000 END) AS identifier,
  arg_min(CASE WHEN t = a THEN used_id ELSE -1 END, CASE WHEN t = a THEN pos ELSE pos + 1000000000 END) AS id FROM lined l JOIN agreed USING (sequence) GROUP BY l.sequence)
SELECT identifier, {_FINAL}, CASE WHEN id >= 0 THEN CAST(id AS BIGINT) END AS taxon_id, specimens, sequence FROM picked"""


@query("classify_chain", _CHAIN)
def _(spark, d):
    """Files of three sources, harmonized, filtered, restricted to a taxon and to countries, and dereplicated."""
    params = Parameters(taxon="Animalia", sources=("all",), folders={"bold_release": bold_file(spark, d), "gbol": gbol_file(spark, d), "genbank": genbank_file(spark, d)}, derep={"lca": True}, max_n=3, min_length=96, max_length=101, taxon_rank="genus",
                        region={"countries": ("Germany", "NATION_1", "NATION_2", "NATION_3", "NATION_9")}).checked()
    places = countries(spark, d).unionByName(spark.createDataFrame([("Germany", "EUROPE")], "country string, continent string"))
    given = {k: v.withColumn("pos", F.expr("CAST(substring(identifier, 4) AS BIGINT)")) for k, v in chain.sources(spark, params).items()}
    return chain.classify(given, params, backbone(spark, d), places)["table"].select("identifier", *_RANKS.split(", "), "taxon_id", "specimens", "sequence")


def queries():
    return dict(_Q)


def oracle_sql():
    return dict(_O)
