import glob
import gzip
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandforge.functions.expressions import genetic_code, header_taxa, in_shape, internal_stops, jaro_winkler_similarities, reverse_complement, translate
from strandforge.operators import lineage, region, sequence, taxonomy
from strandforge.plans import catalogue, classify, command
from strandforge.plans.config import Parameters, parsed, read_config
from strandforge.sources import readers, writers


def test_fasta_files(spark, tmp_path):
    (tmp_path / "a.fas").write_bytes(b">x one\r\nAC\r\nGT\r\n>empty\n>blank\n\n>y|\nTT\n>x one\nNN")
    got = {r.header: r.sequence for r in readers.fasta(spark, str(tmp_path / "a.fas")).collect()}
    assert got == {">x one": "ACGTNN", ">blank": "", ">y|": "TT"}
    with gzip.open(tmp_path / "b.fas.gz", "wb") as f:
        f.write(b">z\nAC\n")
    assert readers.fasta(spark, str(tmp_path / "b.fas.gz")).first().sequence == "AC"


def test_folder_and_clusters(spark, tmp_path):
    (tmp_path / "k1.fas").write_text(">a|T\nAC\n")
    (tmp_path / "k2.fas").write_text(">a|T\nGG\n>nopipe\nTT\n")
    rows = {r.header: r for r in readers.cluster_parts(readers.fasta_folder(spark, str(tmp_path))).collect()}
    assert set(rows) == {">k1|a|T", ">k2|a|T", ">k2|nopipe"} and rows[">k1|a|T"].member == "a|T"
    one = readers.cluster_parts(spark.createDataFrame([(">alone",)], "header string")).first()
    assert one.rejected and one.cluster is None


def test_specimens(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("\t".join(["identifier", "kingdom", "phylum", "class", "order", "family", "genus", "species", "location", "latitude", "longitude", "sequence"]) + "\nI1\tA\t\tC\tO\tF\tG\tG s\tBayern, Germany\t48.95\t\tACGT\n")
    r = readers.specimens(spark, str(tmp_path / "s.tsv")).first()
    assert (r.phylum, r.latitude, r.longitude, r.order) == ("", 48.95, None, "O")


def test_shapefile(spark, tmp_path):
    outer, hole = [(0.0, 0.0), (0.0, 9.0), (9.0, 9.0), (9.0, 0.0), (0.0, 0.0)], [(3.0, 3.0), (6.0, 3.0), (6.0, 6.0), (3.0, 6.0), (3.0, 3.0)]
    shp, dbf, shx = catalogue.shapefile_bytes({"Alps": [outer, hole], "Sea": [[(20.0, 0.0), (20.0, 5.0), (25.0, 5.0)]]})
    (tmp_path / "p.shp").write_bytes(shp)
    (tmp_path / "p.dbf").write_bytes(dbf)
    whole = readers.shapefile(spark, str(tmp_path / "p.shp"), "NAME", ["Alps"]).collect()  # without an index
    (tmp_path / "p.shx").write_bytes(shx)
    shapes = readers.shapefile(spark, str(tmp_path / "p.shp"), "NAME", ["Alps"])
    assert [[(p.lon, p.lat) for p in r] for r in shapes.first().rings] == [outer, hole] and shapes.collect() == whole
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 4.5, 4.5), (3, 10.0, 1.0), (4, None, 1.0), (1, 1.0, 1.0), (5, 8.0, 8.5)], "id int, longitude double, latitude double")
    assert sorted(r.id for r in region.by_polygon(points, shapes).collect()) == [1, 1, 5]  # repeated records stay
    # two overlapping shapes of one name are one region
    twice = shapes.unionByName(shapes.withColumn("shape", F.lit(9)))
    assert sorted(r.id for r in region.by_polygon(points, twice).collect()) == [1, 1, 5]


def test_jaro_winkler():
    def plain(a, b):
        if not a or not b:
            return 0.0
        reach, used, found = max(max(len(a), len(b)) // 2 - 1, 0), [False] * len(b), []
        for i, x in enumerate(a):
            for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
                if not used[j] and b[j] == x:
                    used[j] = True
                    found.append(x)
                    break
        if not found:
            return 0.0
        moved = sum(x != y for x, y in zip(found, [y for y, u in zip(b, used) if u])) // 2
        m = len(found)
        jaro, head = (m / len(a) + m / len(b) + (m - moved) / m) / 3, 0
        while head < min(4, len(a), len(b)) and a[head] == b[head]:
            head += 1
        return jaro + 0.1 * head * (1 - jaro) if jaro >= 0.7 else jaro

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("ABCD*") for _ in range(rng.choice([0, 1, 2, 3, 9, 40])))
    pairs = [(word(), word()) for _ in range(600)] + [("MARTHA", "MARHTA"), ("ABC", "ABC")]
    assert jaro_winkler_similarities(*map(list, zip(*pairs))).tolist() == pytest.approx([plain(a, b) for a, b in pairs])
    assert jaro_winkler_similarities([], []).tolist() == [] and jaro_winkler_similarities(["", ""], ["", ""]).tolist() == [0, 0]


def test_genetic_codes():
    assert genetic_code(5) == "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSSSVVVVAAAADDEEGGGG"
    assert genetic_code(2) == "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG"
    assert genetic_code(9) == "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNNKSSSSVVVVAAAADDEEGGGG"
    assert genetic_code(11) == genetic_code(1) and all(len(genetic_code(n)) == 64 for n in (3, 4, 6, 13, 14, 16, 21, 22, 24, 33))
    with pytest.raises(ValueError):
        genetic_code(7)


def tree(spark, rows):
    return spark.createDataFrame(rows, "taxon_id int, parent_id int, name string, rank string, status string, accepted_id int, is_extinct boolean")


def test_deep_lineages_and_synonyms(spark):
    deep = tree(spark, [(i, i - 1 if i else None, f"t{i}", "clade", "accepted", None, False) for i in range(45)] + [(99, 500, "orphan", "genus", "accepted", None, False)])
    got = {r.taxon_id: [x.name for x in r.path] for r in taxonomy.lineages(deep).collect()}
    assert got == {i: [f"t{k}" for k in range(i + 1)] for i in range(45)} | {99: ["orphan"]}
    with pytest.raises(ValueError):
        taxonomy.lineages(tree(spark, [(1, 2, "a", "genus", "accepted", None, False), (2, 1, "b", "genus", "accepted", None, False)])).collect()
    chain = tree(spark, [(i, None, f"s{i}", "species", "synonym", i + 1, False) for i in range(9)] + [(9, None, "good", "species", "accepted", None, False), (20, None, "lost", "species", "synonym", 77, False)])
    assert {r.taxon_id: r.used_name for r in taxonomy.resolve_synonyms(chain).collect()} == {i: "good" for i in range(10)} | {20: "lost"}


def test_taxon_subset(spark):
    t = tree(spark, [(1, None, "Animalia", "kingdom", "accepted", None, False), (2, 1, "Morus", "genus", "accepted", None, False), (3, 1, "Morus", "family", "accepted", None, False), (4, 1, "Dodo", "species", "accepted", None, True),
                     (5, 2, "Morus alba", "species", "accepted", None, False), (6, 1, "Old", "genus", "synonym", 2, False), (7, 1, "Old", "genus", "accepted", None, False)])
    assert taxonomy.taxon(t, "Morus", "genus") == (2, "genus") and taxonomy.taxon(t, "Old") == (7, "genus")
    for bad in (("Morus", None), ("Dodo", None), ("Nothing", None), ("Morus", "order")):
        with pytest.raises(ValueError):
            taxonomy.taxon(t, *bad)
    rows = spark.createDataFrame([(1, 5, "", ""), (2, 2, "x", ""), (3, None, "Morus", ""), (4, 3, "Morus", ""), (5, None, "", "")], "id int, taxon_id int, genus string, species string")
    assert sorted(r.id for r in taxonomy.subset(rows, "Morus", t, "genus").collect()) == [1, 2, 3]


def test_replace_names(spark):
    rows = spark.createDataFrame([("Gen1", "Gen1 a", "near Gen1"), ("Gen2", "Gen2 b", ""), ("", "", "x"), ("Gen7", "Gen7 c", "y")], "genus string, species string, location string")
    pairs = spark.createDataFrame([("genus", f"Gen{i}", f"New{i}") for i in range(1, 12_000) if i != 2] + [("species", "Gen2 b", "Other c"), ("genus", "", "never")], "taxon_rank string, taxon_to_replace string, taxon_to_use string")
    got = {tuple(r) for r in lineage.replace_names(rows, pairs, ["genus", "species", "location"], ["genus", "species"]).collect()}
    assert got == {("New1", "New1 a", "near New1"), ("Gen2", "Other c", ""), ("", "", "x"), ("New7", "New7 c", "y")}


def test_support_against_all_pairs(spark):
    rng = random.Random(2)
    rows = {(rng.choice("pq"), tuple(rng.choice("ABCDE") for _ in range(rng.randrange(5)))): rng.randrange(1, 9) for _ in range(120)}
    contains = lambda a, b: len(set(a)) == len(a) and set(b) <= set(a)
    want = {(c, a): n + sum(m for (d, b), m in rows.items() if d == c and b != a and contains(a, b)) for (c, a), n in rows.items()}
    counts = spark.createDataFrame([(c, list(a), n) for (c, a), n in rows.items()], "cluster string, taxa array<string>, count long")
    assert {(r.cluster, tuple(r.taxa)): r.support for r in lineage.support(counts).collect()} == want


def test_support_sends_no_table(spark):
    """Files tell a small part of what their rows take in memory, so tables of all clusters are never sent around."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    counts = spark.createDataFrame([("c", ["A"], 1), ("c", ["A", "B"], 4)], "cluster string, taxa array<string>, count long")
    assert "Broadcast" not in plan(lineage.support(counts))
    assert "Broadcast" not in plan(lineage.by_ratio(counts, 1.5))
    assert lineage.by_ratio(counts, 1.5).first().taxa == ["A", "B"] and lineage.by_ratio(counts.where("count = 1"), 1.5).first().taxa == ["A"]


def test_cluster_headers(spark):
    rows = [("c", "i", ">i|A|B||", ["A", "B"], "AC"), ("c", "i", ">i|A|B||", ["A", "B"], "GT"), ("c", "j", ">j|A", ["A"], "TT")]
    m = spark.createDataFrame(rows, "cluster string, identifier string, header string, taxa array<string>, sequence string")
    got = {(r.identifier, r.taxon_original, r.taxon_curated, r.count_original) for r in lineage.curate(m).collect()}
    assert got == {("i", "A|B||", "A|B", 1), ("j", "A", "A|B", 1)}
    assert {r.header for r in lineage.curated_fasta(lineage.curate(m)).collect()} == {">i|A|B", ">j|A|B"}


def test_sequence_expressions(spark):
    df = spark.createDataFrame([("ATGTTTTGAATAAGATAANCC",), ("ac-N",), ("A",), (None,)], "s string")
    got = [(r[0], r[1]) for r in df.select(translate(F.col("s"), 1), reverse_complement(F.col("s"))).collect()]
    assert got == [("MFWMS*X", "GGNTTATCTTATTCAAAACAT"), ("X", "N-GT"), ("", "T"), (None, None)]
    stops = spark.createDataFrame([("*A*B*",), ("**",), ("",)], "p string").select(internal_stops(F.col("p"))).collect()
    assert [r[0] for r in stops] == [1, 0, 0]


def test_headers(spark):
    df = spark.createDataFrame([(">i|A||C|",), (">i",), (">i||B",), (">i|A",)], "header string")
    assert [r[0] for r in df.select(header_taxa(F.col("header"))).collect()] == [["A", "", "C"], [], ["", "B"], ["A"]]
    got = {r.header: (r.truncated, r.removed) for r in lineage.truncate_missing_rank(df).collect()}
    assert got == {">i|A||C|": (">i|A", False), ">i": (">i", False), ">i||B": (">i", True), ">i|A": (">i|A", False)}


def test_strand_and_stops(spark):
    codon = {"M": "ATG", "F": "TTT", "L": "CTT", "T": "ACT", "Y": "TAT", "G": "GGT", "A": "GCT", "W": "TGG", "S": "TCT", "V": "GTT", "R": "CGT", "I": "ATT", "E": "GAA", "Q": "CAA", "P": "CCT", "D": "GAT", "N": "AAT", "H": "CAT", "K": "AAA"}
    from strandforge.functions.expressions import CONSENSUS

    nuc = "".join(codon[c] for c in CONSENSUS[:80])
    back = nuc[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = {r.sequence: r for r in sequence.stop_codon_info(spark.createDataFrame([(nuc,), (back,), (nuc[:120] + "TAA" + nuc[123:],)], "sequence string")).collect()}
    assert not rows[nuc].reversed and not rows[nuc].discarded
    assert rows[back].reversed and rows[back].oriented_sequence == nuc
    assert rows[nuc[:120] + "TAA" + nuc[123:]].discarded


def test_folds(spark):
    def of(rows):
        return spark.createDataFrame([("c", t, n) for t, n in rows], "cluster string, taxa array<string>, count long")
    nested = of([(["A", "B", "C"], 1), (["A", "B"], 5)])
    assert lineage.congruent(nested).first().taxa == ["A", "B", "C"]
    assert lineage.common_ancestor(nested).first().taxa == ["A", "B"]
    assert lineage.majority(nested).first().taxa == ["A", "B"]
    assert lineage.congruent(of([(["A", "", ""], 2)])).first().taxa == ["A", "", ""]
    # repeated empty ranks: not contained in itself united with a part of it
    assert lineage.congruent(of([(["A", "", ""], 2), (["A"], 1)])).first().taxa == ["A"]
    assert lineage.by_ratio(of([(["A", "B"], 6), (["A", "C"], 2)]), 3.0).first().taxa == ["A", "B"]
    assert lineage.by_ratio(of([(["A", "B"], 6), (["A", "C", "D"], 4)]), 3.0).first().taxa == ["A", "C", "D"]
    assert lineage.without_conflict(nested).isEmpty()


def test_concave_ring(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat")) for x, y in [(0, 0), (6, 0), (6, 6), (4, 6), (4, 2), (2, 2), (2, 6), (0, 6)]])
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (3.0, 1.0), (7.0, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(in_shape(F.col("x"), F.col("y"), F.array(ring))).collect()] == [True, False, True, False]


def test_writers_keep_the_order(spark, tmp_path):
    rows = [(f">h{i}", "ACGT", i) for i in range(400)]
    random.Random(3).shuffle(rows)
    writers.write_fasta(spark.createDataFrame(rows, "header string, sequence string, pos long").repartition(7), str(tmp_path / "out"))
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{tmp_path}/out/part-*")))
    assert text == "".join(f">h{i}\nACGT\n" for i in range(400))
    assert readers.fasta(spark, str(tmp_path / "out")).count() == 400
    writers.write_tsv(spark.createDataFrame([(" a", 'say "x"', 2), ("b ", "", 1)], "p string, q string, pos long"), str(tmp_path / "t"))
    lines = [x for p in sorted(glob.glob(f"{tmp_path}/t/part-*")) for x in open(p).read().splitlines() if x != "p\tq"]
    assert lines == ["b \t", ' a\tsay "x"']


def test_bold_and_genbank_details(spark, tmp_path):
    head = ["processid", "kingdom", "genus", "species", "marker_code", "nuc", "country/ocean", "coord", "more"]
    rows = [["P1", "Animalia", "Apis", "Apis \"m\"", "COI-5P", "AC-GT", "None", "(48.5, -11.25)", "x"], ["P2", "Animalia", "None", "", "COI-5P", "", "Peru", "None", "x"], ["P3", "Animalia", "", "", "ITS", "AC", "Peru", "None", "x"]]
    (tmp_path / "b.tsv").write_text("\n".join("\t".join(r) for r in [head, *rows]) + "\n")
    r = readers.bold_release(spark, str(tmp_path / "b.tsv")).collect()
    assert [(x.identifier, x.species, x.phylum, x.country, x.latitude, x.longitude, x.sequence) for x in r] == [("P1", 'Apis "m"', "", None, 48.5, -11.25, "AC-GT")]
    flat = """LOCUS       AB1 10 bp
ACCESSION   AB1 AB9
  ORGANISM  Apis mellifera
            Eukaryota; Metazoa.
FEATURES             Location/Qualifiers
     source          1..10
                     /country="Peru"
                     /lat_lon="4.5 S 70.25 W"
     gene            <1..>10
                     /gene="COI"
ORIGIN
        1 acgtn acgta
//
LOCUS       AB2
ACCESSION   AB2
  ORGANISM  Apis sp. BOLD:AAA1
FEATURES             Location/Qualifiers
     CDS             complement(join(4..5,1..2))
                     /product="cytochrome c oxidase
                     subunit I"
ORIGIN
        1 aacgt
//
LOCUS       AB3
ACCESSION   AB3
  ORGANISM  Apis mellifera
FEATURES             Location/Qualifiers
     CDS             1..3
                     /gene="COX2"
ORIGIN
        1 aaa
//
LOCUS       AB4
ACCESSION   AB4
  ORGANISM  Apis mellifera
ORIGIN
        1 aaa
//
"""
    with gzip.open(tmp_path / "g.seq.gz", "wt") as f:
        f.write(flat)
    got = {x.identifier: (x.genus, x.species, x.country, x.location, x.latitude, x.longitude, x.sequence) for x in readers.genbank(spark, str(tmp_path / "g.seq.gz")).collect()}
    assert got == {"AB1": ("Apis", "Apis mellifera", "Peru", None, -4.5, -70.25, "ACGTNACGTA"), "AB2": ("Apis", "", None, None, None, None, "TTAC")}


def test_parameters():
    assert Parameters(sources=("all",)).checked().sources == ("genbank", "gbol", "bold")
    for bad in (dict(outputs=("kraken2",), taxonomy="gbif"), dict(outputs=("dada2_species",), taxon_rank="genus"), dict(shapefile={"path": "x"}), dict(derep={"lca": True, "first": True}), dict(outputs=("paper",)), dict(taxon_rank="tribe"), dict(marker="its")):
        with pytest.raises(ValueError):
            Parameters(**bad).checked()
    assert Parameters(derep={"lca": True}, action="download").checked().derep == {}
    assert Parameters(folders={"gbol": "x", "bold_release": "y"}).checked().sources == ("gbol", "bold")


def test_command_line():
    p = parsed("-t Hymenoptera --num_cores 9 classify --gbol --midori_dir /m/x.gz -n filter -N 3 --taxon_rank species derep -l --random taxonomy --gbif --retain output --sintax true --comparison false".split())
    assert (p.taxon, p.num_cores, p.action, p.sources, p.folders, p.merge) == ("Hymenoptera", 9, "classify", ("gbol", "midori"), {"midori": "/m/x.gz"}, False)
    assert (p.max_n, p.taxon_rank, p.strategy(), p.taxonomy, p.retain, p.synonyms_allowed, p.outputs) == (3, "species", "first", "gbif", True, False, ("table", "fasta", "sintax"))
    p = parsed(["nonsense", "download", "--all", "--gbol_dir", "/g", "derep", "--discard", "region", "--country", "Peru;Chad", "-k", "Asia", "-s", "a.shp", "-S", "NAME", "-v", "Alps;Jura"])
    assert (p.action, p.sources, p.derep, p.region, p.shapefile) == ("download", ("genbank", "gbol", "bold"), {}, {"countries": ("Peru", "Chad"), "continents": ("Asia",)}, {"path": "a.shp", "attribute": "NAME", "values": ("Alps", "Jura")})
    assert parsed(["classify", "--bold_release", "classify"]).folders == {"bold_release": "classify"}
    assert parsed([]).action is None and parsed(["region", "-C"]).region == {"listing": "countries"}
    for bad in (["download", "-a", "classify", "-a"], ["taxonomy", "--gbif", "output", "--kraken2", "true"], ["region", "-s", "a.shp"], ["filter", "-r", "tribe"]):
        with pytest.raises(ValueError):
            parsed(bad)


def test_config_file():
    text = ":taxon: Orthoptera\n:markers: co1\n:num_cores: 3\n:taxonomy:\n  :gbif: true # the backbone\n:derep:\n  :last_common_ancestor: true\n  :no_derep: false\n:output:\n  :table: true\n  :fasta: false\n  :sintax: true\n"
    p = Parameters().merged(read_config(text)).checked()
    assert (p.taxon, p.num_cores, p.taxonomy, p.strategy(), p.outputs) == ("Orthoptera", 3, "gbif", "lca", ("table", "sintax"))


def test_run_writes_all_files(spark, sf, tmp_path):
    d, down = str(tmp_path), str(tmp_path / "downloads")
    import shutil

    for name, path in (("GBOL", catalogue.gbol_file(spark, sf)), ("BOLD", catalogue.bold_folder(spark, sf))):
        shutil.copytree(path.removeprefix("file:"), f"{down}/{name}/{'GBOL_Dataset_Release' if name == 'GBOL' else 'Animalia'}-20210128T1000")
        (tmp_path / "downloads" / name / "Animalia-20190101T1000").mkdir()
        (tmp_path / "downloads" / name / "Plantae-20230101T1000").mkdir()
    params = parsed(["-t", "Animalia", "classify", "--gbol", "--bold", "derep", "-l", "filter", "-N", "3", "output", "-k", "true", "-q", "true", "-x", "true", "-s", "true", "-d", "true"])
    out = classify.run(spark, params, f"{d}/results", datetime(2021, 3, 17, 16, 4), catalogue.backbone(spark, sf), catalogue.countries(spark, sf), downloaded=down)
    assert {p.split("/results/")[1] for p in out.values()} == {f"Animalia-20210317T1604/{x}" for x in (
        *[f"Animalia_derep_all_{x}" for x in ("output.tsv", "output.fas", "comparison.tsv", "qiime2_taxonomy.txt", "qiime2_taxonomy.fas", "kraken2.fas", "dada2_taxonomy.fas", "dada2_species.fas", "sintax.fas")],
        "parameters.txt", "parameters.json", "gbol_download_info.txt", "bold_download_info.txt")}
    once_more = classify.again(spark, f"{d}/results/Animalia-20210317T1604", f"{d}/again", datetime(2022, 1, 1), backbone=catalogue.backbone(spark, sf), countries=catalogue.countries(spark, sf), downloaded=down)
    same = lambda o: sorted(r.value for r in spark.read.text(o["Animalia_derep_all_output.tsv"]).collect())
    assert set(once_more) == set(out) and same(once_more) == same(out)
    read = {k: spark.read.text(p).count() for k, p in out.items()}
    assert read["gbol_download_info.txt"] == 1 and read["Animalia_derep_all_output.fas"] > 100
    fasta = readers.fasta(spark, out["Animalia_derep_all_output.fas"])
    assert fasta.count() == fasta.select("sequence").distinct().count() and fasta.where("header not like '>SPC%|Animalia|%'").isEmpty()
    apart = classify.run(spark, parsed(["-t", "Animalia", "classify", "--gbol", "--no_merge", "output", "-f", "false", "-c", "false", "taxonomy", "--unmapped"]), f"{d}/apart", datetime(2021, 3, 17, 16, 4), downloaded=down)
    assert set(apart) == {"gbol_output.tsv", "parameters.txt", "parameters.json", "gbol_download_info.txt"}
    with pytest.raises(ValueError):
        classify.classify(classify.sources(spark, params, down), parsed(["-t", "Animalia", "classify", "--gbol", "region", "-c", "Atlantis"]), catalogue.backbone(spark, sf), catalogue.countries(spark, sf))


def test_commands(spark, sf, tmp_path):
    d = str(tmp_path)
    catalogue.countries(spark, sf).write.parquet(f"{d}/places/countries")
    (tmp_path / "dumps" / "gbif").mkdir(parents=True)
    for name, text in (("Taxon.tsv", "taxonID\tparentNameUsageID\tacceptedNameUsageID\tcanonicalName\ttaxonRank\ttaxonomicStatus\n1\t\t\tAnimalia\tKINGDOM\taccepted\n2\t1\t\tApis\tGENUS\taccepted\n3\t1\t\tApis\tGENUS\tdoubtful\n"),
                       ("SpeciesProfile.tsv", "taxonID\tisExtinct\n3\ttrue\n"), ("release", "2021-01\n")):
        (tmp_path / "dumps" / "gbif" / name).write_text(text)
    say = lambda *words: command.main(spark, list(words), d, datetime(2021, 3, 17, 16, 4))
    assert "AMERICA" in say("region", "--available_continents") and say("--version") == [command.VERSION]
    assert say("update", "--check_gbif_taxonomy") == ["gbif: new release"]
    assert say("setup", "--gbif_taxonomy", "--gbif_homonyms") == ["imported gbif", "imported gbif-homonyms"]
    assert [tuple(r) for r in spark.read.parquet(f"{d}/taxonomy/gbif-homonyms").collect()] == [("Apis", "genus", 2)]
    assert say("update", "--gbif_taxonomy", "--check_gbif_taxonomy") == ["gbif: up to date"]
    (tmp_path / "dumps" / "gbif" / "release").write_text("2022-07")
    spark.catalog.clearCache()
    assert say("update", "--gbif_taxonomy") == ["imported gbif"]
    (tmp_path / "b.tsv").write_text("processid\tkingdom\tgenus\tspecies\tmarker_code\tnuc\nP1\tAnimalia\tApis\tApis x\tCOI-5P\tACGT\nP2\tAnimalia\t\t\tCOI-5P\tACGN\n")
    out = say("-t", "Animalia", "classify", "--bold_release", f"{d}/b.tsv", "taxonomy", "--gbif", "--retain", "output", "-c", "false")
    assert [x.rsplit("/", 1)[-1] for x in out] == ["bold_download_info.txt", "merged_output.fas", "merged_output.tsv", "parameters.json", "parameters.txt"]
    assert {r.value for r in spark.read.text(out[1]).collect()} == {">P1|Animalia|||||Apis|Apis x", "ACGT", ">P2|Animalia", "ACGN"}
    with pytest.raises(ValueError):
        say("download", "--all")
