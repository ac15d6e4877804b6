"""Input order, headers without a pipe, tables by name, feature tables, downloads, homonyms, scripts."""

import glob
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandforge.operators import contaminants, derep, taxonomy
from strandforge.plans import catalogue, classify, command, scripts
from strandforge.plans.config import Parameters, parsed
from strandforge.sources import genbank, readers, scratch, writers


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def lines_of(path):
    return [x for p in sorted(glob.glob(f"{path}/part-*")) for x in open(p).read().splitlines()]


def test_order_over_files_and_splits(spark, tmp_path, small_splits):
    folder, want = tmp_path / "in", {}
    folder.mkdir()
    rng = random.Random(1)
    for name, n in (("a.fas", 3), ("b c.fas", 150), ("d.fas", 20)):
        text = ""
        for i in range(n):
            header, body = f">h{rng.randrange(60)} {'x' * rng.randrange(30)}"[:12], "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 60)))
            want[header] = want.get(header, "") + body
            text += f"{header}\n{body}\n"
        (folder / name).write_text(text)
    writers.write_fasta(readers.fasta(spark, str(folder)), str(tmp_path / "out"))
    assert lines_of(tmp_path / "out") == [x for h, s in want.items() for x in (h, s)]
    names = [f.rsplit(".", 1)[0] for f in ("a.fas", "b c.fas", "d.fas")]
    tags = [r.header[1:].split("|")[0] for r in readers.fasta_folder(spark, str(folder)).orderBy("pos").collect()]
    assert list(dict.fromkeys(tags)) == names and tags == sorted(tags)


def test_headers_without_a_pipe(spark, tmp_path, small_splits):
    rng, text, want, header = random.Random(2), ">before\nAC\n", {}, None
    for i in range(400):
        body = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 40)))
        if rng.random() < 0.3 or 100 < i < 160:  # a run of them that is longer than a split
            text += f">no pipe {i}\n{body}\n"
            if header:
                want[header] = want.get(header, "") + f">no pipe {i}{body}"
        else:
            header = f">c{rng.randrange(9)}|m{rng.randrange(30)}|T"
            text += f"{header}\n{body}\n"
            want[header] = want.get(header, "") + body
    (tmp_path / "x.fas").write_text(text)
    (tmp_path / "y.fas").write_text(">alone\nACGT\n>c|m\n>bare\n")  # a piped header without lines of its own
    got = {f">{r.cluster}|{r.member}": r.sequence for r in readers.clustered(spark, str(tmp_path)).collect()}
    assert got == want | {">c|m": ">bare"}


def test_files_in_parts(spark, tmp_path, small_splits):
    """A folder in the folder is one file: its own name counts, its parts come in order."""
    want = []
    for name, n in (("a b.fas", 90), ("c.fas", 40)):
        rows = [(f">h{i}", "ACGT" * (i % 5 + 1), i) for i in range(n)]
        parts = spark.createDataFrame(rows, "header string, sequence string, pos long").repartitionByRange(3, "pos").sortWithinPartitions("pos")
        writers.fasta_text(parts).write.text(str(tmp_path / "in" / name))
        want += [(f">{name[:-4]}|{h[1:]}", s) for h, s, _ in rows]
    (tmp_path / "in" / "b.fas").write_text(">x\nAC\n>y\n\n>z\n")
    want[90:90] = [(">b|x", "AC"), (">b|y", "")]
    assert len(glob.glob(str(tmp_path / "in" / "a b.fas" / "part-*"))) > 1
    assert [(r.header, r.sequence) for r in readers.fasta_folder(spark, str(tmp_path / "in")).orderBy("pos").collect()] == want


def test_clusters_are_read_few_times(spark, tmp_path):
    """Records with a pipe, those without, and a row a block; each with the ends of files."""
    (tmp_path / "x.fas").write_text(">c|m\nAC\n>none\nGT\n")
    plan = readers.clustered(spark, str(tmp_path / "x.fas"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") <= 6


def test_specimens_by_name(spark, tmp_path):
    (tmp_path / "s.tsv").write_text('sequence\tlatitude\textra\tidentifier\tlocation\torder\n' 'ACGT\t1.5\t"\tI1\t"Town, near\tO"x"\nAC\t\t\t\t say "a" \t\n')
    rows = readers.specimens(spark, str(tmp_path / "s.tsv")).orderBy("pos").collect()
    assert [(r.identifier, r.location, r.order, r.latitude, r.sequence, r.kingdom) for r in rows] == [("I1", '"Town, near', 'O"x"', 1.5, "ACGT", ""), ("", ' say "a" ', "", None, "AC", "")]
    writers.write_tsv(readers.specimens(spark, str(tmp_path / "s.tsv")), str(tmp_path / "t"))
    again = readers.specimens(spark, str(tmp_path / "t")).orderBy("pos").drop("pos").collect()
    assert again == readers.specimens(spark, str(tmp_path / "s.tsv")).orderBy("pos").drop("pos").collect()


@pytest.mark.parametrize(("location", "want"), [
    ("3..5", "GTA"), ("<3..>5", "GTA"), ("4", "T"), ("complement(3..5)", "TAC"), ("join(1..2,9..10)", "ACGN"), ("complement(join(1..2,9..10))", "NCGT"),
    ("join(complement(9..10),complement(1..2))", "NCGT"), ("order(complement(join(1..2,4..4)),7..8)", "AGTTT"), ("join(8..10,\n   1..2)", "TGNAC"), ("complement(complement(3..5))", "GTA"),
    ("join(3^4,5..6)", "AC"), ("3^4", None), ("J00194.1:3..5", None), ("join(1..2,J00194.1:3..5)", None), ("3.5..7", None), ("one-of(1,2)..5", None), ("9..11", None), ("5..3", None), ("0..2", None),
    ("join(1..2", None), ("1..2)", None), ("complement(1..2,3..4)", None), ("", None), ("join()", None)])
def test_locations(location, want):
    assert genbank.cut(genbank.segments(location), "ACGTACTTGN") == want


def test_feature_tables():
    record = """LOCUS       X
FEATURES             Location/Qualifiers
     source          1..40
                     /note="has /gene=""COX1"" and
                     more"
     CDS             complement(join(1..4,
                     9..12))
                     /gene="cox1"
                     /pseudo
     gene            1..40
                     /gene="COI"
     CDS             5..8
                     /gene="ND2"
                     /product="NADH"
ORIGIN
        1 acgtacgtac gtacgtacgt
"""
    found = list(genbank.features(record))
    assert [(k, x) for k, x, _ in found] == [("source", "1..40"), ("CDS", "complement(join(1..4,9..12))"), ("gene", "1..40"), ("CDS", "5..8")]
    assert found[0][2] == {"note": 'has /gene="COX1" and more'} and found[1][2] == {"gene": "cox1", "pseudo": ""}
    told = readers.MARKERS["co1"]
    assert genbank.marker_of(record, told["genes"], told["products"]) == "ACGTACGT"
    assert genbank.marker_of(record.replace("cox1", "cytb").replace("COI", "cytb"), told["genes"], told["products"]) is None
    assert genbank.marker_of("LOCUS\n", told["genes"], told["products"]) is None


def test_midori_files_of_other_genes(spark, tmp_path):
    for gene in ("CO1", "Cytb"):
        (tmp_path / f"MIDORI2_UNIQ_NUC_GB259_{gene}_RAW.fasta").write_text(f">A{gene}.1.<1.>9###root_1;Animalia_2;x_3;y_4;z_5;f_6;g_7;g s_8\nAC-GT\n")
    assert [(r.identifier, r.sequence) for r in readers.midori(spark, str(tmp_path)).collect()] == [("ACO1", "ACGT")]


def test_downloads_that_hold_a_taxon(spark, tmp_path):
    for name in ("Arthropoda-20210317T1604", "Hymenoptera-20220101T0000", "Diptera-20230101T0000", "Apis_mellifera-20240101T0000"):
        (tmp_path / "BOLD" / name).mkdir(parents=True)
    for name in ("release245", "release99"):
        (tmp_path / "NCBIGENBANK" / name).mkdir(parents=True)
    (tmp_path / "GBOL" / "GBOL_Dataset_Release-20210128").mkdir(parents=True)
    newest = lambda source, *taxa: readers.covering(readers.manifest(spark, f"{tmp_path}/{source}"), list(taxa)).rsplit("/", 1)[1]
    assert newest("BOLD", "Animalia", "Arthropoda", "Hymenoptera", "Apidae") == "Hymenoptera-20220101T0000"
    assert newest("BOLD", "Animalia", "Arthropoda") == "Arthropoda-20210317T1604"
    assert newest("BOLD", "Arthropoda", "Apis", "Apis mellifera") == "Apis_mellifera-20240101T0000"
    assert newest("NCBIGENBANK", "Mollusca") == "release245" and newest("GBOL", "Mollusca") == "GBOL_Dataset_Release-20210128"
    for source in ("BOLD", "NOWHERE"):
        with pytest.raises(ValueError):
            newest(source, "Mollusca")


def tree(spark, rows):
    return spark.createDataFrame(rows, "taxon_id int, parent_id int, name string, rank string, status string, accepted_id int, is_extinct boolean")


def test_homonyms_on_whole_paths(spark):
    own = lambda i, up, name, rank, to=None: (i, up, name, rank, "synonym" if to else "accepted", to, False)
    t = tree(spark, [own(1, None, "Animalia", "kingdom"), own(2, 1, "Arthropoda", "phylum"), own(3, 2, "Insecta", "class"), own(4, 3, "Apidae", "family"), own(5, 4, "Apinae", "subfamily"), own(6, 5, "Bombini", "tribe"), own(7, 6, "Bombus", "genus"),
                     own(8, 3, "Otheridae", "family"), own(9, 8, "Otherinae", "subfamily"), own(10, 9, "Bombus", "genus"), own(11, 1, "Mollusca", "phylum"), own(12, 11, "Bombus", "genus"),
                     own(20, 5, "Twin", "genus"), own(21, 5, "Twin", "genus"), own(22, 5, "Same", "genus"), own(23, 9, "Same", "genus", 22)])
    columns = "id int, kingdom string, phylum string, class string, order_name string, family string, genus string, species string"
    rows = [(1, "Animalia", "Arthropoda", "Insecta", "", "Apidae", "Bombus", ""), (2, "Animalia", "", "", "", "Otheridae", "Bombus", ""), (3, "", "Mollusca", "", "", "", "Bombus", ""), (4, "Animalia", "Arthropoda", "Insecta", "", "", "Bombus", ""),
            (5, "", "", "", "", "", "Bombus", ""), (6, "", "", "", "", "Apidae", "Twin", ""), (7, "Animalia", "", "", "", "", "Same", ""), (8, "", "", "", "", "Wrong", "Bombus", ""), (9, "", "", "", "", "", "", "")]
    records = spark.createDataFrame(rows, columns)
    got = {r.id: r.taxon_id for r in taxonomy.harmonize(records, t, retain=True).collect()}
    # 4, 5 and 8 fit several as well, 6 has twins; 7 stands for one accepted taxon whichever is meant
    assert got == {1: 7, 2: 10, 3: 12, 4: None, 5: None, 6: None, 7: 22, 8: None, 9: None}
    assert {r.id for r in taxonomy.harmonize(records, t).collect()} == {1, 2, 3, 7}


def test_circles_of_synonyms(spark):
    t = tree(spark, [(i, None, f"s{i}", "species", "synonym", i + 1, False) for i in range(6)] + [(6, None, "good", "species", "accepted", None, False)]
             + [(10, None, "a", "species", "synonym", 11, False), (11, None, "b", "species", "synonym", 10, False), (12, None, "c", "species", "synonym", 10, False), (13, None, "own", "species", "synonym", 13, False)])
    assert {r.taxon_id: r.used_id for r in taxonomy.resolve_synonyms(t).collect()} == {i: 6 for i in range(7)} | {13: 13}


def records(spark, rows):
    ranks = ["kingdom", "phylum", "class", "order_name", "family", "genus", "species"]
    return spark.createDataFrame([(i, f"r{i % 3}", "S", None, None, None, None, 100 + i, s, *line) for i, (s, line) in enumerate(rows)],
                                 "pos long, identifier string, source string, country string, location string, latitude double, longitude double, taxon_id long, sequence string, " + ", ".join(f"{r} string" for r in ranks))


def test_common_ancestors_rank_by_rank(spark):
    rows = [("AC", ("Animalia", "P1", "Insecta", "O1", "Apidae", "G", "")), ("AC", ("Animalia", "P2", "Insecta", "O2", "Apidae", "G", "")),
            ("GG", ("Animalia", "", "", "", "Apidae", "G", "")), ("GG", ("Animalia", "", "", "", "Apidae", "H", "")),
            ("TT", ("Animalia", "P1", "C", "", "", "", "")), ("TT", ("Animalia", "P1", "C", "", "", "", "")), ("TT", ("Animalia", "P1", "D", "", "", "", "")),
            ("CC", ("Animalia", "P1", "", "O", "", "", "")), ("CC", ("Animalia", "P1", "C", "O", "", "", "")),
            ("AA", ("", "", "", "", "", "", "")), ("NN", ("A", "", "", "", "", "", "")), ("NN", ("B", "", "", "", "", "", ""))]
    out = {r.sequence: tuple(r[c] for c in ("kingdom", "phylum", "class", "order_name", "family", "genus")) for r in classify.dereplicated(records(spark, rows), "lca").collect()}
    assert out == {"AC": ("Animalia", "", "", "", "", ""), "GG": ("Animalia", "", "", "", "Apidae", ""), "TT": ("Animalia", "P1", "C", "", "", ""), "CC": ("Animalia", "P1", "", "", "", ""), "AA": ("",) * 6, "NN": ("",) * 6}
    told = spark.createDataFrame([("s", ["A", "", "B"], 1), ("s", ["A", "", "C"], 2)], "sequence string, taxa array<string>, pos long")
    assert derep.common(told).first().taxa == ["A"]


def test_comparison_by_record(spark):
    before = records(spark, [("AC", ("Animalia", "P", "", "", "", "", ""))] * 5)
    assert classify.comparison(before, before.withColumn("phylum", F.lit("Q"))).count() == 5


def test_names_of_places(spark):
    given = {"S": records(spark, [("AC", ("Animalia", "P", "", "", "", "", ""))]).drop("taxon_id")}
    shapes = spark.createDataFrame([("Nearctic", [])], "name string, rings array<array<struct<lon:double,lat:double>>>")
    for words, polygons in ((["-b", "Atlantis"], {"realms": shapes}), (["-b", "Nearctic"], {}), (["-e", "Nearctic"], {"realms": shapes}), (["-k", "Asia"], {})):
        with pytest.raises(ValueError):
            classify.classify(given, parsed(["-t", "Animalia", "region", *words]), polygons=polygons)
    assert classify.classify(given, parsed(["-t", "Animalia", "region", "-b", "Nearctic"]), polygons={"realms": shapes})["table"].count() == 0


def test_parameters_are_kept():
    p = parsed("-t Apidae classify --gbol -B /x filter -N 3 derep -l region -c Peru;Chad -s a.shp -S NAME -v Alps".split())
    assert Parameters.of(p.kept()) == p
    with pytest.raises(ValueError):
        Parameters.of('{"colour": 1}')


def test_config_file_of_the_data_folder(spark, tmp_path):
    (tmp_path / "default_config.yaml").write_text(":taxon: Animalia\n:output:\n  :table: true\n  :fasta: false\n:taxonomy:\n  :unmapped: true\n")
    (tmp_path / "b.tsv").write_text("processid\tkingdom\tmarker_code\tnuc\nP1\tAnimalia\tCOI-5P\tACGT\n")
    out = command.main(spark, ["classify", "--bold_release", f"{tmp_path}/b.tsv"], str(tmp_path), datetime(2021, 3, 17, 16, 4))
    assert [x.rsplit("/", 1)[1] for x in out] == ["bold_download_info.txt", "merged_output.tsv", "parameters.json", "parameters.txt"]
    assert command.asked_cores(["-t", "A", "-c", "3", "region", "-c", "9"]) == 3 and command.asked_cores(["region", "-c", "9"]) is None


# ---- contaminants -------------------------------------------------------------------------------------------------

def best_alignment(q, t):
    """(matches, columns) of the best global alignment, the whole table."""
    none, gap = (-10**9, 0, 0), lambda k: -(2 + k) if k else 0
    plus = lambda a, s, k, c: (a[0] + s, a[1] + k, a[2] - c)
    n, m = len(q), len(t)
    h, e, f = ([[none] * (m + 1) for _ in range(n + 1)] for _ in range(3))
    for j in range(m + 1):
        h[0][j] = (gap(j), 0, 0)
    for i in range(1, n + 1):
        h[i][0] = (gap(i), 0, 0)
        for j in range(1, m + 1):
            e[i][j] = max(plus(h[i][j - 1], -22, 0, 1), plus(e[i][j - 1], -2, 0, 1))
            f[i][j] = max(plus(h[i - 1][j], -22, 0, 1), plus(f[i - 1][j], -2, 0, 1))
            same = q[i - 1] == t[j - 1] and q[i - 1] in "ACGT"
            h[i][j] = max(plus(h[i - 1][j - 1], 2 if same else -4, int(same), 1), e[i][j], f[i][j])
    best = max([plus(h[n][j], gap(m - j), 0, 0) for j in range(m + 1)] + [plus(h[i][m], gap(n - i), 0, 0) for i in range(n + 1)])
    return best[1], -best[2]


def changed(rng, s, rate):
    out = ""
    for c in s:
        r = rng.random()
        out += rng.choice("ACGTN") if r < 0.8 * rate else "" if r < 0.9 * rate else c + "".join(rng.choice("ACGT") for _ in range(rng.choice([1, 1, 4]))) if r < rate else c
    return out


def test_contaminants_against_all_alignments(spark):
    rng = random.Random(4)
    new = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    against = [new(rng.randint(70, 110)) for _ in range(6)] + ["AC" * 45]
    against.append(against[0][:50] + against[1][:50])
    given = [changed(rng, rng.choice(against), rng.choice([0.0, 0.05, 0.09, 0.12, 0.16])) for _ in range(60)] + [new(100) for _ in range(10)] + [against[2][30:], new(25) + against[3], against[4][:20], "", "ACGT", "N" * 90]
    want = {}
    for q in given:
        for t in against:
            k, n = best_alignment(q, t)
            if n >= max(contaminants.least_columns(0.9), 0.5 * min(len(q), len(t))) and k >= 0.9 * n - 1e-9:
                want.setdefault(q, set()).add(round(k / n, 9))
    rows = spark.createDataFrame([(str(i), q[:7] + "--" + q[7:].lower()) for i, q in enumerate(given)] + [("x", None)], "identifier string, sequence string")
    other = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(against + against[:2])], "identifier string, sequence string")
    for sent in (contaminants.SENT, 250):  # sent to the tasks, and dealt in blocks
        got = {r.sequence.replace("-", "").upper(): round(r.identity, 9) for r in contaminants.hits(rows, other, sent=sent).collect()}
        assert set(got) == set(want) and all(got[q] in want[q] for q in got)
    assert 15 < len(want) < 60
    kept = {r.identifier for r in contaminants.without_contaminants(rows, other).collect()}
    assert kept == {"x", *(str(i) for i, q in enumerate(given) if q not in want)}
    assert contaminants.hits(rows, other.limit(0)).count() == 0
    with pytest.raises(ValueError):
        contaminants.least_columns(0.8)


# ---- scripts ------------------------------------------------------------------------------------------------------

def test_scripts(spark, tmp_path):
    d = str(tmp_path)
    (tmp_path / "k").mkdir()
    (tmp_path / "k" / "c1.fas").write_text(">i|A|B\nAC-GT\n>j|A|B|C d\nACGN\n")
    (tmp_path / "k" / "c2.fas").write_text(">k||B\nNNNN\n")
    say = lambda *words: command.main(spark, ["script", *words])
    assert say("concat_clusters", "-i", f"{d}/k", "-o", f"{d}/all") == [f"{d}/all"]
    assert lines_of(tmp_path / "all") == [">c1.fas|i|A|B", "AC-GT", ">c1.fas|j|A|B|C d", "ACGN", ">c2.fas|k||B", "NNNN"]
    say("degap_fasta", "-i", f"{d}/k", "-o", f"{d}/degapped")
    say("underscore_fasta", "-i", f"{d}/k", "-o", f"{d}/under")
    assert lines_of(tmp_path / "degapped")[1] == "ACGT" and lines_of(tmp_path / "under")[2] == ">j|A|B|C_d"
    say("filter_Ns", "-i", f"{d}/k", "-o", f"{d}/few", "-m", "1", "-d", f"{d}/many")
    assert (lines_of(tmp_path / "few")[::2], lines_of(tmp_path / "many")) == ([">i|A|B", ">j|A|B|C d"], [">k||B", "NNNN"])
    say("length_filter", "-i", f"{d}/k", "-o", f"{d}/long", "-l", "5", "-d", f"{d}/short")
    assert lines_of(tmp_path / "long") == [">i|A|B", "AC-GT"] and ">j|A|B|C d\tACGN\t4" in lines_of(tmp_path / "short")
    say("remove_lower_than_missing_taxon_info", "-i", f"{d}/k", "-o", f"{d}/cut", "-d", f"{d}/removed")
    assert lines_of(tmp_path / "removed") == [">k||B\t>k\tNNNN"] and len(lines_of(tmp_path / "cut")) == 4
    say("check_clusters", "-i", f"{d}/all", "-o", f"{d}/curated", "-p", f"{d}/info")
    assert sorted(lines_of(tmp_path / "curated")[::2])[:2] == [">i|A|B|C d", ">j|A|B|C d"]
    say("stop_codon_filter", "-i", f"{d}/k", "-o", f"{d}/stops", "-f", f"{d}/stops.tsv")
    assert len(lines_of(tmp_path / "stops")) == 6
    (tmp_path / "s.tsv").write_text("identifier\tgenus\tspecies\tremark\nI1\tGen\tGen a\tnot Gen\nI2\tOther\t\t\"Gen\n")
    say("replace_taxon_name_for_rank", "-i", f"{d}/s.tsv", "-o", f"{d}/t", "--genus_to_replace", "Gen", "--genus_to_use", "Nov")
    assert lines_of(tmp_path / "t") == ["identifier\tgenus\tspecies\tremark", "I1\tNov\tNov a\tnot Nov", "I2\tOther\t\t\"Gen"]
    rng = random.Random(9)
    a, b = ("".join(rng.choice("ACGT") for _ in range(120)) for _ in range(2))
    (tmp_path / "g.fas").write_text(f">x\n{a}\n>y\n{b}\n")
    (tmp_path / "db.fas").write_text(f">bad\n{a[:60]}A{a[61:]}\n")
    assert say("contaminants", "-i", f"{d}/g.fas", "-o", f"{d}/clean", "-b", f"{d}/db.fas", "-m", f"{d}/matched", "-r", f"{d}/report") == [f"{d}/clean", f"{d}/matched", f"{d}/report"]
    assert lines_of(tmp_path / "clean") == [">y", b] and lines_of(tmp_path / "matched") == [">x", a] and lines_of(tmp_path / "report")[-1].startswith(">x\tbad\t")
    for bad in ([], ["paint"], ["degap_fasta", "-i", "x"], ["replace_taxon_name_for_rank", "-i", f"{d}/s.tsv", "-o", f"{d}/u", "--genus_to_replace", "Gen"]):
        with pytest.raises(ValueError):
            say(*bad)
    assert set(scripts.SCRIPTS) >= {"check_clusters", "contaminants"}


def test_tables_on_the_way_are_removed(spark, sf, tmp_path):
    b, before = catalogue.backbone(spark, sf), scratch.held()
    (tmp_path / "b.tsv").write_text("processid\tkingdom\tgenus\tmarker_code\tnuc\nP1\tAnimalia\tGen1\tCOI-5P\tACGT\n")
    params = parsed(["-t", "Animalia", "classify", "--bold_release", f"{tmp_path}/b.tsv", "derep", "-l"])
    classify.run(spark, params, f"{tmp_path}/out", datetime(2022, 1, 1), b)
    assert scratch.held() == before
    walked = taxonomy.lineages(b)
    new = scratch.held() - before
    assert new and walked.count()
    assert scratch.clear(spark, before) == len(new) and scratch.held() == before
