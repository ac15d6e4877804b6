"""Operators and pipeline stages against plain matchers of their own, and recall where a method may miss something."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandforge.llm import decontamination, line_dedup

from test_llm import frame, unlike

# ---- decontamination: words of one alphabet, numbers and names, compared as lists of strings ------------------------


def template(word):
    """Number, name or lower-case word, as text; punctuation around it does not count."""
    core = word.strip(".,;:!?()[]{}\"'`")
    if re.fullmatch(r"\d+", core):
        return "<number>"
    if re.fullmatch(r"[A-Z][a-z]+", core):
        return "<name>"
    return core.lower()


def told(words, at, size):
    """A window as it is compared: by templates, or as it is where fewer than three words are plain."""
    own = [template(w) for w in words[at:at + size]]
    if sum(not t.startswith("<") for t in own) < 3:
        return tuple(["exact", *[w.strip(".,;:!?()[]{}\"'`").lower() for w in words[at:at + size]]])
    return tuple(own)


def matched(text, item):
    """verbatim, renamed or None, of a document that holds the item, or a part of it, in one piece."""
    words, own = text.split(), item.split()
    size = min(8, len(own))
    count = len(own) - size + 1
    best = None
    for offset in range(-len(own), len(words) + 1):
        at = [a for a in range(count) if 0 <= a + offset <= len(words) - size and told(own, a, size) == told(words, a + offset, size)]
        if len(at) < min(2, 0.5 * count):
            continue
        covered = {p for a in at for p in range(a, a + size)}
        slots = [p for p in sorted(covered) if template(own[p]).startswith("<")]
        pairs = [(own[p].strip(".,;"), words[p + offset].strip(".,;")) for p in slots]
        if len({a for a, _ in pairs}) != len(set(pairs)) or len({b for _, b in pairs}) != len(set(pairs)):
            continue  # a filler that stands for two, or two for one
        kind = "verbatim" if all(a == b for a, b in pairs) else "renamed"
        runs = max(len(r) for r in "".join("x" if a in at else " " for a in range(count)).split(" "))
        if len(at) >= 0.5 * count or len(at) > 1 and len(covered) >= 0.8 * len(own) or runs >= 6 and kind == "verbatim":
            best = kind if best is None or kind == "verbatim" else best
    return best


def test_decontamination_against_a_plain_matcher(spark):
    rng = random.Random(12)
    plain = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    name = lambda: plain().capitalize()

    def word():
        r = rng.random()
        return str(rng.randrange(2, 900)) if r < 0.12 else name() if r < 0.25 else plain() + rng.choice(["", "", ",", "."])

    items = [[word() for _ in range(rng.choice([3, 7, 9, 20, 45]))] for _ in range(30)]
    docs = []
    for _ in range(260):
        own = rng.choice(items)
        a = rng.choice([0, 0, rng.randrange(len(own))])
        part = own[a:a + rng.choice([len(own), rng.randrange(1, len(own) + 1)])]
        how, fillers = rng.random(), {}
        if how < 0.4:  # renamed throughout
            part = [fillers.setdefault(w, name() if template(w) == "<name>" else str(rng.randrange(1_000, 9_999))) if template(w).startswith("<") else w for w in part]
        elif how < 0.6:  # each filler anew
            part = [(name() if template(w) == "<name>" else str(rng.randrange(1_000, 9_999))) if template(w).startswith("<") else w for w in part]
        elif how < 0.7:
            part = [plain() if rng.random() < 0.1 else w for w in part]
        docs.append(" ".join([*[plain() for _ in range(rng.randrange(12))], *part, *[plain() for _ in range(rng.randrange(12))]]))
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    want = {(d, i): k for d, text in enumerate(docs) for i, x in enumerate(items) if (k := matched(text, " ".join(x)))}
    for sent in (10**6, 0):
        got = {(r.doc_id, r.item_id): r.kind for r in decontamination.contaminated(frame(spark, list(enumerate(docs))), benchmark, most_sent=sent).collect()}
        assert got == want
    assert 60 < len(want) < 250 and len(set(want.values())) == 2


# ---- line dedup: recall of templates --------------------------------------------------------------------------------

@pytest.mark.parametrize(("templates", "length", "fixed", "copies"), [(150, 20, 0.7, 8), (8, 60, 0.62, 60), (40, 9, 0.7, 12)])
def test_recall_of_line_templates(spark, templates, length, fixed, copies):
    """Lines of many templates in one leaf, which share their first words and differ in others, each copy with fillers of
    its own: all recur, so all go; lines of their own stay."""
    rng = random.Random(templates)
    new = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(8))
    def shape():
        held = set(rng.sample(range(3, length), math.ceil(fixed * length) - 3))
        return ["alpha", "beta", "gamma", *[new() if i in held else None for i in range(3, length)]]

    shapes = [shape() for _ in range(templates)]
    lines = [" ".join(w or new() for w in s) for s in shapes for _ in range(copies)]
    rng.shuffle(lines)
    own = unlike(templates)
    docs = [(i, f"{own(12)}\n{line}\n{own(9)}") for i, line in enumerate(lines)]
    rows = line_dedup.line_dedup(frame(spark, docs)).collect()
    removed = sum(r.n_removed for r in rows)
    assert removed >= 0.99 * len(lines), removed / len(lines)
    texts = dict(docs)
    assert all({texts[r.doc_id].split("\n")[k] for k in (0, 2)} <= set(r.kept_text.split("\n")) for r in rows)


# ---- stages of the pipeline -----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with labels and a benchmark of a few rows each."""
    d = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(3)
    own = unlike(70)
    good = {i: own(40) for i in range(400)}
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in good], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    item = own(30)
    spark.createDataFrame([(1, item), (None, own(25)), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    bad = lambda: " ".join(rng.choice(["###", "!!!", "$$$", "%%%"]) for _ in range(30))
    return d, [(i, t if i % 4 else bad()) for i, t in good.items()], item


def clashing(docs):
    """Extra columns with the names that operators use inside."""
    names = ["_k", "_t", "_u", "_id", "_h", "id", "n", "group", "kept", "kept_text", "n_tokens", "bucket", "predicted", "score", "label", "a.b"]
    return docs.withColumns({c: F.lit(1) for c in names})


@pytest.mark.parametrize("number", range(5))
def test_stages_on_awkward_tables(spark, tables, number):
    sf_dir, docs, item = tables
    stage = corpus_pipeline.STAGES[number][1]
    assert stage(spark, frame(spark, []), sf_dir).count() == 0
    own = unlike(71)
    long = own(60_000)
    odd = [(None, own(20)), (None, own(20)), (901, None), (902, ""), (903, " \n\t "), (904, long), (905, "." * 300_000), (906, "x" * 200_000), (907, own(30)), (907, own(30)), (908, own(30)), (908, own(31))]
    twice = [(909, text := own(25)), (909, text), (910, text)]
    rows = docs + odd + twice + [(920, f"{own(5)} {item} {own(5)}")]
    given = clashing(frame(spark, rows))
    out = stage(spark, given, sf_dir)
    got = out.collect()
    if number < 4:
        assert out.columns == corpus_pipeline.COLUMNS
    texts = {(r.doc_id, r.text) for r in got} if number < 4 else set()
    if number == 0:  # junk goes, documents of words stay, each row for itself
        assert {i for i, t in docs if i % 4} <= {r.doc_id for r in got} and not {i for i, t in docs if i % 4 == 0} & {r.doc_id for r in got}
        assert sum(r.doc_id == 909 for r in got) == 2 and (904, long) in texts
    elif number == 1:  # every row stays
        assert len(got) == len(rows) and (904, long) in texts and all((r.n_chars is None) == (r.text is None) and (r.text is None or r.n_chars == len(r.text)) for r in got)
    elif number == 2:  # one of the copies
        assert sum(r.text == text for r in got) == 1 and {r.doc_id for r in got if r.text == text} == {909}
        assert {901, 902, 903, 904, 905, 906} <= {r.doc_id for r in got} and sum(r.doc_id == 908 for r in got) == 2 and sum(r.doc_id is None for r in got) == 2
    elif number == 3:  # the document with the item goes, and no other
        assert {r.doc_id for r in got} == {i for i, _ in rows} - {920} and len(got) == len(rows) - 1
    else:
        assert len(got) == len(rows) and {r.n_tokens for r in got if r.doc_id in (901, 902, 903)} == {1} and {r.n_tokens for r in got if r.doc_id == 904} == {60_001}
