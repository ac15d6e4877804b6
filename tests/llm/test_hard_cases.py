"""Null and repeated ids in numbers, equal rows, clashing columns, long lists, and brute force where SQL is no help."""

import hashlib
import math
import os
import random
import subprocess
import sys
import textwrap
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandforge.llm import common, decontamination, line_dedup, near_dedup, packing, quality_classifier, quality_rules, sampling, substring_dedup, toxicity, url_rules

from test_llm import corpus, frame, unlike

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def removed_words(docs):
    """Brute force of substring_dedup: docs in order; kept texts."""
    seen, out = set(), []
    for t in docs:
        w, gone = (t or "").encode().split(), set()
        for k in range(len(w) - 19):
            g = tuple(w[k:k + 20])
            if g in seen:
                gone |= set(range(k, k + 20))
            seen.add(g)
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


@pytest.fixture(scope="module")
def nulls():
    """2,000 rows without an id: texts of their own, some of them with a shared passage or a shared line."""
    own = unlike(21)
    passage, line = own(24), own(7)
    return [own(9) if i % 5 else f"{own(6)} {passage}" if i % 2 else f"{own(6)}\n{line}" for i in range(2_000)]


def test_many_null_ids_substrings(spark, nulls):
    rows = {r.kept_text: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(frame(spark, [(None, t) for t in nulls])).collect()}
    # which of them is the first is told by hashes; all others lose exactly the passage
    lost = [n for n in rows.values() if n[1]]
    with_passage = sum(len(t.split()) == 30 for t in nulls)
    assert lost == [(30, 24)] * (with_passage - 1)
    assert {t for t, n in rows.items() if not n[1] and len(t.split()) < 30} == {" ".join(t.split()) for t in nulls if len(t.split()) < 30}


def test_many_null_ids_lines(spark, nulls):
    rows = Counter((r.kept_text, r.n_removed) for r in line_dedup.line_dedup(frame(spark, [(None, t) for t in nulls])).collect())
    assert rows == Counter((t.split("\n")[0], int("\n" in t)) for t in nulls)


def test_many_null_ids_near_duplicates(spark, nulls):
    own = unlike(22)
    copy = own(60)
    rows = [(None, t) for t in nulls] + [(7, copy), (None, copy + " end"), (None, own(60)), (3, own(60))]
    got = near_dedup.near_dedup(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == Counter({(None, None, True): 2_001, (7, 7, True): 1, (None, 7, False): 1, (3, 3, True): 1})


def test_many_null_ids_pipeline(spark, nulls, tmp_path):
    import corpus_pipeline

    item, copy = unlike(23)(20), unlike(24)(40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(None, t) for t in nulls] + [(None, copy), (None, copy + " more"), (None, f"{unlike(41)(30)} {item}"), (4, f"{unlike(42)(30)} {item}")]
    docs, d = frame(spark, rows), str(tmp_path)
    plain = Counter(rows)
    # one kind of label: all are good
    assert Counter(map(tuple, corpus_pipeline.quality(spark, docs, d).select("doc_id", "text").collect())) == plain
    lined = corpus_pipeline.lines(spark, docs, d)
    assert sum(1 for _ in lined.collect()) == len(rows) and lined.where("n_chars <> length(text)").isEmpty()
    near = Counter(map(tuple, corpus_pipeline.near_duplicates(spark, docs, d).select("doc_id", "text").collect()))
    gone = plain - near
    assert not near - plain and len(gone) == 1 and next(iter(gone))[1].startswith(copy)
    clean = Counter(map(tuple, corpus_pipeline.decontaminate(spark, docs, d).select("doc_id", "text").collect()))
    assert plain - clean == Counter(rows[-2:]) and not clean - plain
    packed = corpus_pipeline.packing(spark, docs, d).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in packed) == Counter((i, len(t.split()) + 1) for i, t in rows)
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, d).isEmpty()


def test_repeated_ids_substrings(spark):
    own = unlike(25)
    passage = own(30)
    docs = [(5, f"{own(3)} {passage}"), (5, f"{own(4)} {passage}"), (5, f"{own(4)} {passage}")] + [(9, passage)] * 3
    got = sorted((r.doc_id, r.n_words - r.n_removed) for r in substring_dedup.substring_dedup(frame(spark, docs)).collect())
    # of the three texts of document 5 one keeps the passage; the equal rows of 9 are one document and lose it
    assert [k for i, k in got if i == 9] == [0, 0, 0] and sorted(k for i, k in got if i == 5)[-1] >= 33 and sum(k > 30 for i, k in got if i == 5) == 1


def test_repeat_levels(spark):
    docs = corpus(26, 80)
    words = {i: (t or "").split() for i, t in docs}
    want = {}
    for n in (20, 40, 80, 160):
        seen = Counter(tuple(w[k:k + n]) for w in words.values() for k in range(len(w) - n + 1))
        for i, w in words.items():
            if any(seen[tuple(w[k:k + n])] > 1 for k in range(len(w) - n + 1)):
                want[i] = n
    got = {r.doc_id: r.longest for r in substring_dedup.repeat_levels(frame(spark, docs)).collect()}
    assert got == want and len(set(want.values())) > 1


def test_near_duplicates_close_to_the_threshold(spark):
    rng = random.Random(27)
    base = [unlike(28)(1) + str(i) for i in range(120)]
    docs = []
    for i in range(260):
        x = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 3, 4])):
            x[rng.randrange(len(x))] = f"n{rng.randrange(40)}"
        docs.append((i, " ".join(x)))
    sets = [{tuple(t.split()[k:k + 5]) for k in range(116)} for _, t in docs]
    group = list(range(len(docs)))
    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(frame(spark, docs)).collect()}
    assert got == {i: root(i) for i in range(len(docs))}
    assert 3 < len(set(got.values())) < 200


def plain_lines(docs, least=5):
    """Removed lines where no line of one leaf is like another: those in `least` documents, short ones in twice that."""
    held = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            if x.split():
                held[tuple(x.split())].add(i)
    return {i: [k for k, x in enumerate((t or "").split("\n")) if x.split() and len(held[tuple(x.split())]) >= (least if len(x.split()) > 2 else 2 * least)] for i, t in docs}


def test_lines_against_brute_force(spark):
    rng, own = random.Random(29), unlike(30)
    pool = [own(rng.choice([1, 2, 3, 5, 9])) for _ in range(40)]
    docs = [(i, "\n".join([*rng.sample(pool, rng.choice([0, 1, 2])), *[own(12) for _ in range(6)], ""])) for i in range(150)] + [(150, None), (151, ""), (152, "\n \n")]
    got = {r.doc_id: r.removed_lines for r in line_dedup.line_dedup(frame(spark, docs)).collect()}
    want = plain_lines(docs)
    assert got == want and sum(map(len, want.values())) > 20


def test_lines_of_numbers_are_data(spark):
    own = unlike(31)
    docs = [(i, f"{i} {i * 7} {i * i} 4\n{own(20)}") for i in range(20)] + [(100 + i, f"0 0 0 0\n{own(20)}") for i in range(6)]
    got = {r.doc_id: r.removed_lines for r in line_dedup.line_dedup(frame(spark, docs)).collect()}
    assert got == {i: [0] if i >= 100 else [] for i, _ in docs}


def found(spark, text, item, sent):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    return [r.kind for r in decontamination.contaminated(docs, bench, most_sent=sent).collect()]


@pytest.mark.parametrize("sent", [10**6, 0])
def test_slots(spark, sent):
    item = "A parcel of 7 kg is sent over 5 km and arrives after 9 h at the house of Ada in the old town"
    own = unlike(32)(20)
    assert found(spark, f"{own} {item} {own}", item, sent) == ["verbatim"]
    assert found(spark, item.replace("7 kg", "3 g").replace("5 km", "11 m").replace("9 h", "2 min"), item, sent) == ["renamed"]
    assert found(spark, item.replace("km", "mi"), item, sent) == ["renamed"]
    assert found(spark, item.replace("7", "seven").replace("9", "twenty-two").replace("Ada", "Noor"), item, sent) == ["renamed"]
    first = "Ada buys 40 apples at the market and gives 12 of them away to friends before Ada goes home"
    assert found(spark, f"{own}. {first.replace('Ada', 'Noor').replace('40', '55')}", first, sent) == ["renamed"]
    assert found(spark, first.replace("before Ada", "before Noor"), first, sent) == []  # one name stands for two
    table = " ".join(str(7 * i) for i in range(30))
    assert found(spark, table, table, sent) == ["verbatim"]
    assert found(spark, " ".join(str(11 * i + 5) for i in range(300)), table, sent) == []


def test_kinds():
    kind = lambda w: decontamination.kind(w.encode())[0]
    assert all(kind(w) == decontamination.NUMBER for w in ("7", "-3.5,", "(12)", "$40", "5km", "40%", "Seven", "twenty-two", "1/2"))
    assert all(kind(w) == decontamination.UNIT for w in ("minutes", "Hours.", "mph"))
    assert all(kind(w) == decontamination.NAME for w in ("Paris", "Oslo.", "(Ada", "\u00c9mile"))
    assert [kind(w) for w in ("The", "NASA", "I", "m", "5th", "")] == [b"the", b"nasa", b"i", b"m", b"5th", b""]


def test_toxicity_gradient_and_scores(spark):
    rng = random.Random(33)
    texts = [" ".join(rng.choice(["plain", "words", "here", "idiot", "stuff"]) for _ in range(rng.choice([0, 1, 4, 5, 6, 30]))).encode() for _ in range(40)]
    labels = np.array([float(b"idiot" in x) for x in texts])
    m = toxicity.Model(texts, labels)
    known = {}
    split = [np.array([known.setdefault(toxicity.core(w), len(known)) for w in x.split()], np.int32) for x in texts]
    window = toxicity.spread(np.array([len(x) for x in split]))
    for i, own in enumerate(split):  # all runs of five words, and one shorter run where there are no five
        want = [own[k:k + 5].tolist() for k in range(max(1, len(own) - 4))]
        ids = np.concatenate(split)
        assert [ids[a:b].tolist() for a, b, d in zip(*window) if d == i] == want
    gram, of_word = toxicity.subwords(list(known))
    weight = 1.0 / np.bincount(of_word)[of_word]
    part = (gram, of_word, weight, np.concatenate(split), window)
    d = np.random.default_rng(1).normal(size=len(window[0]))
    grads = m._gradients(*part, d)
    for param, g in zip((m.e, m.u, m.b), grads):
        for at in np.argsort(-np.abs(g), axis=None)[:12]:
            at, ends = np.unravel_index(at, g.shape), []
            was = param[at]
            for step in (1e-5, -1e-5):
                param[at] = was + step
                ends.append(float(d @ m._windows(*part)))
            param[at] = was
            assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(g[at], rel=1e-4, abs=1e-7)
    # the score of a document, n-gram by n-gram
    numbers, bias, scale, shift, _ = m.sent()
    sent = spark.sparkContext.broadcast(m.sent())
    got = [r.score for r in frame(spark, list(enumerate(x.decode() for x in texts))).select("doc_id", "text").coalesce(1).mapInArrow(toxicity._score(sent, ["doc_id"]), "doc_id long, score double").orderBy("doc_id").collect()]
    for x, score in zip(texts, got):
        word = [float(np.mean(numbers[toxicity.subwords([toxicity.core(w)])[0]])) for w in x.split()]
        top = max(sum(word[k:k + 5]) / 5 for k in range(max(1, len(word) - 4)))
        assert score == pytest.approx(1 / (1 + math.exp(-(scale * (top + bias) + shift))))


def test_toxicity_sample_is_bounded(spark):
    docs = frame(spark, [(i, "x" * 100) for i in range(40)] + [(1, f"again {k}") for k in range(500)] + [(2, "y" * 5000)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    every = toxicity.learned_from(docs, labels, {0: 30, 1: 30})
    ids = [r[0] for r in every]
    assert len(set(ids)) == len(ids) <= 40 and all(sampling.fold(5) is not None for _ in ids)
    assert sampling.labelled_sample(docs, labels, "toxic", {0: 3, 1: 4}).count() == 7
    some = toxicity.learned_from(docs, labels, {0: 30, 1: 30}, most_one=200, most_all=1000)
    assert 0 < len(some) <= 11 and set(some) <= set(every) and sum(len(r[1]) for r in some) <= 1000


def test_quality_contexts_and_gradient():
    units = quality_classifier.Units(50)  # small, so that it is emptied on the way
    texts = [b"One two, two THREE 4 \"five\" one", b"", b"two two two", b" ".join(b"w%d" % i for i in range(200)) + b" one two"]
    ids = [units.of(x).tolist() for x in texts]
    fresh = [quality_classifier.Units().of(x).tolist() for x in texts]
    assert ids == fresh and ids[2].count(quality_classifier.AGAIN) == 2 and quality_classifier.SHOUT in ids[0] and quality_classifier.NUMBER in ids[0]
    places, signs = quality_classifier.index_vectors()
    want = np.zeros((quality_classifier.BUCKETS, quality_classifier.DIM), np.int64)
    for own in ids:
        for i, x in enumerate(own):
            for j in range(max(0, i - 2), min(len(own), i + 3)):
                if i != j:
                    want[x, places[own[j]]] += signs[own[j]]
    flat = np.concatenate([np.array([*x, -1, -1], np.int16) for x in ids])
    assert (quality_classifier.contexts(flat, places, signs).reshape(want.shape) == want).all()
    vectors = np.random.default_rng(2).normal(size=want.shape).astype(np.float32)
    own = vectors[ids[0]]
    got = quality_classifier.pooled(np.array(ids[0]), vectors)
    assert got[:64] == pytest.approx(4 * own.mean(0), abs=1e-4) and got[64:128] == pytest.approx(4 * own.std(0), abs=1e-3)
    rng = np.random.default_rng(3)
    p = [rng.normal(size=(6, 4)), rng.normal(size=4), rng.normal(size=4), rng.normal(size=1)]
    x, y = rng.normal(size=(9, 6)), rng.integers(0, 2, 9).astype(float)
    def loss():
        z = quality_classifier.margin(p, x)
        return np.logaddexp(0, np.where(y == 1, -z, z)).mean() + 0.5e-4 * ((p[0] ** 2).sum() + (p[2] ** 2).sum())
    for param, g in zip(p, quality_classifier.gradient(p, x, y)):
        for at in np.ndindex(param.shape):
            was, ends = param[at], []
            for step in (1e-6, -1e-6):
                param[at] = was + step
                ends.append(loss())
            param[at] = was
            assert (ends[0] - ends[1]) / 2e-6 == pytest.approx(g[at], rel=1e-3, abs=1e-7)


def test_quality_held_out_accuracy(spark):
    rng = random.Random(34)
    good, bad = [f"g{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(40))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    held = [r for r in quality_classifier.quality_scores(frame(spark, docs), labels).collect() if r.held_out]
    assert len(held) > 50 and np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95


def test_binomial_beyond_the_first_terms(spark):
    rows = [(9_000, 1_000_000), (9_900, 1_000_000), (12_000, 1_000_000), (21_500, 2_200_000), (30, 100), (10_001, 1_100_000), (5_990_000, 600_000_000), (10_000, 1_010_000)]
    got = [r.p for r in spark.createDataFrame(rows, "k long, n long").select(quality_rules.binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("p")).collect()]

    def exact(k, n, p=0.01):
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p) for i in range(max(0, k - 40_000), k + 1)]
        return math.fsum(map(math.exp, logs))

    for i in (0, 1, 3, 5, 6, 7):
        assert got[i] == pytest.approx(exact(*rows[i]), rel=1e-4 if rows[i][1] < 10**8 else 1e-2), rows[i]
    assert got[2] == 1 and got[4] == 1


def test_large_ids_near_duplicates(spark):
    own = unlike(61)
    a, b = own(30), own(30)
    rows = [(2**62 + 9, a), (2**62 + 5, a), (2**63 - 1, b), (-(2**62), own(20)), (None, b), (None, own(25))]
    for given in (rows, rows[:4]):
        got = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_dedup(frame(spark, given)).collect() if r.doc_id is not None}
        assert got == {(2**62 + 9, 2**62 + 5, False), (2**62 + 5, 2**62 + 5, True), (2**63 - 1, 2**63 - 1, True), (-(2**62), -(2**62), True)}
    loose = {(r.component_id, r.kept) for r in near_dedup.near_dedup(frame(spark, rows)).collect() if r.doc_id is None}
    assert loose == {(2**63 - 1, False), (None, True)}
    with pytest.raises(ValueError):
        near_dedup.near_dedup(frame(spark, [(-(2**63), a), (2**63 - 1, b), (None, a)]))
    whole = near_dedup.near_dedup(frame(spark, [(-(2**63), a), (2**63 - 1, a)])).collect()
    assert {r.component_id for r in whole} == {-(2**63)}


def test_runs_of_punctuation():
    began = time.time()
    words = [b"." * 500_000, b"...", b"a..", b"..b", b"(c)", b"-", *[b"word"] * 50_000]
    told = decontamination.Told([b" ".join(words)])
    assert time.time() - began < 2
    data = told.whole[0].tobytes()
    assert [data[a:b] for a, b in zip(told.first[:6].tolist(), told.last[:6].tolist())] == [b"", b"", b"a", b"b", b"c", b"-"]


def test_shared_openings_by_join(spark):
    """Many documents and items that share an opening and nothing else; the sent and the joined way agree."""
    own = unlike(62)
    opening = own(12)
    items = [(i, f"{opening} {own(40)}") for i in range(120)]
    docs = [(i, f"{own(5)} {opening} {own(30)}") for i in range(120)] + [(900 + i, f"{own(4)} {items[i][1]} {own(4)}") for i in range(5)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    began = time.time()
    joined = sorted(map(tuple, decontamination.contaminated(frame(spark, docs), benchmark, most_sent=0).collect()))
    assert time.time() - began < 60
    assert joined == sorted(map(tuple, decontamination.contaminated(frame(spark, docs), benchmark).collect()))
    assert {(d, i) for d, i, *_ in joined} == {(900 + i, i) for i in range(5)}


def test_words_of_many_bytes():
    """What is kept between texts is bounded in bytes: long words are not remembered, or with them all is dropped."""
    seen: dict = {}
    decontamination.Told([b" ".join(b"9" * 10_000 + str(i).encode() for i in range(50))], seen)
    assert sum(map(len, seen)) == 0
    units = quality_classifier.Units()
    most = 0
    for i in range(700):
        units.of(b" ".join(b"%d-" % k + b"x" * 10_000 for k in range(20 * i, 20 * i + 20)))
        most = max(most, len(units))
    assert most <= (64 << 20) // 10_000 + 20


def test_long_runs_inside_words():
    """Words of a million marks between letters or digits are read once, not once a place."""
    began = time.time()
    for mark in b".", b"/", b":", b"-", "\u00b7".encode():
        long = [b"a" + mark * 1_000_000 + b"a", b"1" + mark * 1_000_000 + b"=a", mark * 500_000 + b"7" + mark * 500_000]
        for word in long:
            quality_classifier.Units().of(word)
            decontamination.Told([word], {})
    assert time.time() - began < 60
    assert decontamination.kind(b"1" + b"/" * 5_000 + b"=a")[0] != decontamination.NUMBER
    assert decontamination.kind(b"(+1" + b"." * 5_000 + b"km)")[0] == decontamination.NUMBER


def test_units_beyond_ascii():
    """Case and outer punctuation are told apart in any script."""
    units = quality_classifier.Units()
    plain = units.of("\u00e9t\u00e9".encode()).tolist()
    assert len(plain) == 1 and units.of("\u00c9t\u00e9".encode()).tolist() == plain
    assert plain[0] in units.of("\u00ab\u00c9T\u00c9\u00bb".encode()).tolist() and quality_classifier.SHOUT in units.of("\u00c9T\u00c9".encode()).tolist()
    assert len(units.of("\u00ab\u00e9t\u00e9\u00bb,".encode())) == 3


def test_risk_of_all_rules_together(spark, monkeypatch):
    rng = random.Random(35)
    def text(i):
        words = [rng.choice("abcdefgh") * 4 + str(rng.randrange(999)) for _ in range(40)]
        if i % 50 == 0:
            words += ["###"] * 9
        if i % 47 == 1:
            words = [w.upper() for w in words]
        return " ".join(words)
    docs = frame(spark, [(i, text(i)) for i in range(2_000)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2_000)], "doc_id long, quality int, toxic int")
    rows = sorted(map(tuple, quality_rules.quality_rules(docs, labels).collect()))
    lost = sum(not r[-1] for r in rows) / len(rows)
    assert lost <= quality_rules.RISK
    monkeypatch.setattr(quality_rules, "SENT_STRATA", 0)
    assert sorted(map(tuple, quality_rules.quality_rules(docs, labels).collect())) == rows


def test_long_rule_lists(spark):
    rng = random.Random(36)
    labels = ["a", "b", "com", "x1", "org"]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(n))
    path = lambda: "/" + "/".join(rng.choice(["p", "q", "pq"]) for _ in range(rng.randrange(4)))
    rules = [(host(rng.randrange(1, 4)), path(), rng.choice(["allow", "block"])) for _ in range(150)] + [("", "/p/p", "block"), ("", "", "allow")]
    urls = [f"http://{host(rng.randrange(1, 5)).upper()}{path()}{rng.choice(['', '?q', '#f'])}" for _ in range(400)] + [None, "", "no", "http://", "x://a..com/p", "http://a.com/" + "p" * 5000, "ftp://.com/"]
    urls += [urls[0]] * 300
    pages = spark.createDataFrame([(i, u, "h", "r", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, `a.b` int")
    first = {}
    for h, p, v in rules:
        first.setdefault((h, p), v)
    want = []
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        h, tail = rest[:cut].lower(), rest[cut:]
        p = tail[: min([k for k in (tail.find(c) for c in "?#") if k >= 0], default=len(tail))]
        fits = [(-len(x + y), -len(x), x + y, v) for (x, y), v in first.items() if (not x or h == x or h.endswith("." + x)) and p.startswith(y)]
        want.append((i, h, p, min(fits)[2] if fits else None, min(fits)[3] if fits else "allow"))
    for most in (10**6, 0):
        assert sorted(map(tuple, url_rules.url_rules(pages, rules, most_swept=most).collect())) == want
    assert sorted(map(tuple, url_rules.url_rules(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect())) == want
    assert len(url_rules.swept([(f"h{i}.com", "/", "block") for i in range(20_000)], 10**6)) == 40_000
    assert url_rules.swept(rules, 10) is None


def test_packing_equal_rows_and_batches(spark):
    docs = frame(spark, [(1, "a b c")] * 700 + [(None, None)] * 300 + [(i, "x " * (i % 37)) for i in range(500)])
    rows = packing.pack(docs, buckets=5, budget=64, group=100).collect()
    assert len(rows) == 1500
    per = defaultdict(list)
    for r in rows:
        per[r.batch_id].append(r)
    ends = sorted({r.bucket_length for r in rows})
    lengths = Counter(r.n_tokens for r in rows)
    assert ends == packing.boundaries(sorted(lengths), [lengths[x] for x in sorted(lengths)], 5)
    for own in per.values():
        size = max(1, 64 // own[0].bucket_length)
        assert len({r.bucket for r in own}) == 1 and sorted(r.slot for r in own) == list(range(len(own))) and len(own) <= size
        assert all(r.n_padding == r.bucket_length - r.n_tokens >= 0 and r.bucket_length == min(e for e in ends if e >= r.n_tokens) for r in own)
    # equal rows share no sub-group of more than twice its size; a sub-group ends with one partial batch at most
    groups = Counter((r.bucket, r.batch_id.split("-")[1]) for r in rows)
    assert max(groups.values()) < 250
    partial = Counter((own[0].bucket, own[0].batch_id.split("-")[1]) for own in per.values() if len(own) < max(1, 64 // own[0].bucket_length))
    assert max(partial.values()) == 1


def test_boundaries_by_plain_dynamic_programming():
    rng = random.Random(37)
    lengths = sorted(rng.sample(range(1, 100_000), 60))
    counts = [rng.randrange(1, 50) for _ in lengths]
    cost = lambda i, j: sum((lengths[j] - lengths[k]) * counts[k] for k in range(i, j + 1))
    best = {(0, 1): cost(0, 0)}
    for k in range(1, 9):
        for j in range(len(lengths)):
            best[j, k] = min([cost(0, j)] + [best[i - 1, k - 1] + cost(i, j) for i in range(1, j + 1)] if k > 1 else [cost(0, j)])
        ends = packing.boundaries(lengths, counts, k)
        assert sum((min(e for e in ends if e >= x) - x) * c for x, c in zip(lengths, counts)) == best[len(lengths) - 1, k] and len(ends) <= k


def test_clashing_columns(spark):
    names = "doc_id long, text string, lang string, `a.b` string, `c``d` string, score double, _k long, label int, row long, h long, bucket int, n_words string, found string"
    docs = spark.createDataFrame([(i, f"some words {i} of a text", "en", "1", "2", 0.1, 1, 1, 1, 1, 1, "x", "y") for i in range(8)], names)
    labels = spark.createDataFrame([(i, i % 2, i % 2, 9) for i in range(8)], "doc_id long, quality int, toxic int, score int")
    bench = spark.createDataFrame([(1, "nothing like it at all in here", 3)], "item_id long, text string, doc_id int")
    from strandforge.llm import language_model

    for f, extra in (
        (lambda: toxicity.toxicity_scores(docs, labels), True), (lambda: quality_classifier.quality_scores(docs, labels), True), (lambda: line_dedup.line_dedup(docs), True),
        (lambda: substring_dedup.substring_dedup(docs), False), (lambda: near_dedup.near_dedup(docs), False), (lambda: packing.pack(docs), False),
        (lambda: quality_rules.quality_rules(docs, labels), False), (lambda: language_model.lm_scores(docs), False),
    ):
        out = f()
        rows = out.collect()
        assert len(rows) == 8 and {r.doc_id for r in rows} == set(range(8))
        if extra:
            assert all(r["a.b"] == "1" and r["c`d"] == "2" for r in rows)
    assert decontamination.contaminated(docs, bench).isEmpty()


def test_executors_without_the_package(tmp_path):
    code = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
        def there(rows):
            try:
                import strandforge
                yield from [1 for _ in rows]
            except ImportError:
                yield from [0 for _ in rows]
        assert sum(spark.sparkContext.parallelize(range(2)).mapPartitions(there).collect()) == 0, "executors have the package"
        from strandforge.llm import decontamination, language_model, line_dedup, near_dedup, quality_classifier, substring_dedup, toxicity
        item = "a train leaves Paris with 40 people and comes back after 3 hours with 40 others"
        docs = spark.createDataFrame([(i, f"some words {{i}} of a text " * 9 + (item if i == 3 else "")) for i in range(40)], "doc_id long, text string")
        labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
        bench = spark.createDataFrame([(1, item)], "item_id long, text string")
        for most in (10**6, 0):
            assert decontamination.contaminated(docs, bench, most_sent=most).count() == 1
        for f in (language_model.lm_scores, substring_dedup.substring_dedup, near_dedup.near_dedup, line_dedup.line_dedup):
            assert f(docs).count() == len(f(docs).collect()) == 40
        for f in (quality_classifier.quality_scores, toxicity.toxicity_scores):
            assert len(f(docs, labels).collect()) == 40
        print("fine")
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert done.stdout.strip().endswith("fine"), done.stdout[-1000:] + done.stderr[-3000:]


def test_stored_tables_can_be_cleared(spark):
    common.clear(spark)
    docs = frame(spark, corpus(40, 20))
    rows = near_dedup.near_dedup(docs).collect()
    left = set(common.held())
    assert rows and left and all(os.path.isdir(p.removeprefix("file:")) for p in left) and len(left) <= 4
    assert common.clear(spark) == len(left) and not any(os.path.isdir(p.removeprefix("file:")) for p in left)
