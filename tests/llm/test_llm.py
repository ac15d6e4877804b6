"""The training-data operators against brute force, and on awkward tables."""

import hashlib
import math
import tracemalloc
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from strandforge.llm import decontamination, language_model, line_dedup, near_dedup, packing, quality_classifier, quality_rules, substring_dedup, toxicity, url_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, found string, n_words string"


def frame(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), 0.5, "x", "y") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 12, 40, 120]))] for _ in range(n // 2)]
    out = list(base)
    while len(out) < n:
        x = list(rng.choice(base))
        if rng.random() < 0.6 and len(x) > 30:
            x[rng.randrange(len(x))] = "changed"
        out.append(x + ([rng.choice(words)] if rng.random() < 0.3 else []))
    return [(i, " ".join(x)) for i, x in enumerate(out)] + [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "Only FOUR words here")]


AWKWARD = [(None, "a b c d e f g h i j k l"), (1, None), (2, ""), (3, "  \n \t"), (4, "x " * 30_000), (5, "same line here\nsame line here"), (5, "same line here\nsame line here"), (6, "y"), (6, "z")]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")


def test_substring_dedup(spark):
    docs = corpus()
    want, seen = {}, set()
    for i, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            g = tuple(w[k:k + 20])
            if g in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(g)
        want[i] = (len(w), sum(gone), b" ".join(x for x, y in zip(w, gone) if not y).decode())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(frame(spark, docs)).collect()}
    assert got == want
    levels = {r.doc_id: r.longest for r in substring_dedup.repeat_levels(frame(spark, docs)).collect()}
    assert set(levels) and all(x in (20, 40, 80) for x in levels.values())


def test_near_dedup(spark):
    docs = corpus(2, 80)
    sets = {}
    for i, t in docs:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = {k: min(a, b) if g in (a, b) else g for k, g in group.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(frame(spark, docs)).collect()}
    assert got == {i: (len(sets[i]), group[i], group[i] == i) for i in sets}


def test_superminhash_estimates():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = near_dedup.superminhash(x[:250]), near_dedup.superminhash(x[50:])
        errors.append((a == b).mean() - 200 / 300)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07
    few = near_dedup.superminhash(x[:3])
    assert (few < 2**32 - 1).all()


def unlike(seed):
    """Texts of n words that nothing else holds."""
    rng = random.Random(seed)
    return lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(n))


def test_decontamination(spark):
    filler = " ".join(f"f{i}" for i in range(30))
    item = "A train leaves Paris with 40 passengers and arrives after 3 hours where 40 people board the next bus"
    renamed = item.replace("Paris", "Oslo").replace("40", "75")
    broken = item.replace("40", "75", 1)
    docs = frame(spark, [(1, f"{filler}. {item} {filler}"), (2, f"{filler}. {renamed}"), (3, f"{filler}. {broken}"), (4, filler), *AWKWARD])
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    for sent in (10**6, 0):
        got = {(r.doc_id, r.item_id): r.kind for r in decontamination.contaminated(docs, bench, most_sent=sent).collect()}
        assert got == {(1, 7): "verbatim", (2, 7): "renamed"}
    assert decontamination.contaminated(docs, bench.limit(0)).isEmpty()


def test_decontamination_paths_agree(spark):
    own = unlike(11)
    item, other, extra = own(20), own(24), own(9)
    half = f"{own(9)} {' '.join(item.split()[:10])} {own(9)}"  # 3 of 13 windows: too few, in however many equal rows
    docs = frame(spark, [(1, item), (1, item), (1, other), (None, f"{item} {extra}"), (None, other), (2, half), (2, half), (3, "four words in here"), *AWKWARD])
    bench = spark.createDataFrame([(7, item), (7, item), (None, item), (None, other), (8, item), (9, "four words in here"), (10, None), (11, " ")], "item_id long, text string")
    sent, joined = (sorted(map(str, decontamination.contaminated(docs, bench, most_sent=n).collect())) for n in (10**6, 0))
    assert sent == joined and len(sent) == 3 * 4 + 2 + 1
    assert not any("share=2" in x for x in joined)


def test_decontamination_shifted_and_partial(spark):
    own = unlike(9)
    words = own(59).split()
    words[5], words[50] = "Paris", "40"
    item, short = " ".join(words), " ".join(words[:23])
    moved = lambda x: " ".join([*x[:len(x) // 2], "added", *x[len(x) // 2:]])
    docs = frame(spark, [
        (1, moved(words)), (2, moved(words[:23])), (3, f"{own(9)} {' '.join(words[10:30])} {own(9)}"), (4, " ".join(words[:36]) + f" {own(14)} 77 {own(8)}"),
        (5, f"{own(9)} {' '.join(words[10:19])} {own(9)}"), (6, moved(words).replace("Paris", "Oslo")), (7, moved(words[:19])),
    ])
    bench = spark.createDataFrame([(1, item), (2, short), (3, " ".join(words[:19]))], "item_id long, text string")
    for sent in (10**6, 0):
        got = {(r.doc_id, r.item_id): r.kind for r in decontamination.contaminated(docs, bench, most_sent=sent).collect()}
        assert all(got[i, i] == "verbatim" for i in (1, 2)) and got[3, 1] == got[4, 1] == got[7, 3] == "verbatim" and got[6, 1] == "renamed"
        assert not any(i == 5 for i, _ in got)


def test_line_dedup(spark):
    rng = random.Random(3)
    body = lambda: "\n".join(" ".join(f"{rng.random():.9f}".replace("0.", "q").translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(9)) for _ in range(4))
    docs = [(i, f"Posted on 2024-01-{i:02d} by user{i} with {i} likes\n{body()}\nAll rights are reserved") for i in range(12)]
    rows = line_dedup.line_dedup(frame(spark, docs)).collect()
    assert all(r.removed_lines == [0, 5] and r.lang == "en" for r in rows)
    assert {r.kept_text for r in rows} == {"\n".join(t.split("\n")[1:5]) for _, t in docs}


def test_line_dedup_copies_and_short_lines(spark):
    own = unlike(4)
    notice, whole = own(20), [own(9) for _ in range(15)]
    docs = [(i, f"{notice}\n{own(10)}") for i in range(6)]  # two thirds boilerplate, and no copies
    docs += [(10 + i, "\n".join(whole)) for i in range(6)]  # copies
    edited = [own(9) for _ in range(15)]
    docs += [(20 + i, "\n".join(x if k != i else own(9) for k, x in enumerate(edited))) for i in range(8)]  # near copies
    docs += [(30 + i, f"Share this\n{own(10)}") for i in range(12)]
    docs += [(50 + i, f"{i}\n{own(10)}") for i in range(12)]
    got = {r.doc_id: r.removed_lines for r in line_dedup.line_dedup(frame(spark, docs)).collect()}
    assert got == {i: [0] if i < 10 or 30 <= i < 50 else [] for i, _ in docs}


def test_line_dedup_several_templates(spark):
    own = unlike(6)
    one, two = own(6), own(6)
    heads = [f"please read the {one} {own(3)}" for _ in range(5)] + [f"please read the {two} {own(3)}" for _ in range(10)]
    heads += [f"please read the {own(9)}" for _ in range(30)] + [f"please read the {own(n)}" for n in (1, 2) for _ in range(8)]
    docs = [(i, f"{x}\n{own(40)}") for i, x in enumerate(heads)]
    got = {r.doc_id: r.removed_lines for r in line_dedup.line_dedup(frame(spark, docs)).collect()}
    assert got == {i: [0] if i < 15 else [] for i, _ in docs}


def test_quality_rules_thresholds(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0, 10), (2, 150), (2, 100), (5, 5)], "k long, n long").select(quality_rules.binomial_cdf(F.col("k"), F.col("n"), 0.02).alias("p"))
    # at k = n * p and above the value is 1: no such cutoff is safe
    want = [0.98**10, sum(math.comb(150, i) * 0.02**i * 0.98 ** (150 - i) for i in range(3)), 1.0, 1.0]
    assert [r.p for r in df.collect()] == pytest.approx(want)
    texts = [(1, "a b c d e " * 2), (2, "one two three four five six seven eight nine ten"), (3, None), (4, "x\nx\n\nx")]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.quality_rules(frame(spark, texts), spark.createDataFrame([], "doc_id long, quality int")).collect()}
    assert got == {1: (10, 10, 0, 10, True), 2: (10, 39, 0, 0, False), 3: (0, 0, 0, 0, True), 4: (3, 3, 2, 0, True)}


def test_url_rules(spark):
    pages = spark.createDataFrame([(1, "http://WWW.Example.org/es/a?x"), (2, "https://example.org"), (3, None), (4, "nothing"), (5, "http://a.com/de/1#f"), (6, "http://notexample.org/es/"), (7, "http://example.org/en/12"), (8, "http://x.net/"), (8, "http://x.net/")], "page_id long, url string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.url_rules(pages).collect())
    assert got[:2] == [(1, "www.example.org", "/es/a", "example.org/es/", "block"), (2, "example.org", "", None, "allow")]
    assert [x[3] for x in got[2:]] == [None, None, "com/de/", "org/", "example.org/en/1", None, None]
    assert url_rules.url_rules(pages, []).where("rule is not null").isEmpty()


def test_packing(spark):
    rng = random.Random(5)
    lengths, counts = zip(*sorted({rng.randrange(1, 200): rng.randrange(1, 9) for _ in range(14)}.items()))
    cost = lambda ends: sum((min(e for e in ends if e >= x) - x) * n for x, n in zip(lengths, counts))
    from itertools import combinations

    for k in (1, 2, 4):
        assert cost(packing.boundaries(list(lengths), list(counts), k)) == min(cost([*c, lengths[-1]]) for c in combinations(lengths[:-1], k - 1))
    rows = packing.pack(frame(spark, corpus() + AWKWARD), buckets=4, budget=300).collect()
    assert len(rows) == len(corpus() + AWKWARD)
    for batch in Counter(r.batch_id for r in rows):
        own = [r for r in rows if r.batch_id == batch]
        assert len(own) == 1 or len(own) * own[0].bucket_length <= 300
        assert len({r.slot for r in own}) == len(own) and all(r.n_padding >= 0 for r in own)


def test_language_model(spark):
    docs = corpus(4)
    got = {r.doc_id: r for r in language_model.lm_scores(frame(spark, docs), sent_counts=50).collect()}
    c = Counter()
    for i, t in docs:
        if crc32(str(i).encode()) % 10:
            c.update([*(t or "").lower().split(), ""])
    n, v = sum(c.values()), len(c)
    for i, t in docs:
        w = [*(t or "").lower().split(), ""]
        assert got[i].base_score == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert math.isfinite(got[i].score) and got[i].score < 0


def test_language_model_learns_from_all_once(spark, monkeypatch):
    docs = frame(spark, corpus(4))
    got, seen = [], []
    real = language_model.parts
    def parts(own, proportions):
        out = real(own, proportions)
        seen.append((sorted(r.row for r in own.collect()), sorted(r.row for x in out for r in x.collect())))
        return out
    monkeypatch.setattr(language_model, "parts", parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (3, 7):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got.append({r.doc_id: r.score for r in language_model.lm_scores(docs).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == pytest.approx(got[1], rel=1e-6)
    assert all(whole == dealt and len(whole) == sum(crc32(str(i).encode()) % 10 > 0 for i, _ in corpus(4)) for whole, dealt in seen)


def lm_weights():
    top = [(b"", 5)] + [(b"a%d" % i, 9) for i in range(40)]
    return {k: a.astype(np.float64) for k, a in language_model.fresh(top, np.linspace(1, 4, language_model.RARE)).items()}


def plain_log_probabilities(p, ids):
    """One document, token by token, without any of the module's functions; the distribution after each token too."""
    h, at, out, n = np.zeros(language_model.HIDDEN), 0, [], language_model.HIDDEN
    for y in ids:
        x = p["x"][at]
        z, r = (1 / (1 + np.exp(-(x[k * n: k * n + n] + h @ p["u"][:, k * n: k * n + n]))) for k in (0, 1))
        c = np.tanh(x[2 * n:] + (r * h) @ p["u"][:, 2 * n:])
        h = z * h + (1 - z) * c
        classes = np.exp(h @ p["wc"] + p["bc"])
        classes /= classes.sum()
        every = []
        for k in range(language_model.CLASSES):
            inside = np.exp(h @ p["ww"][k] + p["bw"][k])
            every += (classes[k] * inside / inside.sum()).tolist()
        every += classes[language_model.CLASSES:].tolist()
        out.append(every)
        at = y
    return sum(math.log(row[y]) for row, y in zip(out, ids)), out


def test_language_model_scores_are_log_probabilities():
    p = lm_weights()
    rng = np.random.default_rng(1)
    docs = [[*rng.integers(0, language_model.TOP + language_model.RARE, n).tolist(), 0] for n in (70, 0, 3, 33, 32, 31, 3)]
    got = language_model.log_probabilities(p, np.array(sum(docs, []), np.uint16), np.array([len(x) for x in docs]), 0)
    for ids, x in zip(docs, got):
        want, every = plain_log_probabilities(p, ids)
        assert x == pytest.approx(want, rel=1e-5)
        assert all(sum(row) == pytest.approx(1) for row in every)


def test_language_model_scores_with_large_weights():
    p = {k: a * 200 for k, a in lm_weights().items()}  # gates at 0 and 1, logits beyond what exp() holds
    rng = np.random.default_rng(2)
    docs = [[*rng.integers(0, 60, n).tolist(), 0] for n in (40, 1, 9)]
    for kind, rel in ((np.float64, 1e-9), (np.float32, 1e-3)):
        q = {k: a.astype(kind) for k, a in p.items()}
        hs, _, _ = language_model.forward(q, np.array(docs[0])[:, None], np.zeros((1, language_model.HIDDEN)))
        assert np.isfinite(hs).all() and np.abs(hs).max() <= 1
        logp, _ = language_model.outputs(q, hs[1:, 0], np.array(docs[0]))
        for h, y, x in zip(hs[1:, 0].astype(np.float64), docs[0], logp):
            a, b = h @ p["wc"] + p["bc"], h @ p["ww"][y // language_model.PER_CLASS] + p["bw"][y // language_model.PER_CLASS]
            want = sum(v[i] - v.max() - math.log(np.exp(v - v.max()).sum()) for v, i in ((a, y // language_model.PER_CLASS), (b, y % language_model.PER_CLASS)))
            assert x == pytest.approx(want, rel=rel, abs=0.05 if kind is np.float32 else 1e-6)


def test_language_model_scores_in_little_memory():
    """Scoring keeps the gates of one step only, of fewer documents at a time. More went back to the system after each
    window, and asking for it again cost a sixth of the CPU seconds of scoring."""
    p = {k: a.astype(np.float32) for k, a in lm_weights().items()}
    size = np.full(1024, 64)
    flat = np.random.default_rng(3).integers(0, language_model.TOP, size.sum()).astype(np.uint16)
    tracemalloc.start()
    try:
        language_model.log_probabilities(p, flat, size, 0)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 7 << 20


def test_language_model_gradient():
    p = lm_weights()
    x, y = np.array([[0, 1], [5, 30], [33, 1025]]), np.array([[5, 30], [33, 1025], [0, 0]])
    valid, h = np.array([[True, True], [True, True], [True, False]]), np.full((2, language_model.HIDDEN), 0.1)
    def total():
        hs, _, _ = language_model.forward(p, x, h)
        return language_model.outputs(p, hs[1:][valid], y[valid])[0].sum()
    logp, grads, _ = language_model.gradients(p, x, y, valid, h)
    assert logp == pytest.approx(total())
    for k, g in grads.items():
        for flat in np.argsort(-np.abs(g), axis=None)[:: max(1, g.size // 40)][:60]:
            at = np.unravel_index(flat, g.shape)
            was, ends = p[k][at], []
            for step in (1e-6, -1e-6):
                p[k][at] = was + step
                ends.append(total())
            p[k][at] = was
            assert (ends[0] - ends[1]) / 2e-6 == pytest.approx(g[at], abs=1e-6, rel=1e-4)
    q = {k: a.astype(np.float32) for k, a in p.items()}
    flat, size = np.array([5, 33, 0, 30, 1025, 0] * 30, np.uint16), np.full(60, 3)
    before = language_model.log_probabilities(q, flat, size, 0).sum()
    for _ in range(10):
        language_model.train(q, flat, size, 0, width=8)
    assert language_model.log_probabilities(q, flat, size, 0).sum() > before + 20


def test_classifiers(spark, labels):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["good", "fine", "text", "plain"]) + ("***" if i % 3 == 0 else "") + (" idiot" if i % 4 == 0 and k == 3 else "") for k in range(30))) for i in range(60)]
    q = {r.doc_id: r for r in quality_classifier.quality_scores(frame(spark, docs), labels).collect()}
    t = {r.doc_id: r for r in toxicity.toxicity_scores(frame(spark, docs), labels).collect()}
    held = [i for i in q if crc32(str(i).encode()) % 5 == 0]
    assert {i for i in q if q[i].held_out} == set(held) and all(0 <= r.score <= 1 for r in [*q.values(), *t.values()])
    assert np.mean([q[i].score for i in held if i % 3]) > np.mean([q[i].score for i in held if i % 3 == 0])
    assert np.mean([t[i].score for i in t if i % 4 == 0]) > np.mean([t[i].score for i in t if i % 4])


def test_subwords():
    def plain(text):
        total = sum((ord(c) + 1) * int(toxicity._PLACES[k]) for k, c in enumerate(text)) + len(text)
        return int(toxicity.mixed(np.array([total % 2**64], np.uint64))[0]) % toxicity.BUCKETS

    words = [b"abc", b"", b"a", "\u00fcn\u00efcode".encode(), b"x" * 60, b"hello"]
    gram, of = toxicity.subwords(words)
    for i, w in enumerate(words):
        t = w.decode()
        t = "<" + (t if len(t) <= 38 else t[:19] + t[-19:]) + ">"
        assert sorted(gram[of == i].tolist()) == sorted([plain(t)] + [plain(t[k:k + n]) for n in (3, 4, 5) if len(t) != n for k in range(len(t) - n + 1)])
    assert not len(toxicity.subwords([])[0])


def test_toxicity_long_words():
    assert toxicity.words_of(b"short words. " + b"y" * 38) == [b"short", b"words.", b"y" * 38]
    letters = "".join(unlike(2)(40).split()) + "\u00e9\u00e9"
    pieces = [x.decode() for x in toxicity.words_of(f"a {letters}, b".encode())]
    assert pieces[0] == "a" and pieces[-1] == "b" and max(map(len, pieces)) <= 38
    assert all(any(letters[i: i + 5] in x for x in pieces) for i in range(len(letters) - 4))
    gram, of = toxicity.subwords([x.encode() for x in pieces])
    inside = set(toxicity.subwords([b"zz" + letters[150:180].encode() + b"zz"])[0].tolist())
    assert len(inside & set(gram.tolist())) > 50


def test_awkward_tables(spark, labels):
    docs, none = frame(spark, AWKWARD), frame(spark, AWKWARD).limit(0)
    no_labels = labels.limit(0)
    bench = spark.createDataFrame([(1, "q w e r t z u i o p")], "item_id long, text string")
    for f in (
        lambda d: substring_dedup.substring_dedup(d), lambda d: near_dedup.near_dedup(d), lambda d: language_model.lm_scores(d), lambda d: toxicity.toxicity_scores(d, no_labels),
        lambda d: quality_rules.quality_rules(d, no_labels), lambda d: line_dedup.line_dedup(d), lambda d: quality_classifier.quality_scores(d, no_labels), lambda d: packing.pack(d),
    ):
        assert f(docs).count() == len(AWKWARD)
        assert f(none).count() == 0
    assert decontamination.contaminated(none, bench).count() == 0
    assert url_rules.url_rules(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_pipeline_stages(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
        assert docs.columns == corpus_pipeline.COLUMNS, name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and len(now) > len(ids) / 2
        ids = now
    assert {r.doc_id for r in corpus_pipeline.packing(spark, docs, sf).collect()} == ids


def test_pipeline_null_and_clashing_ids(spark, sf, tmp_path):
    import corpus_pipeline

    own = unlike(8)
    copy, item = own(30), own(20)
    texts = [(None, own(30)), (None, own(30)), (None, None), (5, own(30)), (5, own(30)), (5, ""), (6, copy), (4, copy), (7, copy + " end"), (8, own(9)), (8, own(9))]
    docs = frame(spark, texts)
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    assert kept == {x for x in texts if x[0] not in (6, 7)}
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, [(None, item), (None, copy), (5, item), (5, copy), (None, None)])
    left = [(r.doc_id, r.text) for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()]
    assert sorted(left, key=str) == sorted([(None, copy), (5, copy), (None, None)], key=str)


def test_query_digest(spark, sf):
    r = substring_dedup.query(spark, sf).first()
    assert len(r.kept_sha256) == len(hashlib.sha256(b"").hexdigest())
