"""Vector codes, bin completion and the name join: brute force, and the cases each docstring names."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strandforge.llm import bin_completion, name_join, vector_codes

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# ---- vector codes -------------------------------------------------------------------------------------------------

def coded_by_hand(rows, entries=256, rounds=4):
    """Codes, errors and codebooks of (vec_id, vector, label) rows, distance by distance."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}, hashlib.sha256(b"").hexdigest()
    w = len(kept[0][1]) // 4
    cut = lambda v, p: v[p * w: (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in sorted(kept)[:entries]] for p in range(4)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            own = {}
            for _, v, _ in kept:
                own.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, xs in own.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out = {}
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(4)]
        out.setdefault(i, []).append(("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_codes_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, rng.gauss(0, 0.2)]) for _ in range(20)], rng.choice([None, 1, 2])) for i in range(700)]
    rows += [(900, None, 1), (901, [0.1] * 19 + [None], 2), (902, [0.1] * 19 + [math.nan], 2), (903, [math.inf] + [0.1] * 19, None), (3, rows[3][1], 1)]
    coded, books = vector_codes.compress(embeddings(spark, rows).repartition(5))
    want, told = coded_by_hand(rows)
    got = {}
    for r in vector_codes.with_label_errors(coded).collect():
        got.setdefault(r.vec_id, []).append((r.code, r.error, r.label, r.label_error))
    assert vector_codes.fingerprint(books) == told
    assert {k: sorted((a, b, str(c)) for a, b, c, _ in v) for k, v in got.items()} == {k: sorted((a, b, str(c)) for a, b, c in v) for k, v in want.items()}
    sums = {}
    for v in want.values():
        for _, e, label in v:
            sums[label] = sums.get(label, 0) + e
    assert all(s == sums[label] for v in got.values() for _, _, label, s in v)


def test_nearest_ties_and_extremes():
    rng = np.random.default_rng(2)
    for w, k, most in ((1, 7, 3), (5, 256, 2), (16, 256, 600), (6, 40, vector_codes.LARGEST)):
        x, e = rng.integers(-most, most, (1_500, w)), rng.integers(-most, most, (k, w))
        d = ((x[:, None, :] - e[None]) ** 2).sum(axis=2)
        index, least = vector_codes.nearest(x, e)
        assert (index == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.5] * 8, 1)], [(None, [0.5] * 8, None)] * 2 + [(7, [0.1] * 8, None)], [(1, [], 1)]])
def test_codes_of_few_rows(spark, rows):
    coded, books = vector_codes.compress(embeddings(spark, rows))
    kept = [r for r in rows if r[1] is not None]
    assert len(coded.collect()) == len(kept)
    assert all(r.code is not None for r in coded.collect())


def test_codes_of_odd_rows(spark):
    rows = [(1, [0.5] * 6, 1), (2, [0.25] * 6, 1), (3, [0.5] * 7, 1), (4, [1e30] + [0.0] * 5, 2)]
    frame = embeddings(spark, rows).withColumn("v", F.lit(1)).withColumn("code", F.lit("x"))
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in vector_codes.with_label_errors(vector_codes.compress(frame)[0]).collect()}
    # six components: parts of two, filled up with zeros
    assert got == {1: ("00000000", 0, 0), 2: ("01010100", 0, 0), 3: (None, None, 0), 4: (None, None, None)}
    assert all(r.code is None for r in vector_codes.compress(embeddings(spark, [(4, [1e30] * 4, 2)]))[0].collect())
    assert vector_codes.compress(embeddings(spark, [(None, [0.5] * 4, 2)]))[0].collect()[0].code is None


# ---- bin completion -----------------------------------------------------------------------------------------------

def fewest(items, capacity):
    """The least number of bins, every way tried."""
    best, items = [len(items)], sorted(items, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def histogram(items, capacity):
    return np.bincount(np.array(items, np.int64), minlength=capacity + 1).tolist()


def held(patterns, capacity):
    out = [0] * (capacity + 1)
    for times, f in patterns:
        assert times > 0 and sum(x * n for x, n in f.items()) <= capacity
        for x, n in f.items():
            out[x] += times * n
    return out


def test_bin_completion_is_optimal():
    rng, better = random.Random(1), 0
    for t in range(600):
        capacity = rng.choice([20, 30, 50])
        items = [rng.randint(1, capacity) if t % 2 else rng.randint(capacity // 5, capacity // 2) for _ in range(rng.randint(1, 11))]
        counts = histogram(items, capacity)
        patterns, bound = bin_completion.complete(counts, capacity)
        best, n = fewest(items, capacity), sum(k for k, _ in patterns)
        assert held(patterns, capacity) == counts and bound <= best == n
        better += n < sum(k for k, _ in bin_completion.best_fit(counts, capacity))
    assert better  # best fit alone is not enough


def test_bin_completion_finds_perfect_packings():
    rng = np.random.default_rng(4)
    items = []
    for _ in range(120):  # each bin cut into three
        a = int(rng.integers(300, 420))
        b = int(rng.integers(280, 1024 - a - 250))
        items += [a, b, 1024 - a - b]
    counts = histogram(items, 1024)
    patterns, bound = bin_completion.complete(counts, 1024)
    n = sum(k for k, _ in patterns)
    assert held(patterns, 1024) == counts and bound == 120
    assert n < sum(k for k, _ in bin_completion.best_fit(counts, 1024)) and n <= 124
    assert bin_completion.complete([0] * 1025, 1024) == ([], 0)


def test_words_have_the_ids_of_the_text():
    rng, ids = random.Random(3), bin_completion.Ids(TOKENIZER)
    letters = [" " * 5_000, *"ab!'s 1é\n\t\r\x0b\x1c\x1f\x85\xa0 　 ᠎﻿​日<|>", "<|endoftext|>", "  ", "'re", " a"]
    for _ in range(5_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        assert ids.of(text, 5) == ids.plain(text), repr(text)
    long = "word éè 1,000 " * 40_000
    assert ids.of(long) == ids.of(long, 1 << 30) == ids.plain(long)


def check_packing(docs, placed, capacity):
    """All that a packing must keep: pieces in order, whole documents, no gaps. Gives the number of sequences."""
    from tokenizers import Tokenizer

    tokenizer, by_doc, by_bin = Tokenizer.from_file(TOKENIZER), {}, {}
    for r in placed:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for i, text in docs:
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        rows = sorted(by_doc[i], key=lambda r: r.piece)
        if i is None:
            assert all(np.frombuffer(r.ids, "<u4").tolist() == want for r in rows)
            continue
        first = len(want) % capacity or capacity
        cuts = [0, *range(first, len(want) + 1, capacity)]
        assert [(r.piece, r.start, r.length) for r in rows] == [(k, a, b - a) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]).tolist() == want
    for parts in by_bin.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_bin)


def test_packed_documents(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["alpha", "béta", "日本", "x1", "\n", "  "]) for _ in range(rng.choice([3, 20, 90, 400])))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "   "), (503, "a" * 5_000), (504, "word " * 20_000), (None, "no id"), (None, "no id")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("length", F.lit("x")).repartition(7)
    placed = bin_completion.pack(frame, TOKENIZER, capacity=128)
    rows = placed.collect()
    n = check_packing(docs, rows, 128)
    bound = -(-sum(r.length for r in rows) // 128)
    assert n <= bound + 2
    assert sum(r.doc_id is None for r in rows) == 2
    # the packed sequences hold their pieces' ids one behind the other
    for s in bin_completion.sequences(placed).collect():
        assert len(s.ids) == 4 * sum(p.length for p in s.pieces) and s.pieces[0].offset == 0


def test_packing_of_nothing(spark):
    assert bin_completion.pack(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).count() == 0


# ---- name join ----------------------------------------------------------------------------------------------------

def distance(a, b):
    """Unrestricted Damerau-Levenshtein, the whole table."""
    last, big = {}, len(a) + len(b)
    d = [[big] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i in range(1, len(a) + 1):
        at = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), at
            cost = a[i - 1] != b[j - 1]
            if not cost:
                at = j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return d[-1][-1]


def names(rng, n, letters="abcö\U0001f600", most=7):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(n)]


def test_walk_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        a, b = sorted(set(names(rng, rng.randint(0, 25)))), sorted(set(names(rng, rng.randint(0, 25))))
        got = name_join.walk(a, b)
        assert len(got) == len(set(got))
        assert set(got) == {(x, y, distance(x, y)) for x in a for y in b if distance(x, y) <= 1}


def test_automaton_is_minimal():
    words = sorted({a + b for a in ("tap", "top", "stop", "t") for b in ("", "s", "ping", "p")} | set(names(random.Random(6), 200, "ab")))
    ways, _ = name_join.automaton(words)
    live, todo = {0}, [0]
    while todo:
        for z in ways[todo.pop()].values():
            if z not in live:
                live.add(z)
                todo.append(z)
    # one state for each set of ways to go on
    rests = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in {w[:k] for w in words for k in range(len(w) + 1)}}
    assert len(live) == len(rests)


@pytest.mark.parametrize(("limit", "step"), [(1, 1), (4, 2), (30, 8), (10_000, 8)])
def test_join_brute_force(spark, limit, step):
    rng = random.Random(limit)
    left = names(rng, 300) + ["shared" * 3 + x for x in names(rng, 60)] + [None, "", "abc"]
    right = names(rng, 120) + ["shared" * 3 + x for x in names(rng, 30)] + [None, "", "cab", "abc"]
    clients = spark.createDataFrame([(i if i % 9 else None, x) for i, x in enumerate(left)], "client_id long, name string").withColumn("cut", F.lit(1)).withColumn("left", F.lit("x"))
    vendors = spark.createDataFrame([(i % 100 if i % 17 else None, x) for i, x in enumerate(right)], "vendor_id long, name string").withColumn("side", F.lit(1))
    want = {}
    for j, y in enumerate(right):
        for i, x in enumerate(left):
            if x and y and abs(len(x) - len(y)) <= 1 and (d := distance(x, y)) <= 1:
                n, first, crc = want.get(key := (j % 100 if j % 17 else None, d), (0, None, None))
                if i % 9:
                    first, crc = min(i, first if first is not None else i), (crc or 0) + zlib.crc32(str(i).encode())
                want[key] = (n + 1, first, crc)
    got = {(r.vendor_id, r.distance): (r.n_clients, r.first_client_id, r.clients_crc) for r in name_join.name_join(clients, vendors, limit, step).collect()}
    assert got == want


def test_join_of_long_and_no_names(spark):
    long = "n" * 3_000
    a = spark.createDataFrame([(1, long + "a"), (2, "x" + long), (3, long + "ab")], "client_id long, name string")
    b = spark.createDataFrame([(1, long + "b"), (2, long)], "vendor_id long, name string")
    got = {(r.vendor_id, r.distance): r.n_clients for r in name_join.name_join(a, b).collect()}
    assert got == {(1, 1): 2, (2, 1): 2}
    assert name_join.name_join(a.limit(0), b).count() == name_join.name_join(a, b.limit(0)).count() == 0


def test_names_as_stored(spark):
    rows = [(v, n) for v in range(12) for n in ("Ab Cö\t", "X", "", None, "\U0001f600Q")]
    got = spark.createDataFrame(rows, "vendor_id long, name string").select("vendor_id", "name", name_join.misspelt(F.col("name"), F.col("vendor_id")).alias("m"), name_join.form(F.col("name")).alias("f")).collect()
    for r in got:
        h, x = zlib.crc32(str(r.vendor_id).encode()), r.name
        if x is not None and h % 2 == 0 and len(x) >= 2:
            k = h % (len(x) - 1)
            x = x[:k] + x[k + 1] + x[k] + x[k + 2:]
        assert r.m == x
        assert r.f == (None if r.name is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r.name if c not in " \t\n\x0b\x0c\r"))
