"""A gated recurrent language model in numpy.

Counts come from every training token. The most frequent tokens form classes of equal size by rank, all other words
fall into classes by their first byte. The network (a GRU whose input layer is a table) predicts the class of the
next token and, for frequent tokens, the token within its class: a class-factored softmax. A rare word has its
smoothed share of its class, so the model is a distribution over all words, the unseen included.

Texts become token numbers once, two bytes each; training and scoring read these. Training is truncated
backpropagation on whole documents, with the state carried from window to window. Every training document is learned
from once: the documents are split into parts of growing size, a part is dealt to trainers of a fixed number of
tokens that start from the same weights, and their weights, averaged by tokens, are where the next part starts.
Scoring carries the state through the complete document.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw, runs, stored, table
from .sampling import fold

HIDDEN, CLASSES, PER_CLASS, RARE = 16, 32, 32, 16
TOP = CLASSES * PER_CLASS
#: Counts of this many words are sent to every executor (some 20 MB); those of all others are joined.
SENT_COUNTS = 200_000
WINDOW, LANES = 32, 256
#: Training documents are split in these proportions; tokens of a trainer, some. Trainers grow in number with the
#: corpus and with nothing else.
PARTS, TRAINED = (1, 3, 12), 2_000_000
LOG10 = float(np.log(10))


def _count(batches):
    total: Counter = Counter()
    held = 0  # bytes of the texts whose words these are
    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
    for b in batches:
        for text in raw(b, "text"):
            if text:
                total.update(text.lower().split())
                held += len(text)
            total[b""] += 1  # the end
            if held > 64 << 20:
                yield out()
                total.clear()
                held = 0
        if len(total) > 300_000:
            yield out()
            total.clear()
            held = 0
    if total:
        yield out()


def fresh(top: list[tuple[bytes, int]], rare_mass: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights to start from. The biases are the unigram distribution of the top words and the classes of rare ones."""
    rng = np.random.default_rng(seed)
    f = lambda s, *d: rng.normal(0, s, d).astype(np.float32)
    count = np.full(TOP, 1e-9)
    count[: len(top)] = [c + 0.1 for _, c in top]
    by_class = count.reshape(CLASSES, PER_CLASS)
    classes = np.log(np.r_[by_class.sum(1), rare_mass] / (count.sum() + rare_mass.sum()))
    words = np.log(by_class / by_class.sum(1, keepdims=True))
    return {"x": f(0.3, TOP + RARE, 3 * HIDDEN), "u": f(0.25, HIDDEN, 3 * HIDDEN), "wc": f(0.02, HIDDEN, CLASSES + RARE), "bc": classes.astype(np.float32),
            "ww": f(0.02, CLASSES, HIDDEN, PER_CLASS), "bw": words.astype(np.float32)}


def windows(flat: np.ndarray, start: np.ndarray, size: np.ndarray, end: int):
    """Documents side by side, longest first, window by window: (documents still alive, inputs, targets, which targets
    count). `flat` holds their tokens, each with its end; a document's first input is the end of the one before it."""
    for lo in range(0, int(size[0]), WINDOW):
        alive = int(np.searchsorted(-size, -lo, "left"))
        at = lo + np.arange(min(WINDOW, int(size[0]) - lo))[:, None]
        valid = at < size[:alive]
        y = np.where(valid, flat[np.minimum(start[:alive] + at, len(flat) - 1)], end).astype(np.int64)
        first = flat[start[:alive] + lo - 1] if lo else np.full(alive, end)
        yield alive, np.vstack([first[None], y[:-1]]), y, valid


def forward(p, ids: np.ndarray, h: np.ndarray, keep: bool = True):
    """GRU over ids (time, lane) from state h: all states, the given one first; the two gates and the candidates, of
    the last step alone without `keep`. Each gate lies in an array of its own, so every step is on whole memory."""
    n, (steps, width) = HIDDEN, ids.shape
    kind, held = p["u"].dtype, steps if keep else 1
    # a logistic function is 1 / (1 + exp(-a)), tanh(a) is 2 / (1 + exp(-2a)) - 1: the factors go into the weights
    factor = np.array([-1, -1, -2], kind)[:, None, None]
    u, x = np.empty((3, n, n), kind), np.empty((3, ids.size, n), kind)
    np.multiply(p["u"].reshape(n, 3, n).transpose(1, 0, 2), factor, out=u)
    np.multiply(p["x"].take(ids.reshape(-1), axis=0).reshape(-1, 3, n).transpose(1, 0, 2), factor, out=x)
    x = x.reshape(3, steps, width, n)
    hs = np.empty((steps + 1, width, n), kind)
    hs[0] = h
    gates, candidates, reset = np.empty((2, held, width, n), kind), np.empty((held, width, n), kind), np.empty((width, n), kind)
    one, two = np.array(1, kind), np.array(2, kind)  # a number of Python's costs as much as a step of one document
    with np.errstate(over="ignore"):  # exp() of a large number is infinite, and 1 / (1 + that) is 0
        for t in range(steps):
            zr, c, prev, new = gates[:, t % held], candidates[t % held], hs[t], hs[t + 1]
            z, r = zr
            np.dot(prev, u[0], out=z)
            np.dot(prev, u[1], out=r)
            zr += x[:2, t]
            np.exp(zr, out=zr)
            zr += one
            np.reciprocal(zr, out=zr)
            np.multiply(r, prev, out=reset)
            np.dot(reset, u[2], out=c)
            c += x[2, t]
            np.exp(c, out=c)
            c += one
            np.divide(two, c, out=c)
            c -= one
            np.subtract(prev, c, out=new)
            new *= z
            new += c
    return hs, gates, candidates


def _picked(logits: np.ndarray, at: np.ndarray, reach: float, slope: bool):
    """Log-softmax at one column of each row. With `slope`, logits become its derivatives times a factor of each row,
    which is returned too. No logit lies beyond `reach`."""
    if reach > 60 and logits.size and (logits.max() > 60 or logits.min() < -60):  # exp() must not overflow
        logits -= logits.max(axis=1, keepdims=True)
    flat, place = logits.reshape(-1), np.arange(len(at)) * logits.shape[1] + at
    own = flat.take(place)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    own -= np.log(total)
    if not slope:
        return own, None
    flat[place] = flat.take(place) - total
    return own, -1 / total[:, None]


#: The class of each token number.
_CLASS = np.r_[np.arange(TOP) // PER_CLASS, CLASSES + np.arange(RARE)]


def outputs(p, h: np.ndarray, target: np.ndarray, grad: dict | None = None):
    """Natural log-probabilities of the targets (rare words: of their class); with `grad`, that of the output weights is
    put there, and the states' gradients are returned. Rows are sorted by target, so each class is a slice; a state
    that is always 1 stands for the biases."""
    n, kind, learn = HIDDEN, h.dtype, grad is not None
    order = np.argsort(target.astype(np.uint16), kind="stable")
    target = target[order]
    cls = _CLASS[target]
    edge = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
    own = [(c, slice(edge[c], edge[c + 1])) for c in range(CLASSES) if edge[c] < edge[c + 1]]
    h1 = np.empty((len(h), n + 1), kind)
    h1[:, :n], h1[:, n] = h.take(order, axis=0), 1
    wc, ww = np.vstack([p["wc"], p["bc"]]), np.concatenate([p["ww"], p["bw"][:, None]], axis=1)
    most = max(1.0, -h.min(initial=0), h.max(initial=0))
    a, b = h1 @ wc, np.empty((edge[-1], PER_CLASS), kind)
    logp, scale_a = _picked(a, cls, most * np.abs(wc).sum(0).max(), learn)
    for c, rows in own:
        np.dot(h1[rows], ww[c], out=b[rows])
    inside, scale_b = _picked(b, target[: edge[-1]] % PER_CLASS, most * np.abs(ww).sum(1).max(), learn)
    logp[: edge[-1]] += inside
    out = np.empty_like(logp)
    out[order] = logp
    if not learn:
        return out, None
    g = (h1 * scale_a).T @ a
    grad["wc"], grad["bc"] = g[:n], g[n]
    dh, d = a @ p["wc"].T, np.empty((edge[-1], n), kind)
    dh *= scale_a
    h1 = h1[: edge[-1]] * scale_b
    g = np.zeros_like(ww)
    for c, rows in own:
        np.dot(h1[rows].T, b[rows], out=g[c])
        np.dot(b[rows], p["ww"][c].T, out=d[rows])
    grad["ww"], grad["bw"] = g[:, :n], g[:, n]
    d *= scale_b
    dh[: edge[-1]] += d
    back = np.empty_like(dh)
    back[order] = dh
    return out, back


def gradients(p, x: np.ndarray, y: np.ndarray, valid: np.ndarray, h: np.ndarray):
    """Summed log-probability of a window's valid targets, its gradient in all weights, and the last state."""
    n, g = HIDDEN, {}
    hs, gates, candidates = forward(p, x, h)
    ok = np.flatnonzero(valid)
    # a state predicts the token after its input
    logp, dh = outputs(p, hs[1:].reshape(-1, n).take(ok, axis=0), y.reshape(-1).take(ok), g)
    if len(ok) < valid.size:
        d_out = np.zeros((valid.size, n), hs.dtype)
        d_out[ok] = dh
    else:
        d_out = dh
    d_out = d_out.reshape(hs[1:].shape)
    prev, (z, r) = hs[:-1], gates
    dx, back, through = np.empty((3, *x.shape, n), hs.dtype), np.zeros_like(hs[0]), np.empty_like(hs[0])
    more = np.empty_like(through)
    # derivatives of the gates and candidates come first, to be multiplied by what comes back
    of_z, of_r, of_c = dx
    np.subtract(1, gates, out=dx[:2])
    np.multiply(candidates, candidates, out=of_c)
    np.subtract(1, of_c, out=of_c)
    of_c *= of_z
    dx[:2] *= gates
    of_z *= prev - candidates
    of_r *= prev
    u = np.ascontiguousarray(p["u"].reshape(n, 3, n).transpose(1, 2, 0))
    for t in range(len(x) - 1, -1, -1):
        d = d_out[t]
        d += back
        of_c[t] *= d
        np.dot(of_c[t], u[2], out=through)
        of_z[t] *= d
        of_r[t] *= through
        np.dot(of_z[t], u[0], out=back)
        np.dot(of_r[t], u[1], out=more)
        back += more
        d *= z[t]
        through *= r[t]
        back += d
        back += through
    dx, prev = dx.reshape(3, -1, n), prev.reshape(-1, n)
    g["u"] = np.hstack([prev.T @ dx[0], prev.T @ dx[1], (r.reshape(-1, n) * prev).T @ dx[2]])
    # rows of the input table: sums over equal ids
    ids = x.reshape(-1).astype(np.uint16)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    g["x"] = np.zeros_like(p["x"])
    g["x"][ids[first]] = np.hstack([np.add.reduceat(d.take(order, axis=0), first, axis=0) for d in dx])
    return logp.sum(), g, hs[-1]


def lanes(size: np.ndarray, width: int):
    """Documents that go side by side: `width` of them, of similar length, longest first."""
    order = np.argsort(-size, kind="stable")
    return [order[i: i + width] for i in range(0, len(order), width)]


def train(p: dict, flat: np.ndarray, size: np.ndarray, end: int, width: int = 256, rate: float = 0.01) -> None:
    """One pass of truncated backpropagation through time (Adam) over documents of `size` tokens, which lie one after
    the other in `flat`."""
    start = np.cumsum(size) - size
    # all weights lie in one array, of which `q` has the parts
    w = _flat(p)
    m, v, g, more = (np.zeros_like(w) for _ in range(4))
    q, slopes = _views(w, p), _views(g, p)
    groups, t = lanes(size, width), 0
    np.random.default_rng(len(size)).shuffle(groups)
    for own in groups:
        h = np.zeros((len(own), HIDDEN), w.dtype)
        for alive, x, y, valid in windows(flat, start[own], size[own], end):
            _, found, h = gradients(q, x, y, valid, h[:alive])
            for k, slope in found.items():
                slopes[k][...] = slope
            t += 1
            step = rate / (1 + t / 400) * (1 - 0.99**t) ** 0.5 / (1 - 0.9**t)
            g /= valid.sum()
            np.multiply(g, 0.1, out=more)
            m *= 0.9
            m += more
            g *= g
            g *= 0.01
            v *= 0.99
            v += g
            np.sqrt(v, out=g)
            g += 1e-6
            np.divide(m, g, out=g)
            g *= step
            w += g
    for k, own in q.items():
        p[k][...] = own


def log_probabilities(p: dict, flat: np.ndarray, size: np.ndarray, end: int) -> np.ndarray:
    """Of each complete document the sum of its tokens' natural log-probabilities."""
    start, total = np.cumsum(size) - size, np.zeros(len(size))
    for own in lanes(size, LANES):
        h = np.zeros((len(own), HIDDEN), np.float32)
        for alive, x, y, valid in windows(flat, start[own], size[own], end):
            hs, _, _ = forward(p, x, h[:alive], keep=False)
            ok = np.flatnonzero(valid)
            logp, _ = outputs(p, hs[1:].reshape(-1, HIDDEN).take(ok, axis=0), y.reshape(-1).take(ok))
            total[own[:alive]] += np.bincount(ok % alive, weights=logp, minlength=alive)
            h = hs[-1]
    return total


def _flat(p) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in sorted(p)])


def _views(flat: np.ndarray, like) -> dict:
    """The parts of `flat` that have the names and shapes of `like`."""
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at: at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


CHUNK = 64


def _trainer(sent):
    def go(batches):
        p, end = sent.value
        p = {k: a.copy() for k, a in p.items()}
        rows, held, seen = [], 0, 0
        def learn():
            docs = [np.frombuffer(x, np.uint16) for _, x in sorted(rows)]
            size = np.array([len(x) for x in docs])
            train(p, np.concatenate(docs), size, end)
            return int(size.sum())
        for b in batches:
            for row in zip(b.column("row").to_pylist(), b.column("ids").to_pylist(), strict=True):
                rows.append(row)
                held += len(row[1]) // 2
                if held > 4 * TRAINED:  # a trainer that got more than it should holds no more than this at once
                    seen += learn()
                    rows, held = [], 0
        if rows:
            seen += learn()
        if seen:
            flat = _flat(p).astype(np.float64) * seen
            flat = np.pad(flat, (0, -len(flat) % CHUNK)).reshape(-1, CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array([float(seen)] * len(flat)), pa.array(list(flat), pa.list_(pa.float64()))], ["chunk", "n", "w"])
    return go


def parts(docs: DataFrame, proportions: tuple[int, ...]) -> list[DataFrame]:
    """`docs` (with `row`) split in these proportions; every document is in one part."""
    at, whole, out = 0, sum(proportions), []
    place = F.pmod(F.xxhash64("row"), F.lit(whole))
    for n in proportions:
        out.append(docs.where((place >= at) & (place < at + n)))
        at += n
    return out


def fit(docs: DataFrame, tokens: int, p: dict, end: int, proportions: tuple[int, ...] = PARTS) -> dict[str, np.ndarray]:
    """Weights learned from all of `docs` (row, ids), some `tokens` in all; a fixed number of floats goes back."""
    for own, share in zip(parts(docs, proportions), proportions, strict=True):
        n = max(1, tokens * share // sum(proportions) // TRAINED)
        sent = docs.sparkSession.sparkContext.broadcast((p, end))
        sums = own.select("row", "ids").repartition(n, "row").mapInArrow(_trainer(sent), "chunk int, n double, w array<double>").groupBy("chunk").agg(
            F.sum("n").alias("n"), *[F.sum(F.get("w", F.lit(i))).alias(f"w{i}") for i in range(CHUNK)]).collect()
        if sums:
            p = _views(np.concatenate([np.array(r[2:]) / r[1] for r in sorted(sums)]).astype(np.float32), p)
    return p


class Places(dict):
    """word -> its place in tables of the counts sent; other words: the place of their class behind these."""

    def __init__(self, frequent: list[tuple[bytes, int]], n_top: int):
        super().__init__((w, i) for i, (w, _) in enumerate(frequent))
        self.n = len(frequent)
        rare = [TOP + zlib.crc32(w[:1]) % RARE for w, _ in frequent[n_top:]]
        self.token = np.r_[np.arange(n_top), np.array(rare, np.int64), TOP + np.arange(RARE)].astype(np.uint16)
        count = np.array([c for _, c in frequent], np.float64)
        self.known = np.r_[count > 0, np.zeros(RARE, bool)]
        self.log = np.r_[np.log10(count + 0.1), np.zeros(RARE)]

    def __missing__(self, word: bytes) -> int:
        return self.n + zlib.crc32(word[:1]) % RARE


NUMBERED = "row long, doc_id long, train boolean, n_tokens long, known long, logs double, off double, ids binary, rest array<binary>"


def _numbered(sent):
    """Token numbers of the texts, and what the counts say of them."""
    def go(batches):
        frequent, n_top, rare_mass = sent.value
        places = Places(frequent, n_top)
        # what a token takes off the network's log: of frequent words the count's, of rare ones the class's mass
        off = np.r_[places.log[:n_top], np.log10(rare_mass)[places.token[n_top:].astype(np.int64) - TOP]]
        for b in batches:
            texts = raw(b, "text")
            for lo, hi in runs(texts, 1 << 23):
                if lo == hi:
                    continue
                own, rest, ends = [], [], [0]
                for text in texts[lo:hi]:
                    words = text.lower().split() if text else []
                    words.append(b"")
                    at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                    rest += [words[i] for i in np.flatnonzero(at >= places.n).tolist()]
                    ends.append(len(rest))
                    own.append(at)
                size = np.array([len(x) for x in own])
                start, at = np.cumsum(size) - size, np.concatenate(own)
                sums = [np.add.reduceat(x[at].astype(kind), start) for x, kind in ((places.known, np.int64), (places.log, np.float64), (off, np.float64))]
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.r_[start, len(at)] * 2), pa.py_buffer(places.token[at])])
                beyond = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rest, pa.binary()))
                given = [b.column(c).slice(lo, hi - lo) for c in ("row", "doc_id", "train")]
                yield pa.RecordBatch.from_arrays([*given, pa.array(size), *map(pa.array, sums), ids.cast(pa.binary()), beyond], ["row", "doc_id", "train", "n_tokens", "known", "logs", "off", "ids", "rest"])
    return go


def _scorer(sent):
    def go(batches):
        p, end = sent.value
        for b in batches:
            ids = b.column("ids").to_pylist()
            for lo, hi in runs(ids, 1 << 23):
                own = b.slice(lo, hi - lo)
                size = np.array([len(x) // 2 for x in ids[lo:hi]])
                net = log_probabilities(p, np.frombuffer(b"".join(ids[lo:hi]), np.uint16), size, end) / LOG10
                # log10(c + 0.1) of every word comes with `logs`: of rare words this leaves their share of their class
                net -= own.column("off").to_numpy()
                keep = ["row", "doc_id", "n_tokens", "known", "logs"]
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in keep], pa.array(net)], [*keep, "net"])
    return go


def _floor(counts: DataFrame, most: int) -> int:
    """The least count that at most `most` words reach, from a histogram with counts rounded down to 12 bits: some
    100,000 rows, whatever the corpus, where a sorted limit would send that many words of every partition."""
    shift = F.greatest(F.length(F.bin("c")) - 12, F.lit(0))
    held, floor = 0, 2**62
    for r in sorted(counts.groupBy(F.call_function("shiftleft", F.call_function("shiftright", F.col("c"), shift), shift).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        held += r.n
        if held > most:
            break
        floor = r.c
    return floor


def lm_scores(docs: DataFrame, sent_counts: int = SENT_COUNTS, proportions: tuple[int, ...] = PARTS) -> DataFrame:
    """Per row: doc_id, held_out (crc32 of the id mod 10 is 0; those rows teach nothing), n_tokens (words, and one
    end), n_known, train_tokens, base_score (log10, smoothed unigram), score (log10, the recurrent model).

    Null, empty and blank texts are the end alone. A null doc_id is a training row. Repeated rows count and are
    scored each. With nothing to learn from, all counts are zero and the model is its initial one. Other columns
    are ignored; an empty table gives an empty table. Scores depend in their last digits on the order in which
    trainers' weights are added up, and slightly on how the table is cut into partitions, which numbers its rows."""
    spark = docs.sparkSession
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold(10) != 0, F.lit(True)).alias("train"), "text")
    counts = stored(given.where("train").select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # bounded by sent_counts, whatever the corpus; words that tie at the cutoff stay behind together
    floor = _floor(counts, sent_counts)
    frequent = sorted(((bytes(r.word), r.c) for r in counts.where(F.col("c") >= floor).collect()), key=lambda x: (-x[1], x[0]))
    if b"" not in dict(frequent):
        end = [(b"", r.c) for r in counts.where(F.length("word") == 0).collect()] or [(b"", 0)]
        frequent = end + frequent
    top = [x for x in frequent if x[0] == b""] + [x for x in frequent if x[0] != b""][: TOP - 1]  # the end is 0
    rare = counts.where(F.length("word") > 0).groupBy((F.crc32(F.substring("word", 1, 1)) % RARE).cast("int").alias("r")).agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("s"))
    words, mass = np.zeros(RARE), np.zeros(RARE)
    for r in rare.collect():
        words[r.r], mass[r.r] = r.v, r.s
    for w, c in top[1:]:
        words[zlib.crc32(w[:1]) % RARE] -= 1
        mass[zlib.crc32(w[:1]) % RARE] -= c
    rare_mass = mass + 0.1 * (words + 1)
    beyond = {w for w, _ in top}
    sent = spark.sparkContext.broadcast((top + [x for x in frequent if x[0] not in beyond], len(top), rare_mass))
    numbered = stored(given.mapInArrow(_numbered(sent), NUMBERED), "numbered")
    p = fit(numbered.where("train"), int(total), fresh(top, rare_mass), 0, proportions)
    scored = numbered.mapInArrow(_scorer(spark.sparkContext.broadcast((p, 0))), "row long, doc_id long, n_tokens long, known long, logs double, net double")
    # words beyond the counts sent are rare by their rank; their counts are joined
    rest = numbered.select("row", F.explode("rest").alias("word")).join(counts, "word", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))
    rest = rest.groupBy("row").agg(F.sum(log).alias("more"), F.count(F.when(F.col("c") > 0, 1)).alias("more_known"))
    out = scored.join(rest, "row", "left")
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    scale = float(np.log10(total + 0.1 * (distinct + 1)))
    return out.select(
        "doc_id", F.coalesce(fold(10) == 0, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(scale)).alias("base_score"), (F.col("net") + logs).alias("score"),
    )


def query(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
