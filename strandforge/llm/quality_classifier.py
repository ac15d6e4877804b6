"""Quality classifier: random-indexing word vectors pooled per document, a two-layer numpy network, and
temperature-calibrated probabilities.

Every unit (word core, case mark, punctuation run, "same word again") has a sparse random index vector given by its
bucket. A unit's word vector is the sum of the index vectors of its neighbours over the whole corpus; these sums are
integers, so their order does not matter. A document is the mean and the spread of its units' vectors.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, plainly, spelled, table
from .sampling import held_out, labelled_sample

BUCKETS, DIM, NONZERO, REACH = 8192, 64, 4, 2
#: Labelled rows the network is fitted on, at most, by label.
SAMPLE = {0: 8_000, 1: 12_000}
#: Outer punctuation and what is between; nothing taken is given back, so a word is read once.
_CORE = re.compile(r"(\W*+)((?:\w++(?:\W++(?=\w))?)*+)(\W*+)")
AGAIN, SHOUT, NUMBER = 0, 1, 2
_NONE = (-1, -1, -1, -1)


class Units(dict):
    """word -> its place in `table`, which holds the buckets of its units (-1: none). Emptied by `room` when it could
    overflow, and before the texts they come from are over 64 MB."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most, self.held = most, 0
        self.fresh: list[tuple] = []  # rows of words met in this text
        self.table = np.full((most, 4), -1, np.int16)

    def room(self, n: int) -> None:
        if len(self) + n > self.most:
            self.clear()
            if n > self.most:
                self.__init__(n)

    def __missing__(self, word: bytes) -> int:
        h = lambda x, lo, n: lo + xxhash.xxh3_64_intdigest(x) % n
        if word.isalpha():  # ASCII letters only: most words
            first = h(word.lower(), 512, BUCKETS - 512)
            out = (SHOUT, first) if len(word) > 1 and word.isupper() else (first,)
        else:
            before, core, after = _CORE.fullmatch(word.decode("utf-8", "replace")).groups()
            out = (h("b" + before[:3], 16, 496),) if before else ()
            if core.isdigit():
                out += (NUMBER,)
            elif core:
                out += (SHOUT,) if len(core) > 1 and core.isupper() else ()
                out += (h(core.lower(), 512, BUCKETS - 512),)
            if after:
                out += (h("a" + after[:3], 16, 496),)
        at = self[word] = len(self)
        self.fresh.append(out + _NONE[len(out):])
        return at

    def of(self, text: bytes | None) -> np.ndarray:
        words = text.split() if text else []
        self.held += len(text or b"")
        if self.held > 64 << 20:
            self.clear()
            self.held = len(text or b"")
        self.room(len(words))
        at = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        if self.fresh:
            self.table[len(self) - len(self.fresh): len(self)] = self.fresh
            self.fresh.clear()
        ids = self.table[at].reshape(-1)
        again = int(np.count_nonzero(at[1:] == at[:-1]))
        return np.concatenate([ids[ids >= 0], np.full(again, AGAIN, np.int16)])


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's nonzero entries."""
    rng = np.random.default_rng(11)
    places = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), rng.choice(np.array([-1, 1]), (BUCKETS, NONZERO)).astype(np.int64)


def contexts(flat: np.ndarray, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Sums of the index vectors of the neighbours of each bucket, as whole numbers; -1 is no unit."""
    code = 2 * places + (signs < 0)  # entries of either sign are counted apart
    total = np.zeros(2 * BUCKETS * DIM, np.int64)
    for step in range(1, REACH + 1):
        left, right = flat[:-step], flat[step:]
        ok = (left >= 0) & (right >= 0)
        left, right = left[ok].astype(np.int64), right[ok].astype(np.int64)
        for x, y in ((left, right), (right, left)):
            for k in range(NONZERO):
                total += np.bincount(x * (2 * DIM) + code[y, k], minlength=len(total))
    return total[::2] - total[1::2]


#: Units whose neighbours are counted at once (some MB of numbers), of one document more.
COUNTED = 1 << 19


def _contexts(batches):
    units, vectors = Units(), index_vectors()
    total, any_rows = np.zeros(BUCKETS * DIM, np.int64), False
    gap = np.full(REACH, -1, np.int16)  # neighbours never reach into another document
    held, size = [], 0
    for b in batches:
        any_rows = True
        for texts in pieces(b, "text"):
            for text in texts:
                held += [units.of(text), gap]
                size += len(held[-2]) + REACH
                if size >= COUNTED:
                    total += contexts(np.concatenate(held), *vectors)
                    held, size = [], 0
    if held:
        total += contexts(np.concatenate(held), *vectors)
    if any_rows:
        rows = total.reshape(BUCKETS, DIM)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(list(rows[used]), pa.list_(pa.int64()))], ["bucket", "v"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x DIM, rows of length 1 (or 0): a fixed size, whatever the corpus."""
    sums = docs.select("text").mapInArrow(_contexts, "bucket int, v array<long>").groupBy("bucket").agg(*[F.sum(F.get("v", F.lit(i))).alias(f"v{i}") for i in range(DIM)])
    out = np.zeros((BUCKETS, DIM))
    for r in sums.collect():
        out[r[0]] = r[1:]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.maximum(norm, 1e-9)).astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the units' vectors, the special units' shares, and the length; all 0 without units."""
    if not len(ids):
        return np.zeros(2 * DIM + 5, np.float32)
    n = np.bincount(ids, minlength=BUCKETS)
    used = np.flatnonzero(n)
    w = (n[used] / len(ids)).astype(np.float32)
    mean = w @ vectors[used]
    spread = np.sqrt(np.maximum(w @ vectors[used] ** 2 - mean**2, 0))
    share = n[[AGAIN, SHOUT, NUMBER]] / len(ids)
    return np.concatenate([4 * mean, 4 * spread, 4 * share, [np.log1p(len(ids)) / 8, w.max()]]).astype(np.float32)


def fitted(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, seed: int = 5) -> tuple[np.ndarray, ...]:
    """Two layers, softplus of the margin as loss, Adam; then one temperature on rows held back. Returns mean and
    spread of the inputs, the weights, and the temperature."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    mean, spread = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / spread
    back, own = order[: len(x) // 5], order[len(x) // 5:]
    w1, w2 = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), rng.normal(0, hidden**-0.5, hidden)
    p = [w1, np.zeros(hidden), w2, np.zeros(1)]
    m, v, t = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for epoch in range(epochs if len(own) else 0):
        rng.shuffle(own)
        for lo in range(0, len(own), 256):
            a, b = x[own[lo: lo + 256]], y[own[lo: lo + 256]]
            g = gradient(p, a, b)
            t += 1
            for i in range(4):
                m[i] = 0.9 * m[i] + 0.1 * g[i]
                v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                p[i] = p[i] - 3e-3 * (1 - epoch / epochs) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    temperature = 1.0
    if len(back) > 20:
        z = margin(p, x[back])
        tries = np.exp(np.linspace(-1.5, 2.5, 81))
        loss = [np.logaddexp(0, np.where(y[back] == 1, -z, z) / s).mean() for s in tries]
        temperature = float(tries[int(np.argmin(loss))])
    return mean, spread, *p, np.array([temperature])


def margin(p, x: np.ndarray) -> np.ndarray:
    return np.maximum(x @ p[0] + p[1], 0) @ p[2] + p[3]


def gradient(p, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean loss over rows, with a slight pull of the weights towards zero."""
    h = np.maximum(x @ p[0] + p[1], 0)
    d = (_sigmoid(h @ p[2] + p[3]) - y) / len(x)
    dh = np.outer(d, p[2]) * (h > 0)
    return [x.T @ dh + 1e-4 * p[0], dh.sum(0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]


def scores(net: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Calibrated probabilities; a net of one number gives that to all."""
    if len(net) == 1:
        return np.full(len(x), net[0][0])
    mean, spread, *p, temperature = net
    return _sigmoid(margin(p, (x - mean) / spread) / temperature[0])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _pool(vectors):
    def go(batches):
        units = Units()
        for b in batches:
            x = [pooled(units.of(t), vectors.value) for texts in pieces(b, "text") for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "label", "x"])
    return go


def _score(sent, keep):
    def go(batches):
        units = Units()
        vectors, net = sent.value
        for b in batches:
            if b.num_rows:
                x = np.stack([pooled(units.of(t), vectors) for texts in pieces(b, "text") for t in texts])
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(scores(net, x))], [*keep, "score"])
    return go


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: dict[int, int] = SAMPLE) -> DataFrame:
    """The columns of `docs` (less any named score, held_out, predicted) and held_out, score (the probability of
    quality 1), predicted (1 at `threshold` or above).

    Word vectors come from all texts, labels only from rows outside fold 0 of five, at most `sample` rows of each label
    value. doc_id, lang, source and labels are never inputs of a score. Null, empty and blank texts have the pooled
    vector zero and get its score. Without labels of both kinds every score is the labels' share (0.5 without any).
    Repeated rows are scored each; a null doc_id is not held out. An empty table gives an empty table."""
    spark = docs.sparkSession
    docs = docs.drop("score", "held_out", "predicted")
    vectors = word_vectors(docs)
    shared = spark.sparkContext.broadcast(vectors)
    rows = labelled_sample(docs, labels, "quality", sample).mapInArrow(_pool(shared), "doc_id long, label int, x array<float>").collect()
    rows.sort(key=lambda r: (r.doc_id, tuple(r.x)))
    y = np.array([r.label for r in rows], np.float64)
    if len(set(y.tolist())) == 2:
        net = fitted(np.array([r.x for r in rows], np.float64), y)
    else:
        net = (np.array([y.mean() if len(y) else 0.5]),)
    given = plainly(docs)
    out = given.mapInArrow(_score(spark.sparkContext.broadcast((vectors, net)), given.columns), f"{spelled(given)}, score double").toDF(*docs.columns, "score")
    return out.withColumns({"held_out": held_out(5), "predicted": (F.col("score") >= threshold).cast("int")})


def query(spark, sf_dir):
    out = quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


ORACLE_SQL = None
