"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its character n-grams (3 to 5, with word borders) and of the whole
word, so unseen misspellings share most of a known word's vector. A window of `SPAN` words in a row, wherever it
begins, is the average of its words, which a linear softmax classifies; a document is as toxic as its most toxic
window. Training alternates: the window that now scores highest stands for its document, and embeddings and softmax
take a joint gradient step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, plainly, raw, runs, spelled, stored, table
from .sampling import held_out, labelled_sample

BUCKETS, DIM, SPAN = 1 << 16, 8, 5
#: Window averages are multiplied by this; steps before the highest window answers for its document.
GAIN, WARM = 2, 12
RATE, FLOOR = 0.1, 3e-4
#: Labelled rows the model is fitted on, at most, by label; bytes of their texts, of one and of all.
SAMPLE = {0: 2_500, 1: 1_500}
MOST_ONE, MOST_ALL = 1 << 20, 1 << 26
#: Factors of the places in a word or n-gram.
_PLACES = mixed(np.arange(1, 41, dtype=np.uint64)) | np.uint64(1)
#: Letters of a word; longer ones are cut into pieces that overlap by four letters, so each n-gram is in one.
LONGEST, OVERLAP = 38, 4
_EDGE = b".,;:!?()[]{}\"'`*&%$#|-_"


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of words of at most `LONGEST` letters (lower-cased, without outer punctuation), and the
    place of the word of each."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    texts = [w.decode("utf-8", "replace") for w in words]
    # `words_of` gives none over `LONGEST`, so this cuts nothing of a text
    texts = ["<" + (t if len(t) <= LONGEST else t[:19] + t[-19:]) + ">" for t in texts]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    end = np.cumsum(size)
    of, first, length = np.repeat(np.arange(len(texts)), size), np.repeat(end - size, size), np.repeat(size, size)
    place = np.arange(len(points)) - first
    hashes = [np.add.reduceat(points * _PLACES[place], end - size) + size.astype(np.uint64)]
    owners = [np.arange(len(texts))]
    for n in (3, 4, 5):
        at = np.flatnonzero((length - place >= n) & (length != n))
        hashes.append(sum(points[at + k] * _PLACES[k] for k in range(n)) + np.uint64(n))
        owners.append(of[at])
    return (mixed(np.concatenate(hashes)) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


def core(word: bytes) -> bytes:
    return word.lower().strip(_EDGE)


def words_of(text: bytes) -> list[bytes]:
    """Words, of which those over `LONGEST` letters are cut into pieces that hold all of their n-grams."""
    words = text.split()
    if not words or max(map(len, words)) <= LONGEST:
        return words
    out = []
    for w in words:
        t = core(w).decode("utf-8", "replace") if len(w) > LONGEST else ""
        if len(t) > LONGEST:
            out += [t[i: i + LONGEST].encode() for i in range(0, len(t) - OVERLAP, LONGEST - OVERLAP)]
        else:
            out.append(w)
    return out


def spread(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of documents of `size` words, one after the other: the first word of each, the word behind its last, and
    its document. A document of `SPAN` words or fewer is one window."""
    own = np.maximum(size - SPAN + 1, 1)
    doc = np.repeat(np.arange(len(size)), own)
    begin = np.cumsum(size) - size
    first = begin[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(own) - own, own)
    return first, np.minimum(first + SPAN, (begin + size)[doc]), doc


def sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    total = np.r_[0.0, np.cumsum(values)]
    return total[last] - total[first]


class Model:
    def __init__(self, texts: list[bytes], labels: np.ndarray, steps: int = 90, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.e, self.u, self.b = rng.normal(0, 0.1, (BUCKETS, DIM)), rng.normal(0, 0.5, (DIM, 2)), np.zeros(2)
        self.scale, self.shift = 1.0, 0.0
        if not len(texts) or len(set(labels.tolist())) < 2:
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return
        self.constant = None
        known: dict[bytes, int] = {}
        split = [np.array([known.setdefault(core(w), len(known)) for w in words_of(x)], np.int32) for x in texts]
        ids = np.concatenate(split)
        window = spread(np.array([len(x) for x in split]))
        doc = window[2]
        gram, of_word = subwords(list(known))
        weight = 1.0 / np.bincount(of_word)[of_word] if len(gram) else np.empty(0)
        per_doc = np.bincount(doc, minlength=len(texts))
        first = np.cumsum(per_doc) - per_doc
        back = rng.random(len(texts)) < 0.2  # held back for the calibration of the document score
        pos, neg = (labels == 1) & ~back, (labels == 0) & ~back
        mean, square = ([np.zeros_like(p) for p in (self.e, self.u, self.b)] for _ in range(2))
        for t in range(steps):
            s = self._windows(gram, of_word, weight, ids, window)
            # a clean document is clean in every window; of a toxic one the highest window answers, at first all
            share = np.zeros(len(doc))
            if t >= WARM:  # windows overlap: those of a clean document are weighed as if they did not
                share[neg[doc]] = (1.0 / max(neg.sum(), 1) / np.minimum(per_doc, SPAN)[doc])[neg[doc]]
                share[_argmax(s, doc, first)[pos]] = 1.0 / max(pos.sum(), 1)
            else:
                share[neg[doc]] = (1.0 / max(neg.sum(), 1) / per_doc[doc])[neg[doc]]
                share[pos[doc]] = (1.0 / max(pos.sum(), 1) / per_doc[doc])[pos[doc]]
            grads = self._gradients(gram, of_word, weight, ids, window, (1 / (1 + np.exp(-np.clip(s, -30, 30))) - labels[doc]) * share)
            # Adam with a large floor: steps of frequent n-grams are bounded, those of rare ones stay in proportion to
            # their gradients, so single documents are not memorised
            for param, m, v, g, rate in zip((self.e, self.u, self.b), mean, square, grads, (RATE, 0.02, 0.1), strict=True):
                m += 0.1 * (g - m)
                v += 0.05 * (g * g - v)
                param -= rate * m / (np.sqrt(v) + FLOOR)
        s = self._windows(gram, of_word, weight, ids, window)
        s = s[_argmax(s, doc, first)]
        if back.sum() > 50 and len(set(labels[back].tolist())) == 2:
            self._calibrate(s[back], labels[back])

    def _windows(self, gram, of_word, weight, ids, window) -> np.ndarray:
        """Margins of all windows. The softmax is linear in the average, so numbers may be averaged instead of vectors."""
        word = np.bincount(of_word, weights=(self.e @ (self.u[:, 1] - self.u[:, 0]))[gram] * weight) if len(gram) else np.empty(0)
        return sums(word[ids], *window[:2]) * GAIN / SPAN + self.b[1] - self.b[0]

    def _gradients(self, gram, of_word, weight, ids, window, d: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of a loss whose derivative in each window's margin is `d`, in embeddings, softmax and bias."""
        edges = np.bincount(window[0], weights=d, minlength=len(ids) + 1) - np.bincount(window[1], weights=d, minlength=len(ids) + 1)
        per_place = np.cumsum(edges)[:-1] * GAIN / SPAN
        per_word = np.bincount(ids, weights=per_place, minlength=int(of_word.max(initial=-1)) + 1)
        per_gram = np.bincount(gram, weights=per_word[of_word] * weight, minlength=BUCKETS)
        g_w, g_b = per_gram @ self.e, d.sum()
        return np.outer(per_gram, self.u[:, 1] - self.u[:, 0]), np.stack([-g_w, g_w], 1), np.array([-g_b, g_b])

    def _calibrate(self, s: np.ndarray, y: np.ndarray) -> None:
        """Scale and shift of the document's margin with the least balanced log loss on the rows held back."""
        w = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        best = None
        for scale in np.exp(np.linspace(-2, 1.5, 15)):
            for at in np.quantile(s, np.linspace(0.02, 0.98, 49)):
                z = scale * (s - at)
                loss = (w * np.logaddexp(0, np.where(y == 1, -z, z))).mean()
                if best is None or loss < best[0]:
                    best = (loss, scale, -scale * at)
        self.scale, self.shift = float(best[1]), float(best[2])

    def sent(self):
        """What scoring needs: a number per bucket, and the document's terms."""
        w = self.u[:, 1] - self.u[:, 0]
        return (self.e @ w * GAIN).astype(np.float64), float(self.b[1] - self.b[0]), self.scale, self.shift, self.constant


def _argmax(s: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each document the place of its highest window, of equal ones the first; windows are ordered by document."""
    at = np.flatnonzero(s == np.maximum.reduceat(s, first)[doc])
    return at[np.r_[True, np.diff(doc[at]) > 0]]


class Words(dict):
    """Margins of words, worked out for many new words at once and kept for repeated ones."""

    def __init__(self, grams: np.ndarray, most: int = 300_000):
        super().__init__()
        self.grams, self.most = grams, most

    def learn(self, words: set[bytes]) -> None:
        if len(self) > self.most:
            self.clear()
        new = [w for w in words if w not in self]
        inner = [core(w) for w in new]
        place = {w: i for i, w in enumerate(dict.fromkeys(inner))}
        gram, of = subwords(list(place))
        mean = (np.bincount(of, weights=self.grams[gram]) / np.maximum(np.bincount(of), 1)).tolist()
        self.update(zip(new, [mean[place[x]] for x in inner], strict=True))


def highest(words: np.ndarray) -> float:
    """The greatest sum of `SPAN` values in a row, or of all if there are no more."""
    if len(words) <= SPAN:
        return float(words.sum())
    total = np.r_[0.0, np.cumsum(words)]
    return float((total[SPAN:] - total[:-SPAN]).max())


def _score(sent, keep):
    def go(batches):
        grams, bias, scale, shift, constant = sent.value
        cache = Words(grams)
        for b in batches:
            out, texts = [], raw(b, "text")
            for lo, hi in runs(texts):
                if constant is not None:
                    out += [constant] * (hi - lo)
                    continue
                split = [words_of(x) if x else [] for x in texts[lo:hi]]
                cache.learn(set().union(*split))
                for words in split:
                    top = highest(np.fromiter(map(cache.__getitem__, words), np.float64, len(words))) / SPAN
                    out.append(float(1 / (1 + np.exp(-np.clip(scale * (top + bias) + shift, -40, 40)))))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(out, pa.float64())], [*keep, "score"])
    return go


def learned_from(docs: DataFrame, labels: DataFrame, sample: dict[int, int], most_one: int = MOST_ONE, most_all: int = MOST_ALL) -> list[tuple[int, str, int]]:
    """(doc_id, text, label) of the labelled sample, whole texts: those with the least hash of the id that come to
    `most_all` bytes together. Texts over `most_one` bytes teach nothing."""
    rows = stored(labelled_sample(docs, labels, "toxic", sample).select(F.xxhash64("doc_id").alias("h"), "doc_id", "text", "label"), "sample")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = rows.where(size <= most_one)
    held, last = 0, None
    for r in sorted(rows.select("h", size.alias("size")).collect()):  # numbers of some thousand rows
        held += r["size"]
        if held > most_all:
            rows = rows.where(F.col("h") <= last) if last is not None else rows.limit(0)
            break
        last = r.h
    return sorted((r.doc_id, r.text or "", r.label) for r in rows.collect())


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: dict[int, int] = SAMPLE) -> DataFrame:
    """The columns of `docs` (less any named score, held_out, predicted) and held_out, score (0 to 1, the model's
    probability of label 1), predicted (1 at `threshold` or above).

    Labels come only from rows outside fold 0 of five, at most `sample` rows of each label value and `MOST_ALL` bytes
    of text (none of a text over `MOST_ONE`); doc_id, lang, source and labels are never inputs of a score. Null, empty and blank texts have an empty window and get its score.
    Without labels of both kinds every score is the labels' share (0.5 without any). Repeated rows are scored each;
    a null doc_id is not held out. An empty table gives an empty table."""
    spark = docs.sparkSession
    docs = docs.drop("score", "held_out", "predicted")
    rows = learned_from(docs, labels, sample)
    model = Model([r[1].encode() for r in rows], np.array([r[2] for r in rows], np.float64))
    given = plainly(docs)
    out = given.mapInArrow(_score(spark.sparkContext.broadcast(model.sent()), given.columns), f"{spelled(given)}, score double").toDF(*docs.columns, "score")
    return out.withColumns({"held_out": held_out(5), "predicted": (F.col("score") >= threshold).cast("int")})


def query(spark, sf_dir):
    out = toxicity_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


ORACLE_SQL = None
