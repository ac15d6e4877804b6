"""Substring dedup by level-wise doubling.

Every window of `base` words that can anchor a window of twice that length is counted over the corpus; only
the windows repeated at this length are extended to twice the length, the survivors again, until the asked
length is reached (or, in `repeat_levels`, until no candidate survives).

At the first length not all positions are shuffled. Each window of 2*base words holds base+1 windows of base
words; the one with the least hash is its anchor. Equal long windows have equal anchors, so counting anchors
loses no repeat and moves about a sixth of the positions. Windows of one document that share an anchor form a
run. Equal runs (same content around the anchor) are settled run by run; only the first of each distinct run,
and only where an anchor has several distinct runs, is taken apart into its single windows.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, KEY_SCHEMA, grams, hashed, joined, key_of, keyed, least_places, mixed, raw, runs, signed, stored


def anchored(h: np.ndarray, doc: np.ndarray, base: int):
    """Anchors of the windows of 2*base words of documents that lie one after the other: (document, hash, run's hash,
    position among all words, first start, last start)."""
    n = len(h) - 2 * base + 1
    if n <= 0:
        return None
    inside = np.flatnonzero(doc[:n] == doc[2 * base - 1:])  # no window reaches into another document
    if not len(inside):
        return None
    short = grams(h, base)
    long = joined(short[:n], short[base: base + n])[inside]
    at = least_places(short, base + 1)[inside]
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)])
    size = np.diff(np.r_[first, len(at)])
    p, lo = at[first], inside[first]
    # a run's content is told by its windows: their first, last and number, and a sum that depends on the order
    order = mixed(np.arange(base + 1, dtype=np.uint64)) | np.uint64(1)  # a run has base + 1 windows at most
    total = np.add.reduceat(long * order[np.arange(len(long)) - np.repeat(first, size)], first)
    run = mixed(total + mixed((p - lo).astype(np.uint64)) + (size - 1).astype(np.uint64))
    return doc[lo], short[p], run, p, lo, lo + size - 1


def _anchors(base: int):
    def go(batches):
        for b in batches:
            key, texts = key_of(b), raw(b, "text")
            for lo, hi in runs(texts):
                h, size = hashed(texts[lo:hi])
                if got := anchored(h, np.repeat(np.arange(hi - lo), size), base):
                    doc, anchor, run, p, first, last = got
                    begin = (np.cumsum(size) - size)[doc]
                    places = [(x - begin).astype(np.int32) for x in (p, first, last)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (signed(anchor), signed(run), *[k[lo + doc] for k in key], *places)], ["h", "run", *KEY, "p", "lo", "hi"])
    return go


ANCHORS = f"h long, run long, {KEY_SCHEMA}, p int, lo int, hi int"


def _ranges(column: pa.ListArray, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """A column of lists of structs without building them: where each row's list begins (and the last ends), and the
    fields of all."""
    at, inner = column.offsets.to_numpy(), column.values
    return at, [inner.field(n).to_numpy(zero_copy_only=False) for n in names]


def _windows(base: int):
    """The single windows of the runs that must be taken apart."""
    def go(batches):
        for b in batches:
            key, texts = key_of(b), raw(b, "text")
            at, (anchors, firsts, lasts) = _ranges(b.column("spans"), "h", "lo", "hi")
            for lo, hi in runs(texts):
                h, size = hashed(texts[lo:hi])
                begin, long, own = np.cumsum(size) - size, signed(grams(h, 2 * base)), slice(at[lo], at[hi])
                n = (lasts[own] - firsts[own] + 1).astype(np.int64)
                doc = np.repeat(np.repeat(np.arange(lo, hi), np.diff(at[lo: hi + 1])), n)
                place = np.repeat(firsts[own].astype(np.int64), n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(anchors[own], n), long[begin[doc - lo] + place], *[k[doc] for k in key], place.astype(np.int32))], ["h", "w", *KEY, "lo"])
    return go


def _cut(size: int):
    def go(batches):
        for b in batches:
            texts = raw(b, "text")
            at, (firsts, lasts) = _ranges(b.column("gone"), "lo", "hi")
            for lo, hi in runs(texts, 1 << 22):
                n_words, n_removed, kept, first, last, held = [], [], [], [], [], [0]
                for i in range(lo, hi):
                    words = texts[i].split() if texts[i] else []
                    n_words.append(len(words))
                    if at[i] < at[i + 1]:
                        own = slice(at[i], at[i + 1])
                        edge = np.bincount(firsts[own], minlength=len(words) + 1) - np.bincount(np.minimum(lasts[own] + size, len(words)), minlength=len(words) + 1)
                        stays = np.cumsum(edge[:-1]) == 0
                        flips = np.flatnonzero(np.diff(np.r_[True, stays, True]))
                        first.append(flips[::2])
                        last.append(flips[1::2] - 1)
                        n_removed.append(len(words) - int(np.count_nonzero(stays)))
                        words = list(compress(words, stays.tolist()))
                    else:
                        n_removed.append(0)
                    held.append(held[-1] + (len(first[-1]) if at[i] < at[i + 1] else 0))
                    kept.append(b" ".join(words))
                spans = [pa.array(np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int32)) for x in (first, last)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo).cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                     pa.ListArray.from_arrays(pa.array(held, pa.int32()), pa.StructArray.from_arrays(spans, ["first", "last"]))],
                    ["doc_id", "n_words", "n_removed", "kept_text", "removed_spans"],
                )
    return go


def repeated_windows(docs: DataFrame, window: int = 20) -> DataFrame:
    """(key, lo, hi): starts of windows whose words also start earlier, as ranges of starts."""
    base = window // 2
    found = keyed(docs).select(*KEY, "text").mapInArrow(_anchors(base), ANCHORS)
    # level 1: anchors seen twice; partial sums before the shuffle
    often = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("r0"), F.max("run").alias("r1")).where("n > 1")
    often = stored(often, "often")  # a plain table on this side lets Spark split a hot anchor in the join
    again = stored(found.join(often, "h").select("h", "run", *KEY, "p", "lo", "hi", (F.col("r0") != F.col("r1")).alias("several")), "runs")
    # level 2, run by run
    at = F.struct(*KEY, "p")
    firsts = stored(again.groupBy("h", "run").agg(F.min(at).alias("first")), "firsts")
    told = again.join(firsts, ["h", "run"])
    whole = told.where(at != F.col("first")).select(*KEY, "lo", "hi")
    apart = told.where(F.col("several") & (at == F.col("first"))).groupBy(*KEY).agg(F.collect_set(F.struct("h", "lo", "hi")).alias("spans"))
    texts = keyed(docs).select(*KEY, "text").where("text is not null")
    single = texts.join(apart, KEY).mapInArrow(_windows(base), f"h long, w long, {KEY_SCHEMA}, lo int")
    single = stored(single.dropDuplicates(["h", "w", *KEY, "lo"]), "windows")
    start = F.struct(*KEY, "lo")
    # a plain table again, so that a passage in very many contexts can be split
    earliest = stored(single.groupBy("h", "w").agg(F.count(F.lit(1)).alias("n"), F.min(start).alias("first")).where("n > 1").drop("n"), "earliest")
    late = single.join(earliest, ["h", "w"]).where(start != F.col("first")).select(*KEY, "lo", F.col("lo").alias("hi"))
    return whole.unionByName(late)


def substring_dedup(docs: DataFrame, window: int = 20) -> DataFrame:
    """Removes each word covered by a `window`-word run that also starts earlier (smaller doc_id, or earlier in
    the document). `window` must be even. Returns per row doc_id, n_words, n_removed, kept_text and removed_spans
    (first and last word index).

    Null or empty text: no words, empty kept_text. Null doc_id sorts before all others. Equal rows (same doc_id
    and text) count as one document; of rows that share a doc_id but not the text, a hash of the text decides
    the order. Texts shorter than the window are kept whole. Further columns are ignored. An empty table gives
    an empty table."""
    if window < 2 or window % 2:
        raise ValueError("window must be even")
    gone = repeated_windows(docs, window).groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("gone"))
    return keyed(docs).join(gone, KEY, "left").select("doc_id", "text", "gone").mapInArrow(
        _cut(window), "doc_id long, n_words long, n_removed long, kept_text string, removed_spans array<struct<first:int,last:int>>"
    )


def _starts(length: int):
    """Hashes of the windows of `length` words at the given starts (null: at all)."""
    def go(batches):
        for b in batches:
            key, texts, pos = key_of(b), raw(b, "text"), b.column("pos").to_pylist()
            for lo, hi in runs(texts):
                h, size = hashed(texts[lo:hi])
                every, at, doc, starts = signed(grams(h, length)), 0, [], []
                for i, n in zip(range(lo, hi), size.tolist(), strict=True):
                    own = np.arange(max(0, n - length + 1)) if pos[i] is None else np.array([x for x in pos[i] if x <= n - length], np.int64)
                    doc.append(np.full(len(own), i))
                    starts.append((own, own + at))
                    at += n
                doc, own, place = np.concatenate(doc), *(np.concatenate(x) for x in zip(*starts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (every[place], *[k[doc] for k in key], own.astype(np.int32))], ["h", *KEY, "p"])
    return go


def repeat_levels(docs: DataFrame, base: int = 10) -> DataFrame:
    """Per document with a repeat: the longest doubled length (2*base, 4*base, ...) at which a window of it occurs
    twice in the corpus. Each level looks only at starts that survived the last, and it ends when none survives."""
    texts = keyed(docs).select(*KEY, "doc_id", "text").where("text is not null").dropDuplicates(KEY)
    length, alive, best = 2 * base, None, None
    while True:
        given = texts.withColumn("pos", F.lit(None).cast("array<int>")) if alive is None else texts.join(alive, KEY)
        found = given.select(*KEY, "text", "pos").mapInArrow(_starts(length), f"h long, {KEY_SCHEMA}, p int")
        often = stored(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "often")
        alive = stored(found.join(often, "h").groupBy(*KEY).agg(F.collect_list("p").alias("pos")), "level")
        if alive.isEmpty():
            break
        here = alive.select(*KEY, F.lit(length).alias("longest"))
        best = here if best is None else best.unionByName(here)
        length *= 2
    if best is None:
        return texts.select("doc_id", F.lit(0).alias("longest")).limit(0)
    return texts.join(best.groupBy(*KEY).agg(F.max("longest").alias("longest")), KEY).select("doc_id", "longest")


def query(spark, sf_dir):
    from .common import table

    out = substring_dedup(table(spark, sf_dir, "documents"), 20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256"))


ORACLE_SQL = None
