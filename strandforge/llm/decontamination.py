"""Benchmark decontamination by template canonicalisation.

Words become typed placeholders where a question can be re-parameterised: numbers (in digits or spelled out), units
(short ones only behind a number), and names (capitalised words other than function words, wherever they stand).
Windows of template words of the benchmark are hash-joined with those of the documents; a window with hardly any plain
word in it is told by its words as they are. Windows that agree on one alignment of item and document, or on nearby
ones (words were inserted or left out between them), are counted, and the fillers of the placeholders inside these
windows are compared: one filler of the item must always stand against one filler of the document. Equal fillers
throughout are a verbatim copy, a consistent renaming is a re-parameterised one, anything else is chance.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grams, raw, runs, signed, span_hashes, spans, table

#: Unit words that become a placeholder; those of one or two letters only behind a number.
UNITS = frozenset(
    b"mm cm m km in ft yd mi g kg mg lb lbs oz t s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks "
    b"month months year years l ml litre litres liter liters gallon gallons km/h mph percent % dollar dollars cent cents euro euros usd eur".split()
)
#: Numbers spelled out.
SPELLED = frozenset(
    b"zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    b"twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split()
)
#: Words that are no names though they begin with a capital letter, as at a sentence's start.
PLAIN = frozenset(
    b"a about after all also an and any are as at be because before but by can could did do does each every find for from give given had has "
    b"have he her here his how i if in into is it its let may more most much my no not now of on one only or other our she should show since "
    b"so some such than that the their them then there these they this those to two under until up use was we were what when where which "
    b"while who whose why will with would you your".split()
)
NUMBER, NAME, UNIT = b"\x00number", b"\x00name", b"\x00unit"
#: Benchmark windows up to this number (8 bytes each, and their items) are sent to every executor; more are joined by a shuffle.
MOST_SENT = 500_000
#: Nothing taken is given back, so a word is read once however long its runs are.
_NUMBER = re.compile(rb"[^\w%]*+\d[\d.,:/]*+([A-Za-z%/]*+)[^\w%]*+$")
_STRIP = b".,;:!?()[]{}\"'`"
SIZE = 8
#: Windows with fewer plain words are compared as they are.
LEAST_PLAIN = 3
#: Alignments so many words apart count together. A verbatim run of so many windows (13 words) is a copied passage;
#: agreeing windows that hold so large a part of an item's words are a copy.
DRIFT, RUN, COVERED = 8, 6, 0.8


def kind(word: bytes) -> tuple[bytes, bool]:
    """The word's template, a placeholder or its lower case, and whether it is a unit only behind a number."""
    core = word.strip(_STRIP)
    low = core.decode("utf-8", "replace").lower()
    told = low.encode()
    number = _NUMBER.match(word)
    if number and (not number[1] or number[1].lower() in UNITS) or told in SPELLED or all(x in SPELLED for x in told.split(b"-")):
        return NUMBER, False
    if told in UNITS:
        return (UNIT, False) if len(told) > 2 else (told, True)
    text = core.decode("utf-8", "replace")
    if len(text) > 1 and text[0].isupper() and not text.isupper() and told not in PLAIN:
        return NAME, False
    return told, False


def _flags(marks: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(marks)] = True
    return out


_OUTER, _DIGIT, _LOW, _UP = _flags(_STRIP), _flags(b"0123456789"), _flags(b"abcdefghijklmnopqrstuvwxyz"), _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Words with such bytes are looked at one by one.
_ODD = _DIGIT | _flags(b"-") | (np.arange(256) > 127)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[_UP] += 32


def _hashes(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    size = np.array([len(x) for x in words])
    end = np.cumsum(size + 1) - 1
    return span_hashes(data, end - size, end)


_NUMBER_HASH, _NAME_HASH, _UNIT_HASH = _hashes([NUMBER, NAME, UNIT])


class Known:
    """Finds hashes in a sorted table; a mark for their first 16 bits spares most of the searches."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.marks = np.zeros(1 << 16, bool)
        self.marks[hashes >> np.uint64(48)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `h` are in the table, and the first place of each there."""
        at = np.flatnonzero(self.marks[h >> np.uint64(48)])
        place = np.searchsorted(self.hashes, h[at], "left")
        ok = self.hashes[np.minimum(place, len(self.hashes) - 1)] == h[at] if len(self.hashes) else np.zeros(0, bool)
        return at[ok], place[ok]


#: Words up to so many bytes are remembered.
REMEMBERED = 64
_SPELLED, _UNIT, _SHORT, _PLAIN = 1, 2, 3, 4
_WORDS = sorted([(x, _SPELLED) for x in SPELLED] + [(x, _UNIT if len(x) > 2 else _SHORT) for x in UNITS - SPELLED] + [(x, _PLAIN) for x in PLAIN - UNITS - SPELLED])
_ORDER = np.argsort(_hashes([x for x, _ in _WORDS]))
_LISTED, _LISTED_AS = Known(_hashes([x for x, _ in _WORDS])[_ORDER]), np.array([k for _, k in _WORDS], np.int8)[_ORDER]


class Told:
    """The words of some texts, one text after the other: hashes of their templates, which are placeholders, hashes of
    the words as they are, and of each text the number of words. `kind` says the same of one word; what it said of
    words with digits, hyphens or letters beyond ASCII is kept in `seen`."""

    def __init__(self, texts: list[bytes | None], seen: dict | None = None):
        data = np.frombuffer(b"\n".join(x or b"" for x in texts), np.uint8)
        start, end = spans(data)
        size = np.array([len(x) + 1 if x else 1 for x in texts], np.int64)
        self.count = np.diff(np.searchsorted(start, np.cumsum(size)), prepend=0)
        self.whole = (data, start, end)
        # to the next byte that is no punctuation, and to the one before the end
        place, outer = np.arange(len(data)), _OUTER[data]
        first = np.minimum(np.minimum.accumulate(np.where(outer, len(data), place)[::-1])[::-1][start], end) if len(start) else start
        last = np.maximum(np.maximum.accumulate(np.where(outer, -1, place))[end - 1] + 1, first) if len(start) else end
        self.first, self.last = first, last
        h, listed = span_hashes(_LOWER[data], first, last), np.zeros(len(start), np.int8)
        at, place = _LISTED.find(h)
        listed[at] = _LISTED_AS[place]
        number, unit, short, name = listed == _SPELLED, listed == _UNIT, listed == _SHORT, np.zeros(len(start), bool)
        if len(data):
            capital = np.flatnonzero(_UP[data[np.minimum(first, len(data) - 1)]] & (last - first > 1) & (listed == 0))
            lower = np.r_[0, np.cumsum(_LOW[data], dtype=np.int32)]
            name[capital[lower[last[capital]] > lower[first[capital]]]] = True
        beyond = np.r_[0, np.cumsum(_ODD[data], dtype=np.int32)]
        odd = np.flatnonzero(beyond[end] > beyond[start])
        if len(odd):
            seen, text = {} if seen is None else seen, data.tobytes()
            if len(seen) > 200_000:
                seen.clear()
            _, one, which = np.unique(span_hashes(data, start[odd], end[odd]), return_index=True, return_inverse=True)
            told = []
            for a, b in zip(start[odd[one]].tolist(), end[odd[one]].tolist(), strict=True):
                word = text[a:b]
                what = seen.get(word)
                if what is None:
                    what = kind(word)
                    if len(word) <= REMEMBERED:
                        seen[word] = what
                told.append(what)
            place = {NUMBER: 0, UNIT: 1, NAME: 2}
            kinds = np.array([place.get(x, 3) for x, _ in told])[which]
            number[odd], unit[odd], name[odd] = kinds == 0, kinds == 1, kinds == 2
            short[odd] = np.array([x for _, x in told])[which]
            h[odd] = _hashes([x for x, _ in told])[which]
        h[number], h[unit], h[name] = _NUMBER_HASH, _UNIT_HASH, _NAME_HASH
        behind = np.r_[False, number[:-1]] & short if len(h) else short
        behind[(np.cumsum(self.count) - self.count)[self.count > 0]] = False  # the first word of a text is behind nothing
        h[behind] = _UNIT_HASH
        self.h, self.slots = h, number | unit | name | behind

    def exact(self) -> np.ndarray:
        return span_hashes(self.whole[0], self.first, self.last) ^ np.uint64(1)

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows of `size` words; those that reach from one text into another are among them."""
        out = grams(self.h, size)
        if len(out):
            held = np.r_[0, np.cumsum(~self.slots)]
            few = np.flatnonzero(held[size:] - held[:-size] < LEAST_PLAIN)
            if len(few):
                out[few] = grams(self.exact(), size)[few]
        return out


class Items:
    """The benchmark's windows: sorted hashes, and for each the (item, position) where it stands."""

    def __init__(self, state: tuple):
        self.ids, self.words, self.slots, self.count, self.by_size = state
        self.known = {size: Known(x[0]) for size, x in self.by_size.items()}

    @staticmethod
    def state(rows: list[tuple[int | None, bytes | None]]) -> tuple:
        """Lists and arrays only, so that executors need not know this class to receive them."""
        ids, all_words, all_slots, count, places = [], [], [], [], []
        for item, text in rows:
            words = text.split() if text else []
            if not words:
                continue
            told = Told([text])
            size = min(SIZE, len(words))
            for p, x in enumerate(told.windows(size).tolist()):
                places.append((size, x, len(ids), p))
            ids.append(item)
            all_words.append(words)
            all_slots.append(told.slots)
            count.append(len(words) - size + 1)
        by_size = {}
        for size in sorted({x[0] for x in places}):
            own = sorted(x[1:] for x in places if x[0] == size)
            by_size[size] = (np.array([x[0] for x in own], np.uint64), np.array([x[1] for x in own]), np.array([x[2] for x in own]))
        return ids, all_words, all_slots, count, by_size

    def alignments(self, told: Told) -> dict[int, dict[int, dict[int, list[int]]]]:
        """text -> item -> position in the text of the item's first word -> the item's windows that agree there."""
        out: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
        ends = np.cumsum(told.count)
        for size, (known, item, at) in self.by_size.items():
            g = told.windows(size)
            if not len(g):
                continue
            hits, first = self.known[size].find(g)
            text = np.searchsorted(ends, hits, "right")
            inside = hits + size <= ends[text]
            for p, d, k in zip(hits[inside].tolist(), text[inside].tolist(), first[inside].tolist(), strict=True):
                begin = int(ends[d] - told.count[d])
                while k < len(known) and known[k] == g[p]:
                    out[d][int(item[k])][p - begin - int(at[k])].append(int(at[k]))
                    k += 1
        return out

    def chain(self, by: dict[int, list[int]], base: int, drift: int) -> dict[int, int]:
        """window of the item -> the alignment nearest to `base`, at most `drift` off, where it agrees."""
        out: dict[int, int] = {}
        for o in sorted((o for o in range(base - drift, base + drift + 1) if o in by), key=lambda o: abs(o - base)):
            for a in by[o]:
                out.setdefault(a, o)
        return out

    def enough(self, item: int, at: dict[int, int], share: float) -> str | None:
        """Whether the windows tell a copy (whole), a passage if it is verbatim (part), or nothing."""
        size = len(self.words[item]) - self.count[item] + 1
        if len(at) >= share * self.count[item]:
            return "whole"
        held = {a + k for a in at for k in range(size)}
        if len(at) > 1 and len(held) >= COVERED * len(self.words[item]):
            return "whole"
        run = 0
        for a in sorted(at):
            run = run + 1 if run and at.get(a - 1) == at[a] else 1
            if run >= RUN:
                return "part"
        return None

    def judged(self, item: int, at: dict[int, int], words: list[bytes]) -> tuple[str, int] | None:
        """verbatim or renamed, and the number of slots compared, all inside windows that agree; None where the fillers
        contradict each other."""
        size = len(self.words[item]) - self.count[item] + 1
        own, there, back, same = self.words[item], {}, {}, True
        pairs: dict[int, int] = {}
        for a, offset in sorted(at.items()):
            for p in range(a, a + size):
                if self.slots[item][p]:
                    pairs.setdefault(p, p + offset)
        for p, q in pairs.items():
            a, b = own[p].strip(_STRIP), words[q].strip(_STRIP)
            same &= a == b
            if there.setdefault(a, b) != b or back.setdefault(b, a) != a:
                return None
        return ("verbatim" if same else "renamed"), len(pairs)

    def best(self, item: int, by: dict[int, list[int]], words: list[bytes], share: float):
        """(windows, kind, slots) of the most windows that tell a copy: over nearby alignments, else at one."""
        if len({a for own in by.values() for a in own}) < min(2, share * self.count[item]):
            return None
        for drift in (DRIFT, 0):
            sizes = sorted(((len(self.chain(by, o, drift)), -o) for o in by), reverse=True)
            for n, base in sizes:
                at = self.chain(by, -base, drift)
                how = self.enough(item, at, share)
                if how and (got := self.judged(item, at, words)) and (how == "whole" or got[0] == "verbatim"):
                    return at, *got
        return None


SCHEMA = "doc_id long, item_id long, n_windows long, share double, kind string, n_slots long, first_word long, last_word long"


def _found(items: Items, share: float):
    def of(doc_id, words, hits):
        for item, by in sorted(hits.items()):
            if got := items.best(item, by, words, share):
                at, kind, n_slots = got
                size = len(items.words[item]) - items.count[item] + 1
                places = [a + o for a, o in at.items()]
                yield doc_id, items.ids[item], len(at), len(at) / items.count[item], kind, n_slots, min(places), max(places) + size - 1
    return of


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _sent(items, share):
    def go(batches):
        own, seen = Items(items.value), {}
        of = _found(own, share)
        for b in batches:
            rows, texts, ids = [], raw(b, "text"), b.column("doc_id").to_pylist()
            for lo, hi in runs(texts):
                for d, hits in sorted(own.alignments(Told(texts[lo:hi], seen)).items()):
                    rows += of(ids[lo + d], texts[lo + d].split(), hits)
            yield _batch(rows)
    return go


def _all_windows(sizes: list[int]):
    def go(batches):
        seen: dict = {}
        for b in batches:
            key, texts = [b.column(c).to_numpy() for c in ("_k", "_t")], raw(b, "text")
            for lo, hi in runs(texts):
                told = Told(texts[lo:hi], seen)
                text = np.repeat(np.arange(hi - lo), told.count)
                place = np.arange(len(text)) - np.repeat(np.cumsum(told.count) - told.count, told.count)
                for size in sizes:
                    g = signed(told.windows(size))
                    own = np.flatnonzero(text[: len(g)] == text[size - 1:]) if len(g) else np.empty(0, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (g[own], np.full(len(own), size, np.int32), *[k[lo + text[own]] for k in key], place[own].astype(np.int32))], ["h", "size", "_k", "_t", "p"])
    return go


def _pair(share: float):
    """Judges candidate pairs that carry both texts; each text and each item of some pairs is taken apart once."""
    def go(batches):
        for b in batches:
            doc_ids, texts, item_ids, items = b.column("doc_id").to_pylist(), raw(b, "text"), b.column("item_id").to_pylist(), raw(b, "item")
            for lo, hi in runs(texts):
                at = {x: i for i, x in enumerate(dict.fromkeys(texts[lo:hi]))}
                which = {x: i for i, x in enumerate(dict.fromkeys(items[lo:hi]))}
                own = Items(Items.state([(i, x) for x, i in which.items()]))
                place = {i: k for k, i in enumerate(own.ids)}
                hits, words, rows, of = own.alignments(Told(list(at))), {}, [], _found(own, share)
                for k in range(lo, hi):
                    t, i = at[texts[k]], place[which[items[k]]]
                    if by := hits.get(t, {}).get(i):
                        if t not in words:
                            words[t] = texts[k].split()
                        rows += [(doc_ids[k], item_ids[k], *r[2:]) for r in of(doc_ids[k], words[t], {i: by})]
                yield _batch(rows)
    return go


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.5, most_sent: int = MOST_SENT) -> DataFrame:
    """A row per document and benchmark item found in it: doc_id, item_id, n_windows (template windows that agree at
    one alignment or nearby ones), share (of the item's windows), kind (verbatim or renamed), n_slots (placeholders
    compared), first_word and last_word (of these windows). `share` of an item's windows must agree, or windows that
    hold four fifths of its words, or 13 words on end be copied verbatim; items under eight words must agree whole. Null and empty texts match nothing; a null doc_id or item_id is returned as null. Equal document rows are
    each returned; equal items too. Other columns are ignored; without documents or items the result is empty."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.size(F.split("text", r"[ \t-\r]+")))).first()[0] or 0  # bounds the windows from above
    if size <= most_sent:
        sent = spark.sparkContext.broadcast(Items.state([(r.item_id, r.text.encode()) for r in items.collect()]))
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sent(sent, share), SCHEMA)
    # a benchmark of unknown size: the same windows of distinct texts, joined by a shuffle; then all rows with these texts
    text_key = lambda df: df.withColumns({"_k": F.xxhash64(F.lit(1), "text"), "_t": F.xxhash64("text", F.length("text"))})
    of_items = text_key(items.select(F.col("item_id").cast("long").alias("item_id"), "text"))
    of_items = of_items.withColumn("words", F.size(F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != ""))).where("words > 0").withColumn("size", F.least(F.lit(SIZE), "words"))
    one_each = of_items.dropDuplicates(["_k", "_t"])
    theirs = one_each.mapInArrow(_all_windows(list(range(1, SIZE + 1))), "h long, size int, _k long, _t long, p int")
    theirs = theirs.join(one_each.select("_k", "_t", "size", (F.col("words") - F.col("size") + 1).alias("count")), ["_k", "_t", "size"])
    sizes = [r.size for r in of_items.select("size").distinct().collect()]  # eight values at most
    rows = text_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null"))
    ours = rows.dropDuplicates(["_k", "_t"]).mapInArrow(_all_windows(sizes), "h long, size int, _k long, _t long, p int")
    hits = ours.join(theirs.select("h", "size", "count", F.col("_k").alias("i"), F.col("_t").alias("it"), F.col("p").alias("q")), ["h", "size"])
    hits = hits.groupBy("_k", "_t", "i", "it").agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("count"))
    hits = hits.where(F.col("n") >= F.least(F.lit(2), share * F.col("count"))).select("_k", "_t", "i", "it")
    both = hits.join(rows, ["_k", "_t"]).join(of_items.select(F.col("_k").alias("i"), F.col("_t").alias("it"), "item_id", F.col("text").alias("item")), ["i", "it"])
    return both.select("doc_id", "text", "item_id", "item").mapInArrow(_pair(share), SCHEMA)


def query(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = None
