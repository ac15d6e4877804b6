"""Best-fit packing of tokenized documents by bin completion.

Sequences are bins of a fixed number of tokens, so all there is to know of a corpus before packing is how many pieces
have each length: a row per length, however many documents there are. Branch and bound runs over that histogram. Around
the largest piece left it enumerates the fillings that no other filling dominates, applies one as often as the counts
allow (or once), and goes on; branches are cut by the waste that the best solution so far still allows and by a lower
bound on the rest, and best fit completes every node to a solution that may become the incumbent. What comes out is a
list of patterns with multiplicities. Spark tokenizes, numbers the pieces of each length and gives each number its
place in a pattern; no table of documents or sequences is ever in one task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import pieces, stored, table

CAPACITY, END = 1024, 2
#: Nodes that branch and bound visits, and fillings it looks at, before it keeps the best solution found (some seconds at most).
NODES, LOOKS = 5_000, 300_000
#: Characters encoded at once, and white space in one run that the fast encoder is not given.
STRETCH, BLANK = 1 << 18, 4_096

#: The white space of the tokenizers' patterns (Unicode's White_Space).
_WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_CUT = re.compile(f"[^{_WHITE}](?=[{_WHITE}])")
_LONG = re.compile(f"[{_WHITE}]{{{BLANK},}}")
#: Fixed value: the pattern by which byte-level tokenizers split a text.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Ids:
    """A tokenizer file's ids of texts, as little-endian uint32. Where the file is a plain byte-level BPE whose merges are
    in the order of their ids, `tiktoken` encodes from the same vocabulary, with the same ids and several times as fast;
    what that cannot take, and all of any other tokenizer, goes through `tokenizers`."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.fast, self.special = Tokenizer.from_file(path), *_ranked(path)

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: str, most: int = STRETCH) -> bytes:
        """Long texts are taken a stretch at a time: no token holds white space behind something else, so a text may be
        cut there."""
        if self.fast is None:
            return self.plain(text)
        out, lo = [], 0
        while lo < len(text):
            hi = len(text)
            if hi - lo > most and (cut := _CUT.search(text, lo + most)):
                hi = cut.end()
            part = text[lo:hi] if lo or hi < len(text) else text
            if _LONG.search(part):
                out.append(self.plain(part))
            else:
                out.append(self.fast.encode_to_numpy(part, allowed_special=self.special, disallowed_special=()).astype("<u4").tobytes())
            lo = hi
        return out[0] if len(out) == 1 else b"".join(out)


def _ranked(path: str):
    """A tokenizer file as (encoding by ranks, special tokens), or (None, none) if it is of another kind."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, before = told["model"], told.get("pre_tokenizer") or {}
    vocab = model.get("vocab")
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    added = {x["content"]: x["id"] for x in told.get("added_tokens", [])}
    odd = [x for x in told.get("added_tokens", []) if x["single_word"] or x["lstrip"] or x["rstrip"]]
    made = [vocab.get("".join(m), -1) for m in merges] if isinstance(vocab, dict) else [-1]
    plain = model.get("type") in ("BPE", None) and told.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space", True) and before.get("use_regex", True)
    if not plain or odd or model.get("dropout") or model.get("ignore_merges") or min(made) < 256 or made != sorted(made):
        return None, set()
    # bytes stand for themselves where they print, else for the letters from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in own)}
    ranks = {bytes(letter[c] for c in t): i for t, i in vocab.items() if t not in added}
    return tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=added), set(added)


@lru_cache(maxsize=1)
def _ids(path: str) -> Ids:
    """Kept from task to task in a worker."""
    return Ids(path)


_TOKENIZED = "doc_id {}, piece int, start long, length int, ids binary, _p int, _r long"


def _tokenized(path: str, capacity: int, end: int):
    """Pieces with their ids, the task's number, and each piece's number among those of its length in this task."""
    def go(batches):
        ids, task, seen = _ids(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        last = np.array([end], "<u4").tobytes()
        for b in batches:
            lo = 0
            for texts in pieces(b, "text"):
                rows = [[], [], [], [], [], []]
                for i, text in enumerate(texts, lo):
                    found = (ids.of(text.decode("utf-8", "replace")) if text else b"") + last
                    n, at, k = len(found) // 4, 0, 0
                    size = n % capacity or capacity
                    while at < n:
                        for column, x in zip(rows, (i, k, at, size, found[4 * at: 4 * (at + size)], int(seen[size])), strict=True):
                            column.append(x)
                        seen[size] += 1
                        at, k, size = at + size, k + 1, capacity
                lo += len(texts)
                row, piece, start, length, data, number = rows
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(data, pa.binary()), pa.array([task] * len(row), pa.int32()), pa.array(number, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids", "_p", "_r"])
    return go


# ---- patterns over a histogram: counts[x] pieces of length x ----------------------------------------------------------

Pattern = tuple[int, dict[int, int]]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: for every k, pieces over capacity - k leave room for none of k and more, and those
    over half a bin stand alone; what is between fills the room beside the latter first."""
    x = np.arange(len(counts), dtype=np.int64)
    number, tokens = np.cumsum(counts), np.cumsum(counts * x)
    half, k = capacity // 2, np.arange(capacity // 2 + 1)
    alone = number[-1] - number[capacity - k]
    big = number[capacity - k] - number[half]
    room = big * capacity - (tokens[capacity - k] - tokens[half])
    below = np.where(k > 0, tokens[np.maximum(k - 1, 0)], 0)
    rest = tokens[half] - below
    return int((alone + big + np.maximum(0, -(-(rest - room) // capacity))).max())


def best_fit(counts: list[int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, of all pieces of a length at once: bins alike are one pattern with a multiplicity."""
    open_: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bits of the rooms that open bins have

    def put(room: int, times: int, held: dict[int, int]) -> None:
        nonlocal rooms
        open_[room].append((times, held))
        rooms |= 1 << room

    for x in range(capacity, 0, -1):
        n = counts[x]
        while n and (fit := rooms >> x):
            room = x + (fit & -fit).bit_length() - 1  # the least that is large enough
            times, held = open_[room].pop()
            if not open_[room]:
                rooms ^= 1 << room
            fits = room // x
            full = min(times, n // fits)
            if full:
                put(room - fits * x, full, {**held, x: fits})
                n, times = n - full * fits, times - full
            if times and n:  # one more takes what is left
                put(room - n * x, 1, {**held, x: n})
                n, times = 0, times - 1
            if times:
                put(room, times, held)
        fits = capacity // x
        if n >= fits:
            put(capacity - fits * x, n // fits, {x: fits})
        if n % fits:
            put(capacity - n % fits * x, 1, {x: n % fits})
    return [p for ps in open_ for p in ps]


def _bins(patterns: list[Pattern]) -> int:
    return sum(times for times, _ in patterns)


def undominated(counts: list[int], largest: int, capacity: int, waste: int, looks: list[int]) -> Iterator[dict[int, int]]:
    """Fillings of a bin around one piece of length `largest` that waste at most `waste`: those that waste least come
    first, of these the ones with the longest pieces.

    Left out are fillings that another one is never worse than: where a piece left outside fits in the place of one, two
    or three pieces inside that are no longer in sum. `looks[0]` counts down the steps taken."""
    room = capacity - largest
    if room and counts[room] - (room == largest):
        yield {largest: 2} if room == largest else {largest: 1, room: 1}
        return
    left = counts[:]
    left[largest] -= 1
    lengths = [x for x in range(min(room, largest), 0, -1) if left[x]]
    mask = sum(1 << x for x in lengths)
    # sums that the lengths from i on can make, were there enough of each
    within, reach = (2 << room) - 1, [1] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        sums, x = reach[i + 1], lengths[i]
        while (more := (sums | sums << x) & within) != sums:
            sums, x = more, 2 * x
        reach[i] = sums
    inside: list[int] = []

    def dominated(slack: int) -> bool:
        window = (2 << slack) - 1
        kinds = sorted(set(inside))
        free = mask
        for x in kinds:
            if inside.count(x) == left[x]:
                free ^= 1 << x
        if any(free >> (a + 1) & (window >> 1) for a in kinds):
            return True
        own = [x for x in kinds for _ in range(min(3, inside.count(x)))]
        if any(free >> s & window for s in {a + b for i, a in enumerate(own) for b in own[i + 1:]}):
            return True
        return len(own) <= 12 and any(free >> s & window for s in {a + b + c for i, a in enumerate(own) for j, b in enumerate(own[i + 1:], i + 1) for c in own[j + 1:]})

    def exactly(at: int, rest: int) -> Iterator[None]:
        """Leaves each choice of lengths from `at` on with the sum `rest` in `inside`, one after the other."""
        if not rest:
            yield
            return
        for i in range(at, len(lengths)):
            looks[0] -= 1
            if looks[0] < 0 or not reach[i] >> rest & 1:
                return
            x = lengths[i]
            if x <= rest and reach[i] >> (rest - x) & 1 and inside.count(x) < left[x]:
                inside.append(x)
                yield from exactly(i, rest - x)
                inside.pop()

    for slack in range(min(waste, room) + 1):
        for _ in exactly(0, room - slack):
            if not any(x <= slack and inside.count(x) < left[x] for x in lengths) and not dominated(slack):
                out = {largest: 1}
                for x in inside:
                    out[x] = out.get(x, 0) + 1
                yield out


def complete(counts: list[int], capacity: int, nodes: int = NODES, looks: int = LOOKS) -> tuple[list[Pattern], int]:
    """Patterns that hold every piece, and the lower bound on the number of bins; where both agree, or the search ends
    before `nodes` nodes and `looks` fillings, no packing has fewer bins."""
    bound = lower_bound(np.array(counts, np.int64), capacity)
    best = best_fit(counts, capacity)
    total, left = sum(x * n for x, n in enumerate(counts)), [looks]
    if _bins(best) == bound:
        return best, bound

    def fillings(rest: list[int], used: int, waste: int) -> Iterator[tuple[Pattern, list[int]]]:
        largest = next(x for x in range(capacity, 0, -1) if rest[x])
        # made one by one; the waste that is allowed may have shrunk when the next is asked for
        for f in undominated(rest, largest, capacity, (_bins(best) - 1) * capacity - total - waste, left):
            most = min(rest[x] // n for x, n in f.items())
            for times in dict.fromkeys((most, 1)):
                after = rest[:]
                for x, n in f.items():
                    after[x] -= times * n
                yield (times, f), after

    done: list[Pattern] = []
    levels = [(fillings(counts, 0, 0), 0, 0)]
    while levels and nodes > 0 and left[0] > 0 and _bins(best) > bound:
        made, used, waste = levels[-1]
        step = next(made, None)
        if step is None:
            levels.pop()
            if done:
                done.pop()
            continue
        nodes -= 1
        (times, f), rest = step
        used += times
        waste += times * (capacity - sum(x * n for x, n in f.items()))
        if used + lower_bound(np.array(rest, np.int64), capacity) >= _bins(best):
            continue
        tail = best_fit(rest, capacity)
        if used + _bins(tail) < _bins(best):
            best = [*done, (times, f), *tail]
        if any(rest):
            done.append((times, f))
            levels.append((fillings(rest, used, waste), used, waste))
    return best, bound


def _places(patterns: list[Pattern], capacity: int):
    """Tables for `_placed`: per length and pattern the first piece's number, the first bin's, pieces a bin, and where
    in the bin they begin."""
    begun, bin_, rows = [0] * (capacity + 1), 0, []
    for times, f in patterns:
        at = 0
        for x in sorted(f, reverse=True):
            rows.append((x, begun[x], bin_, f[x], at))
            begun[x] += times * f[x]
            at += x * f[x]
        bin_ += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(places: np.ndarray, capacity: int):
    shift = np.int64(62 - int(capacity).bit_length())
    keys = (places[:, 0] << shift) + places[:, 1]

    def go(batches):
        for b in batches:
            x, number = b.column("length").to_numpy().astype(np.int64), b.column("number").to_numpy()
            p = places[np.searchsorted(keys, (x << shift) + number, side="right") - 1]
            k = number - p[:, 1]
            out = [*[b.column(c) for c in ("doc_id", "piece", "start")], pa.array(x), b.column("ids"), pa.array(p[:, 2] + k // p[:, 3]), pa.array(p[:, 4] + k % p[:, 3] * x)]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])
    return go


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, nodes: int = NODES) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids (little-endian uint32), sequence_id, offset.

    A document is its ids and `end`. Longer ones than `capacity` are cut into pieces of that many tokens, of which the
    first may be shorter; others are one piece. Sequences hold pieces without gaps from 0. Null and empty texts are
    one token, the end. Null doc_ids and equal rows are packed like others, each for itself. Which pieces of a length
    share a sequence depends on how the table is cut into partitions; the number of sequences does not. An empty table
    gives an empty table. Other columns are ignored."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = stored(docs.select("doc_id", "text").mapInArrow(_tokenized(tokenizer, capacity, end), _TOKENIZED.format(kind)), "pieces")
    sizes = stored(cut.groupBy("_p", "length").agg(F.count(F.lit(1)).alias("n")), "sizes")
    counts = [0] * (capacity + 1)
    for x, n in sizes.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        counts[x] = int(n)
    patterns, _ = complete(counts, capacity, nodes)
    before = F.sum("n").over(W.partitionBy("length").orderBy("_p")) - F.col("n")
    numbered = cut.join(sizes.select("_p", "length", before.alias("_before")), ["_p", "length"]).withColumn("number", F.col("_before") + F.col("_r"))
    return numbered.select("doc_id", "piece", "start", "length", "ids", "number").mapInArrow(
        _placed(_places(patterns, capacity), capacity), f"doc_id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids (little-endian uint32), and its pieces' doc_id, piece, offset and length in
    order. A group is one sequence, so it is bounded by the capacity."""
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", F.hex("ids").alias("h")))).alias("p"))
    return parts.select("sequence_id", F.unhex(F.array_join(F.transform("p", lambda x: x["h"]), "")).alias("ids"), F.transform("p", lambda x: x.dropFields("h")).alias("pieces"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    placed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


ORACLE_SQL = None
