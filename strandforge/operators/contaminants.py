"""Removal of records that are nearly a known contaminant: seeds, then banded global alignment.

A record is contaminated if its global alignment with some contaminant reaches an identity. Alignments are scored like
those of the usual search tools: match 2, mismatch -4, an inner gap 20 and 2 a column, a gap at an end 2 and 1 a column.
Identity is the share of matching columns among those not in end gaps; of alignments of equal score the one with more
matches, then fewer columns counts. Hits span at least half of the shorter sequence and `least_columns` columns.

An alignment of A columns with at most (1 - identity) * A of them not matching has no fewer than a certain number of
matching runs of `WORD` letters, and all of them lie on neighbouring diagonals. Pairs with fewer seeds on every band of
diagonals that wide are ruled out without a look at the rest; the others are aligned inside their bands, many at a time.
So the result is that of aligning everything with everything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = 8
#: Of the shorter sequence.
COVER = 0.5
#: Contaminants of this many letters together are sent to the tasks; more are dealt in blocks of that size.
SENT = 4_000_000
#: Letters of records in a slice that meets a block, when contaminants are dealt; pairs aligned at once.
SLICE, PAIRS = 16_000_000, 256

_CODE = np.full(256, 4, np.uint8)
for _i, _pair in enumerate(("Aa", "Cc", "Gg", "TtUu")):
    for _c in _pair:
        _CODE[ord(_c)] = _i

# score, matches and columns in one number, compared in this order
_S, _M = np.int64(1) << np.int64(40), np.int64(1) << np.int64(20)
_MATCH, _MISMATCH, _OPEN, _EXTEND = 2 * _S + _M - 1, -4 * _S - 1, -22 * _S - 1, -2 * _S - 1
_NONE = -(np.int64(1) << np.int64(60))


def least_columns(identity: float) -> int:
    """Alignments shorter than this may have no seed."""
    free = 1 - WORD * (1 - identity)
    if free <= 0:
        raise ValueError(f"identity must be over {1 - 1 / WORD}")
    return int(np.ceil(WORD / free - 1e-9))


def _coded(sequence: str) -> np.ndarray:
    return _CODE[np.frombuffer(sequence.encode("ascii", "replace"), np.uint8)]


def _words(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the words of plain letters."""
    if len(x) < WORD:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bad = np.concatenate([[0], np.cumsum(x > 3)])
    number = np.zeros(len(x) - WORD + 1, np.int64)
    for k in range(WORD):
        number = number * 4 + np.minimum(x[k: len(x) - WORD + 1 + k], 3)
    at = np.flatnonzero(bad[WORD:] == bad[:-WORD])
    return at, number[at]


class Index:
    """Words of some contaminants, sorted."""

    def __init__(self, names: list[str], sequences: list[str], identity: float):
        self.names, self.identity, self.least = names, identity, least_columns(identity)
        self.coded = [_coded(s) for s in sequences]
        self.size = np.array([len(x) for x in self.coded], np.int64)
        found = [_words(x) for x in self.coded]
        word = np.concatenate([w for _, w in found]) if found else np.empty(0, np.int64)
        order = np.argsort(word, kind="stable")
        self.word = word[order]
        self.at = (np.concatenate([a for a, _ in found]) if found else word)[order]
        self.target = np.repeat(np.arange(len(found)), [len(a) for a, _ in found])[order]

    def candidates(self, x: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(seeds, target, lowest diagonal, highest diagonal) of what must be aligned, most seeds first."""
        at, word = _words(x)
        if not len(at) or not len(self.word):
            return []
        drift = int(np.ceil((1 - self.identity) / self.identity * len(x))) + 1
        buckets = (len(x) + int(self.size.max())) // drift + 2
        seeds = np.zeros(len(self.names) * buckets, np.int64)
        lo, hi = np.searchsorted(self.word, word), np.searchsorted(self.word, word, side="right")
        ends = np.cumsum(hi - lo)
        first = 0
        while first < len(at):  # a million seeds at a time
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + 1_000_000, side="right")))
            n = (hi - lo)[first:last]
            k = np.repeat(lo[first:last] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            diagonal = self.at[k] - np.repeat(at[first:last], n) + len(x)
            seeds += np.bincount(self.target[k] * buckets + diagonal // drift, minlength=len(seeds))
            first = last
        near = seeds.reshape(-1, buckets)
        near = near[:, :-1] + near[:, 1:]
        columns = np.maximum(np.ceil(COVER * np.minimum(self.size, len(x))), self.least)
        bound = np.maximum(1, np.ceil(columns - WORD + 1 - WORD * (1 - self.identity) * columns - 1e-6))
        out: dict[tuple[int, int], list[int]] = {}
        for t, b in np.argwhere(near >= bound[:, None]).tolist():
            n = int(near[t, b])
            if (run := out.pop((t, b - 1), None)) is not None:  # next to the last one
                out[t, b] = [max(n, run[0]), run[1]]
            else:
                out[t, b] = [n, b]
        return sorted(((n, t, start * drift - len(x) - drift, (b + 2) * drift - len(x) + drift) for (t, b), (n, start) in out.items()), key=lambda c: (-c[0], *c[1:]))


def aligned(pairs: list[tuple[np.ndarray, np.ndarray, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Matches and columns (end gaps left out) of the best alignment of each (query, target, lowest and highest diagonal
    allowed), by rows of all pairs at once. Diagonals are target minus query positions."""
    n, m = (np.array([len(p[k]) for p in pairs], np.int64) for k in (0, 1))
    low = np.array([max(p[2], -len(p[0])) for p in pairs], np.int64)
    high = np.array([min(p[3], len(p[1])) for p in pairs], np.int64)
    width = int((high - low).max()) + 1
    rows, band = int(n.max()), np.arange(width)
    q = np.full((len(pairs), rows + 1), 5, np.uint8)
    t = np.full((len(pairs), int(m.max()) + 1), 6, np.uint8)
    for i, p in enumerate(pairs):
        q[i, : len(p[0])] = p[0]
        t[i, : len(p[1])] = p[1]
    q[q == 4], t[t == 4] = 5, 6  # unknown letters match nothing
    every, ramp = np.arange(len(pairs)), band * -_EXTEND
    outside = band > (high - low)[:, None]
    gap = lambda k: np.where(k > 0, -(2 + k) * _S, 0)
    best = np.full(len(pairs), _NONE)
    h = f = None
    for i in range(rows + 1):
        j = i + low[:, None] + band
        bad = outside | (j < 0) | (j > m[:, None])
        if i:
            letter = t[every[:, None], np.clip(j - 1, 0, t.shape[1] - 1)]
            over = np.full_like(h, _NONE)
            over[:, :-1] = np.maximum(h[:, 1:] + _OPEN, f[:, 1:] + _EXTEND)
            f = over
            h = np.maximum(h + np.where(letter == q[:, i - 1: i], _MATCH, _MISMATCH), f)
            h[j == 0] = gap(np.int64(i))
            h[bad] = _NONE
            run = np.maximum.accumulate(h + ramp, axis=1)
            h[:, 1:] = np.where(bad[:, 1:] | (j[:, 1:] == 0), h[:, 1:], np.maximum(h[:, 1:], run[:, :-1] - ramp[:-1] + _OPEN))
        else:
            h = np.where(bad, _NONE, gap(j))
            f = np.full_like(h, _NONE)
        # what is left of the query behind the target's end, or of the target behind the query's
        b = m - i - low
        ok = (b >= 0) & (b < width) & (i <= n)
        best[ok] = np.maximum(best[ok], h[every[ok], b[ok]] + gap(n[ok] - i))
        if (done := n == i).any():
            best[done] = np.maximum(best[done], np.where(bad[done], _NONE, h[done] + gap(m[done, None] - j[done])).max(axis=1))
    columns = -best & (_M - 1)
    return ((best + columns) >> np.int64(20)) & (_M - 1), columns


def search(index: Index, sequences: list[str]) -> list[tuple[str, float, int] | None]:
    """For each sequence a contaminant it is nearly: (name, identity, columns), or None. Of several the one with most
    seeds that is near enough."""
    coded = [_coded(s) for s in sequences]
    todo = [(i, index.candidates(x)) for i, x in enumerate(coded)]
    out: list[tuple[str, float, int] | None] = [None] * len(sequences)
    turn = 0
    while todo := [(i, c) for i, c in todo if out[i] is None and len(c) > turn]:
        # bands of like width together
        now = sorted(((c[turn], i) for i, c in todo), key=lambda x: x[0][3] - x[0][2])
        for lo in range(0, len(now), PAIRS):
            part = now[lo: lo + PAIRS]
            matches, columns = aligned([(coded[i], index.coded[t], a, b) for (_, t, a, b), i in part])
            for ((_, t, _, _), i), hit, n in zip(part, matches.tolist(), columns.tolist(), strict=True):
                least = max(index.least, COVER * min(len(coded[i]), int(index.size[t])))
                if n >= least and hit >= index.identity * n - 1e-9:
                    out[i] = (index.names[t], hit / n, n)
        turn += 1
    return out


_HIT = "sequence string, contaminant string, identity double, columns int"


def _batch(sequences: list[str], found: list) -> pa.RecordBatch:
    rows = [(s, *f) for s, f in zip(sequences, found, strict=True) if f]
    kinds = (pa.string(), pa.string(), pa.float64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["sequence", "contaminant", "identity", "columns"])


def hits(records: DataFrame, contaminants: DataFrame, identity: float = 0.9, sent: int = SENT) -> DataFrame:
    """(sequence, contaminant, identity, columns): the distinct sequences that are nearly one of `contaminants`
    (identifier, sequence). Gaps are no letters; case does not matter, U is T.

    Contaminants of up to `sent` letters go to every task and records stay where they are; more are dealt in blocks that
    meet slices of the records, with the same result."""
    plain = lambda c: F.replace(F.col(c), F.lit("-"), F.lit(""))
    queries = records.select("sequence").where("sequence is not null").distinct()
    against = contaminants.select(F.col("identifier").cast("string").alias("identifier"), plain("sequence").alias("letters")).where("length(letters) > 0")
    against = against.groupBy("letters").agg(F.min("identifier").alias("identifier"))  # equal ones once
    letters = against.agg(F.sum(F.length("letters"))).first()[0] or 0
    if letters <= sent:
        rows = sorted((r.identifier or "", r.letters) for r in against.collect())

        def go(batches):
            index = Index([r[0] for r in rows], [r[1] for r in rows], identity)
            for b in batches:
                given = b.column("sequence").to_pylist()
                for lo in range(0, len(given), 1_000):
                    part = given[lo: lo + 1_000]
                    yield _batch(part, search(index, [s.replace("-", "") for s in part]))

        return queries.mapInArrow(go, _HIT)
    slices = max(1, -(-int(queries.agg(F.sum(F.length("sequence"))).first()[0] or 0) // SLICE))
    blocks = -(-letters // sent)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = queries.withColumn("slice", F.pmod(F.xxhash64("sequence"), F.lit(slices)).cast("int")).withColumn("block", every(blocks))
    other = against.withColumn("block_", F.pmod(F.xxhash64("letters"), F.lit(blocks)).cast("int")).withColumn("slice_", every(slices))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = sorted(zip((x or "" for x in right.column("identifier").to_pylist()), right.column("letters").to_pylist(), strict=True))
        given = left.column("sequence").to_pylist()
        return pa.Table.from_batches([_batch(given, search(Index([r[0] for r in rows], [r[1] for r in rows], identity), [s.replace("-", "") for s in given]))])

    found = own.groupBy("block", "slice").cogroup(other.groupBy("block_", "slice_")).applyInArrow(meet, _HIT)
    return found.groupBy("sequence").agg(F.max(F.struct("identity", "columns", "contaminant")).alias("h")).select("sequence", "h.contaminant", "h.identity", "h.columns")


def without_contaminants(records: DataFrame, contaminants: DataFrame, identity: float = 0.9) -> DataFrame:
    """Records whose sequence is no hit; those without a sequence stay."""
    return records.join(hits(records, contaminants, identity).select("sequence"), "sequence", "left_anti").select(*records.columns)


def matched(records: DataFrame, contaminants: DataFrame, identity: float = 0.9) -> DataFrame:
    """The other records, with contaminant, identity and columns: the report of the search."""
    return records.join(hits(records, contaminants, identity), "sequence").select(*records.columns, "contaminant", "identity", "columns")
