"""Column expressions over nucleotide sequences, lineages and coordinates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the standard genetic code, amino acids of the 64 codons in TCAG order.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: NCBI genetic codes by number, as what differs from the standard one.
_CHANGES = {
    1: "", 2: "AGA* AGG* ATAM TGAW", 3: "ATAM CTTT CTCT CTAT CTGT TGAW", 4: "TGAW", 5: "AGAS AGGS ATAM TGAW", 6: "TAAQ TAGQ",
    9: "AAAN AGAS AGGS TGAW", 10: "TGAC", 11: "", 12: "CTGS", 13: "AGAG AGGG ATAM TGAW", 14: "AAAN AGAS AGGS TAAY TGAW", 15: "TAGQ", 16: "TAGL",
    21: "TGAW ATAM AGAS AGGS AAAN", 22: "TCA* TAGL", 23: "TTA*", 24: "AGAS AGGK TGAW", 25: "TGAG", 26: "CTGA", 27: "TAAQ TAGQ TGAW", 28: "TAAQ TAGQ TGAW",
    29: "TAAY TAGY", 30: "TAAE TAGE", 31: "TGAW TAAE TAGE", 32: "TAGW", 33: "TAAY TGAW AGAS AGGK",
}


def genetic_code(number: int) -> str:
    """Amino acids of the 64 codons in TCAG order; unknown numbers are refused."""
    if number not in _CHANGES:
        raise ValueError(f"no genetic code {number}; there are {', '.join(map(str, _CHANGES))}")
    table = list(STANDARD)
    for x in _CHANGES[number].split():
        table[sum("TCAG".index(c) * 4 ** (2 - k) for k, c in enumerate(x[:3]))] = x[3]
    return "".join(table)


#: Fixed value: consensus protein of arthropod CO1, the default to compare with.
CONSENSUS = (
    "TLYFLFGAWSGMVGTALSVLIRIELGQPGSLIGDDQIYNVIVTAHAFVMIFFMVMPIMIGGFGNWLVPLMLGAPDMAFPRLNNMSFWLLPPSLTLLLAGSMVESGAGTGWTVYPPLAGAIAHAGASVDLTIFSLHLAGVSSILGAINFITTTINMKSPGMKMDQMPLFVWAVVITAVLLLLSLPVLAGAITMLLTDRNINTSFFDPAGGGDPILYQHLF"
)
STRAND_TOLERANCE = 0.05


def reverse_complement(seq: Column) -> Column:
    """Complements of lower-case bases come out in upper case; other symbols stay as they are."""
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCATGCA")


def count_char(seq: Column, char: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(char), F.lit("")))


def translate(seq: Column, frame: int, code: int = 5) -> Column:
    """Protein of frame 1, 2 or 3. Codons with other symbols give X, a partial last codon is dropped; a sequence
    under three bases gives an empty protein, a null one null."""
    s, table = F.upper(seq), genetic_code(code)
    codons = F.floor((F.length(s) - (frame - 1)) / 3).cast("int")

    def amino(i: Column) -> Column:
        at = [F.instr(F.lit("TCAG"), F.substring(s, i * 3 + frame + k, F.lit(1))) - 1 for k in range(3)]
        # instr of an empty or foreign symbol is 0
        return F.when(F.least(*at) < 0, F.lit("X")).otherwise(F.substring(F.lit(table), at[0] * 16 + at[1] * 4 + at[2] + 1, F.lit(1)))

    body = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(codons, F.lit(1)) - 1), amino), "")
    return F.when(seq.isNull(), None).when(codons < 1, F.lit("")).otherwise(body)


def internal_stops(protein: Column) -> Column:
    """Stops that are neither the first nor the last residue."""
    return F.when(F.length(protein) > 2, count_char(F.substring(protein, F.lit(2), F.length(protein) - 2), "*")).otherwise(F.lit(0)).cast("int")


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of code points, filled up with 0, and their lengths."""
    size = np.array([len(x) for x in texts], np.int64)
    out = np.zeros((len(texts), int(size.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return out, size


def jaro_winkler_similarities(left: list[str], right: list[str]) -> np.ndarray:
    """Of each pair; letters of the left text in turn take the first free equal letter in reach, for all pairs at once."""
    a, n = _points(left)
    b, m = _points(right)
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    used, taken = np.zeros(b.shape, bool), np.zeros(a.shape, bool)
    rows, place = np.arange(len(a)), np.arange(b.shape[1])
    for i in range(a.shape[1] if b.size else 0):
        lo, hi = max(0, i - int(reach.max())), i + int(reach.max()) + 1  # no pair reaches further
        near = np.abs(place[lo:hi] - i) <= reach[:, None]
        free = (b[:, lo:hi] == a[:, i: i + 1]) & near & ~used[:, lo:hi] & (i < n)[:, None] & (place[lo:hi] < m[:, None])
        at = free.argmax(axis=1) if free.shape[1] else np.zeros(len(a), np.int64)
        hit = free[rows, at] if free.shape[1] else np.zeros(len(a), bool)
        used[rows[hit], lo + at[hit]] = True
        taken[:, i] = hit
    matches = taken.sum(axis=1)
    # matched letters in order, side by side; half of those that differ are transpositions
    x, y = np.zeros((len(a), int(matches.max(initial=0))), np.uint32), np.zeros((len(a), int(matches.max(initial=0))), np.uint32)
    own = np.arange(x.shape[1]) < matches[:, None]
    x[own], y[own] = a[taken], b[used]
    moved = (x != y).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(matches > 0, (matches / n + matches / m + (matches - moved) / matches) / 3, 0.0)
    head = min(4, a.shape[1], b.shape[1])
    same = np.cumprod((a[:, :head] == b[:, :head]) & (np.arange(head) < np.minimum(n, m)[:, None]), axis=1).sum(axis=1) if head else 0
    return np.where(jaro >= 0.7, jaro + 0.1 * same * (1 - jaro), jaro)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def jaro_winkler(texts: pd.Series, others: pd.Series) -> pd.Series:
    """Jaro-Winkler similarities (prefix weight 0.1, boost from 0.7) of each text of an array with the other text; no
    built-in has it. Null or empty: 0."""
    out = []
    for lo in range(0, len(texts), 1024):
        rows = [["" if x is None else x for x in own] for own in texts.iloc[lo: lo + 1024]]
        flat = [x for own in rows for x in own]
        other = [y or "" for own, y in zip(rows, others.iloc[lo: lo + 1024], strict=True) for _ in own]
        found = jaro_winkler_similarities(flat, other)
        out += [x.tolist() for x in np.split(found, np.cumsum([len(own) for own in rows])[:-1])] if rows else []
    return pd.Series(out)


def header_taxa(header: Column) -> Column:
    """Taxa after the identifier; trailing empty ranks are dropped, inner ones stay."""
    parts = F.split(F.regexp_replace(F.regexp_replace(header, "^>", ""), r"[|]+$", ""), "[|]", -1)
    return F.when(F.size(parts) > 1, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1)))).otherwise(F.array().cast("array<string>"))


def contains_lineage(a: Column, b: Column) -> Column:
    """a equals a united with b: order does not matter, and a lineage with a repeated name contains nothing."""
    return F.array_union(a, b) == a


def crossings(lon: Column, lat: Column, ring: Column) -> Column:
    """How many edges of a ring of (lon, lat) structs a ray from the point to the east crosses; a closing point may be
    left out."""
    n = F.size(ring)

    def crossing(p: Column, i: Column) -> Column:
        q = F.get(ring, (i + n - 1) % n)
        high = (p["lat"] > lat) != (q["lat"] > lat)
        return F.when(high & (lon < (q["lon"] - p["lon"]) * (lat - p["lat"]) / (q["lat"] - p["lat"]) + p["lon"]), 1).otherwise(0)

    return F.aggregate(F.transform(ring, crossing), F.lit(0), lambda s, x: s + x)


def in_shape(lon: Column, lat: Column, rings: Column) -> Column:
    """Inside a shape of several rings, of which those within others are holes: the crossings of all are added up."""
    return F.aggregate(F.transform(rings, lambda ring: crossings(lon, lat, ring)), F.lit(0), lambda s, x: s + x) % 2 == 1
