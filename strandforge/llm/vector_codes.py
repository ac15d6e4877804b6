"""Vector code compression: product codes whose nearest entries are found by partial-distance search.

Components become integers, so every distance is exact and every run gives the same codes. A part's codebook is sent to
the tasks (at most 256 entries a part, whatever the number of rows); a round of training sends back sums per entry.
Dimensions are taken in descending variance of the codebook. The first few give a guess at the nearest entry, whose
distance is completed; from there on an entry is dropped as soon as its partial distance strictly exceeds the best
complete one, so entries at equal distance survive to the end, where the lowest index wins.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integers beyond this would let squared distances leave 64 bits; no embedding's component is near 2**16 = LARGEST / SCALE.
LARGEST = 2**26
#: Rows searched at once, and dimensions summed up before the first and between later droppings.
CHUNK, FIRST, STEP = 512, 4, 2
#: Labels up to this number are sent to the tasks with their sums (16 bytes each).
SENT = 100_000


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of x, (n, w) integers, the index of the nearest of `entries`, (k, w), and the squared distance; of
    equal distances the lowest index."""
    n, w = x.shape
    if not w or len(entries) == 1:
        d = x.astype(np.int64) - entries[:1].astype(np.int64)
        return np.zeros(n, np.int64), (d * d).sum(axis=1)
    order = np.argsort(-entries.astype(np.float64).var(axis=0), kind="stable")
    widest = int(max(np.abs(x).max(initial=0), np.abs(entries).max()))
    kind = np.int32 if w * (2 * widest) ** 2 < 2**31 else np.int64
    x, entries = x[:, order].astype(kind), np.ascontiguousarray(entries[:, order].T).astype(kind)
    index, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    for lo in range(0, n, CHUNK):
        index[lo: lo + CHUNK], distance[lo: lo + CHUNK] = _searched(x[lo: lo + CHUNK], entries)
    return index, distance


def _searched(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, w = x.shape
    part = np.zeros((n, entries.shape[1]), x.dtype)
    for d in range(min(FIRST, w)):
        gap = x[:, d, None] - entries[d]
        gap *= gap
        part += gap
    guess = part.argmin(axis=1)
    gap = x - entries[:, guess].T
    best = (gap * gap).sum(axis=1, dtype=x.dtype)  # complete
    row, entry = np.nonzero(part <= best[:, None])
    part = part[row, entry]
    for lo in range(FIRST, w, STEP):
        for d in range(lo, min(lo + STEP, w)):
            gap = x[row, d] - entries[d, entry]
            part += gap * gap
        keep = part <= best[row]
        row, entry, part = row[keep], entry[keep], part[keep]
    # complete by now; a row's candidates stand together, entries ascending
    first = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(part, first)
    at = np.flatnonzero(part == least[row])
    at = at[np.flatnonzero(np.diff(row[at], prepend=-1))]
    return entry[at], least


def _integers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The batch's vectors as (n, PARTS, w) integers."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * SCALE).astype(np.int64).reshape(batch.num_rows, d)
    w = -(-d // PARTS)
    if d < PARTS * w:
        x = np.pad(x, ((0, 0), (0, PARTS * w - d)))
    return x.reshape(batch.num_rows, PARTS, w)


def _sums(books: np.ndarray, d: int):
    """A task's sums and counts of the parts that each entry is nearest to: (slot, value), slots by part, entry, position."""
    def go(batches):
        parts, k, w = books.shape
        sums, count = np.zeros((parts, k, w), np.int64), np.zeros((parts, k), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _integers(b, d)
            for p in range(parts):
                index, _ = nearest(x[:, p], books[p])
                np.add.at(sums[p], index, x[:, p])
                count[p] += np.bincount(index, minlength=k)
        every = np.concatenate([count.reshape(-1), sums.reshape(-1)])
        slot = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(every[slot])], ["slot", "value"])
    return go


def _codes(books: np.ndarray, d: int):
    def go(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, index, error = _integers(b, d), np.empty((b.num_rows, PARTS), np.uint8), np.zeros(b.num_rows, np.int64)
            for p in range(PARTS):
                index[:, p], found = nearest(x[:, p], books[p])
                error += found
            text = index.tobytes().hex()
            code = [text[i: i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])
    return go


def _whole(v: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def train(vectors: DataFrame, d: int, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (PARTS, at most ENTRIES, w) of a table (vec_id, v) whose vectors all have d components."""
    smallest = vectors.where("vec_id is not null").orderBy("vec_id", "v").limit(ENTRIES).select("v").collect()
    w = -(-d // PARTS)
    books = np.zeros((len(smallest), PARTS * w), np.int64)
    if smallest:
        books[:, :d] = np.floor(np.array([r.v for r in smallest], np.float64).reshape(len(smallest), d) * SCALE)
    books = np.ascontiguousarray(books.reshape(len(smallest), PARTS, w).transpose(1, 0, 2))
    if not smallest:
        return books
    size = books.shape[0] * books.shape[1]
    for _ in range(rounds):
        told = vectors.select("v").mapInArrow(_sums(books, d), "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value"))
        every = np.zeros(size * (1 + w), np.int64)
        for slot, value in told.collect():  # a number per entry and position, however many rows there are
            every[slot] = value
        count, sums = every[:size].reshape(books.shape[:2]), every[size:].reshape(books.shape)
        books = np.where(count[:, :, None] > 0, np.floor_divide(sums, np.maximum(count, 1)[:, :, None]), books)
    return books


def fingerprint(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(frame: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of a table (vec_id, `vector`, label): (vec_id, label, code, error), and the codebooks.

    Rows whose vector is null or holds null or non-finite components are dropped. The number of components is that of
    the least vec_id's vector; if 4 does not divide it, parts are filled up with zeros, which change no distance. Rows
    with another number of components, or with one of 2**16 and more, stay with a null code and error and take no part
    in training. Codebooks start from the 256 least vec_ids, of repeated ones from the least vector; with fewer rows
    they are smaller. Null vec_ids are coded but start nothing; without any vec_id there are no codebooks and all codes
    are null. Equal rows have equal codes and each count. Other columns are ignored; an empty table gives an empty one."""
    v = F.col(vector).cast("array<double>")
    whole = frame.select("vec_id", "label", v.alias("v")).where(_whole(F.col("v")))
    first = whole.where("vec_id is not null").orderBy("vec_id", F.size("v"), "v").limit(1).select(F.size("v").alias("d")).collect()
    d = first[0].d if first else 0
    fits = (F.size("v") == d) & ~F.exists("v", lambda x: F.abs(x) >= LARGEST // SCALE)
    if not first:
        fits = F.lit(False)
    books = train(whole.where(fits), d, rounds)
    rest = whole.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not books.shape[1]:  # every vector is too large
        return whole.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), books
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema.fields}
    coded = whole.where(fits).select("vec_id", "label", "v").mapInArrow(_codes(books, d), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return coded.unionByName(rest), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error, the errors of a label summed up, null labels together: sums are made before anything moves, and
    go back to the rows by broadcast if there are few labels, else by a join that Spark can split."""
    coded = stored(coded, "codes")
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    few = sums.count() <= SENT
    sums = sums.withColumnRenamed("label", "_label")
    return coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same rounds as text: long tables (part, entry, values) instead of arrays of them."""
    square = "list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    out = ["kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
           f"parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS v FROM kept, range({PARTS}) r(p))",
           f"book0 AS MATERIALIZED (SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, v FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}))"]
    for i in range(ROUNDS + 1):
        out.append(f"near{i} AS MATERIALIZED (SELECT vec_id, label, p, any_value(v) AS v, min(struct_pack(d := d, e := e)) AS m FROM (SELECT x.vec_id, x.label, x.p, x.v, b.e, {square} AS d FROM parts x JOIN book{i} b ON x.p = b.p) GROUP BY vec_id, label, p)")
        if i < ROUNDS:
            out.append(f"mean{i} AS (SELECT p, e, list(s ORDER BY j) AS v FROM (SELECT p, m.e AS e, j, CAST(floor(sum(v[j]) / count(*)) AS BIGINT) AS s FROM near{i}, LATERAL (SELECT unnest(range(1, len(v) + 1)) AS j) GROUP BY p, m.e, j) GROUP BY p, e)")
            out.append(f"book{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM book{i} b LEFT JOIN mean{i} n ON b.p = n.p AND b.e = n.e)")
    out.append(f"coded AS (SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id, label)")
    out.append(f"told AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM book{ROUNDS})")
    return f"WITH {', '.join(out)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded, told"


ORACLE_SQL = _sql()
