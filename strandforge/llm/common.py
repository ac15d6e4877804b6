"""Helpers shared by the training-data operators: tables, shared storage, tokens, hashes."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space; ``bytes.split()`` cuts at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local master may fall back to a temporary one."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not conf.get("spark.master", "local").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    found = tempfile.mkdtemp(prefix="strandforge-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    _WRITTEN.paths.add(path)
    return out


class _Written(threading.local):
    """Paths of tables that `stored` wrote and nothing has removed yet, of each thread of the driver for itself: queries
    that run side by side do not clear each other's."""

    def __init__(self):
        self.paths: set[str] = set()


_WRITTEN = _Written()


def discard(*tables: DataFrame) -> None:
    """Removes stored tables that nothing reads any more."""
    for df in tables:
        _remove(df.sparkSession, df._stored_at)


def held() -> frozenset[str]:
    """The tables that this thread has stored and that are still there."""
    return frozenset(_WRITTEN.paths)


def clear(spark: SparkSession, but: frozenset[str] = frozenset()) -> int:
    """Removes tables that operators stored in this thread, and tells how many. For callers, once they have written or
    collected their results: until then results read these tables. Those of `but` stay."""
    paths = sorted(_WRITTEN.paths - but)
    for path in paths:
        _remove(spark, path)
    return len(paths)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _WRITTEN.paths.discard(path)


def released(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of jobs that are done. It does so only when the driver's JVM collects its
    garbage, which a driver with little to do puts off while the files of every step pile up."""
    gc.collect()
    spark._jvm.System.gc()


#: Columns of a document's key, and their types.
KEY = ["_k", "_t", "_u"]
KEY_SCHEMA = "_k long, _t long, _u int"


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text, and a key that is never null: _k is doc_id (null: the least long), _t and _u, 96 bits of hashes of
    the text, tell rows of one doc_id with different texts apart, however many share it. Equal rows have equal keys and
    count as one document."""
    return docs.select(
        "doc_id", "text", *[F.col(quoted(c)) for c in more],
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_k"),
        F.xxhash64("text").alias("_t"), F.hash("text").alias("_u"),
    )


def plainly(df: DataFrame, named: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The same table, whose columns other than `named` have names without dots or backticks, which functions over
    batches need; toDF() gives the old ones back."""
    return df.toDF(*[c if c in named else f"_x{i}" for i, c in enumerate(df.columns)])


def quoted(name: str) -> str:
    """A column's name as it stands, dots and backticks included."""
    return f"`{name.replace('`', '``')}`"


def spelled(df: DataFrame, without: tuple[str, ...] = ()) -> str:
    """The schema of a table as text, for functions over batches."""
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in without)


def key_of(batch: pa.RecordBatch, lo: int = 0, hi: int | None = None) -> list[np.ndarray]:
    return [batch.column(c).to_numpy()[lo:hi] for c in KEY]


def raw(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes, undecoded."""
    return batch.column(name).cast(pa.binary()).to_pylist()


_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
_S = np.uint64(32)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S)) * _C
    h = (h ^ (h >> _S)) * _A
    return h ^ (h >> _S)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two adjoining runs of words each."""
    return mixed(left * _A + right * _B + _C)


_FACTORS = mixed(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words: a sum of products for short runs, built by doubling for longer ones."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    if n <= len(_FACTORS):
        size = len(h) - n + 1
        out = h[:size] * _FACTORS[0]
        for k in range(1, n):
            out += h[k: k + size] * _FACTORS[k]
        return mixed(out)
    done, out, rest, at = 0, None, h, n
    size = 1
    while at:
        if at & 1:
            part = rest[done: done + len(h) - n + 1]
            out = part if out is None else joined(out, part)
            done += size
        at >>= 1
        if at:
            rest = joined(rest[: len(rest) - size], rest[size:])
            size *= 2
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of an array of bytes."""
    edges = np.flatnonzero(np.diff(~_SPACE[data], prepend=False, append=False))
    return edges[::2], edges[1::2]


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64))
_ODD = np.uint64(0xD6E8FEB86659FD93)
_UNDO = np.uint64(pow(int(_ODD), -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, 0 to n; kept up to some million."""
    if len(_POWERS[0]) > n:
        return _POWERS[0], _POWERS[1]
    made = []
    for x in (_ODD, _UNDO):
        a = np.full(n + 1, x)
        a[0] = 1
        made.append(np.multiply.accumulate(a))
    if n <= 1 << 22:
        _POWERS[:] = made
    return made[0], made[1]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words between `start` and `end`: polynomials in their bytes, from running sums over all."""
    up, down = _powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_LETTERS[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _A)


def hashed(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and the number of words of each. `lower`: of A-Z."""
    joined_up = b"\n".join(x or b"" for x in texts)
    data = np.frombuffer(joined_up.lower() if lower else joined_up, np.uint8)
    start, end = spans(data)
    size = np.array([len(x) + 1 if x else 1 for x in texts], np.int64)
    first = np.searchsorted(start, np.cumsum(size))
    return span_hashes(data, start, end), np.diff(first, prepend=0)


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """Of each run of `width` values the place of the least one, of equal ones the first: widths are doubled."""
    value, at, size = h, np.arange(len(h)), 1
    while size < width:
        step = min(size, width - size)
        right = value[step:] < value[: len(value) - step]
        value = np.where(right, value[step:], value[: len(value) - step])
        at = np.where(right, at[step:], at[: len(at) - step])
        size += step
    return at


def runs(texts: list[bytes | None], most: int = 1 << 20):
    """Bounds (lo, hi) of consecutive texts of `most` bytes together, or of one longer text."""
    lo = held = 0
    for i, x in enumerate(texts):
        n = len(x) if x else 0
        if i > lo and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(texts):
        yield lo, len(texts)


def pieces(batch: pa.RecordBatch, name: str, most: int = 1 << 20):
    """A string column as UTF-8 bytes, some `most` bytes at a time (or one longer text), so that a batch of long texts
    is never held twice."""
    column = batch.column(name).cast(pa.binary())
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    lo = held = 0
    for i, n in enumerate(size.tolist()):
        if i > lo and held + n > most:
            yield column.slice(lo, i - lo).to_pylist()
            lo, held = i, 0
        held += n
    if lo < len(size):
        yield column.slice(lo).to_pylist()


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
