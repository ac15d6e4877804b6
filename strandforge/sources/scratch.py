"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir; only a local session without that setting uses a temporary folder."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not conf.get("spark.master", "local").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="strandforge-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes a table and reads it again: its lineage ends there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    _HELD.paths.add(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Held(threading.local):
    """Paths of the tables that a thread of the driver has written and not removed."""

    def __init__(self):
        self.paths: set[str] = set()


_HELD = _Held()


def held() -> frozenset[str]:
    """The tables that this thread has written and that are still there."""
    return frozenset(_HELD.paths)


def clear(spark: SparkSession, but: frozenset[str] = frozenset()) -> int:
    """Removes tables that operators wrote in this thread, but for those of `but`, and tells how many. For callers whose
    results are written: until then results read these tables."""
    paths = sorted(_HELD.paths - but)
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _HELD.paths.discard(path)
    return len(paths)


def put(spark: SparkSession, path: str, data: bytes) -> str:
    """A small file of these bytes, wherever Spark can write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    return path
