"""Shapefiles as a data source of Spark's: an index file (.shx) tells where each shape lies, so tasks read ranges of
shapes and of attributes, however large the files are."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

SCHEMA = "name string, shape int, rings array<array<struct<lon:double,lat:double>>>"
#: Bytes of shapes that a task reads, about.
RANGE = 8 << 20


def opened(path: str):
    """(file system, path in it) that tasks can read ranges from; ValueError where only Spark knows the store."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    try:
        return fs.FileSystem.from_uri(path)
    except Exception as e:  # of which kind depends on the store
        raise ValueError(f"no ranges can be read from {path}") from e


def splittable(path: str) -> bool:
    """Whether shapes can be read in ranges: the store allows it and the index is there."""
    try:
        files, inside = opened(path)
        return files.get_file_info(f"{inside.removesuffix('.shp')}.shx").is_file
    except (ValueError, OSError):
        return False


@dataclass
class Column:
    """Where an attribute stands: the first row, bytes a row, and the field in it."""

    head: int
    width: int
    offset: int
    size: int


def attribute(header: bytes, name: str) -> Column:
    head, width = np.frombuffer(header[8:12], "<u2").tolist()
    at, offset = 32, 1
    while at + 32 <= len(header) and header[at] != 0x0D:
        field, size = header[at: at + 11].split(b"\0")[0].decode(), header[at + 16]
        if field == name:
            return Column(head, width, offset, size)
        offset, at = offset + size, at + 32
    raise ValueError(f"no attribute {name}")


def rings(body: bytes) -> list[list[dict[str, float]]]:
    """The rings of a polygon record; of other kinds of shapes there are none."""
    if len(body) < 44 or int.from_bytes(body[:4], "little") not in (5, 15, 25):
        return []
    parts, points = np.frombuffer(body[36:44], "<i4").tolist()
    starts = [*np.frombuffer(body, "<i4", parts, 44).tolist(), points]
    flat = np.frombuffer(body, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2).tolist()
    return [[{"lon": x, "lat": y} for x, y in flat[a:b]] for a, b in zip(starts, starts[1:], strict=False)]


@dataclass
class Shapes(InputPartition):
    first: int
    offsets: list[int]
    lengths: list[int]


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.stem, self.column = options["path"].removesuffix(".shp"), options["attribute"]
        self.range = int(options.get("range", RANGE))
        self.values = set(json.loads(options["values"])) if "values" in options else None

    def partitions(self) -> list[Shapes]:
        files, stem = opened(self.stem)
        with files.open_input_file(f"{stem}.shx") as f:
            index = np.frombuffer(f.read_at(f.size() - 100, 100), ">i4").reshape(-1, 2).astype(np.int64) * 2
        cut = np.r_[0, np.flatnonzero(np.diff(np.cumsum(index[:, 1]) // self.range)) + 1, len(index)]
        return [Shapes(a, index[a:b, 0].tolist(), index[a:b, 1].tolist()) for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False) if b > a]

    def read(self, part: Shapes) -> Iterator[tuple]:
        files, stem = opened(self.stem)
        with files.open_input_file(f"{stem}.dbf") as f:
            own = attribute(f.read_at(int.from_bytes(f.read_at(2, 8), "little"), 0), self.column)
            rows = f.read_at(own.width * len(part.offsets), own.head + own.width * part.first)
        names = [rows[i * own.width + own.offset: i * own.width + own.offset + own.size].decode("utf-8", "replace").strip() for i in range(len(part.offsets))]
        with files.open_input_file(f"{stem}.shp") as f:
            for i, (name, at, size) in enumerate(zip(names, part.offsets, part.lengths, strict=True)):
                if self.values is None or name in self.values:
                    yield name, part.first + i, rings(f.read_at(size, at + 8))


class PushingReader(Reader):
    """For sessions with spark.sql.python.filterPushdown.enabled; Spark refuses such a reader in others."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Names asked for; all other conditions are left to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("name",):
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.values = asked if self.values is None else self.values & asked
            else:
                yield f


class Shapefile(DataSource):
    """spark.read.format("shapefile").option("attribute", ...).load("....shp"); option `values`, a JSON list, names the
    shapes to read, option `push` says that conditions on the name may be pushed down."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        options = dict(self.options)
        return PushingReader(options) if options.get("push") == "true" else Reader(options)
