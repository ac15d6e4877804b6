"""Selection by place."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import in_shape
from ..sources.scratch import written

#: The quadtree's first cell holds all longitudes and latitudes: WORLD degrees to either side of zero. Cells with up to
#: EDGES edges are leaves, as are those DEPTH levels down (some 30 m).
WORLD, EDGES, DEPTH = 512.0, 16, 22


def by_country(frame: DataFrame, countries: list[str]) -> DataFrame:
    """Records of the countries; those without a country are discarded."""
    return frame.where(F.col("country").isin(countries))


def by_continent(frame: DataFrame, lookup: DataFrame, continents: list[str], countries: list[str] = ()) -> DataFrame:
    """Records of the continents (through country -> continent) or of the countries named besides."""
    of = lookup.where(F.col("continent").isin(list(continents)) | F.col("country").isin(list(countries))).select("country").distinct()
    return frame.join(of, "country", "left_semi")


def _half(ring: np.ndarray, axis: int, bound: float, upper: bool) -> np.ndarray:
    """The part of a closed ring on one side of a line along an axis. Where it leaves that side and comes back, it goes
    along the line, which changes nothing for points beside the line."""
    if not len(ring):
        return ring
    after = np.roll(ring, -1, axis=0)
    here, there = (ring[:, axis] >= bound, after[:, axis] >= bound) if upper else (ring[:, axis] <= bound, after[:, axis] <= bound)
    out = np.empty((len(ring), 2, 2))
    out[:, 0] = ring
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (bound - ring[:, axis]) / (after[:, axis] - ring[:, axis])
        out[:, 1] = ring + t[:, None] * (after - ring)
    out[:, 1, axis] = bound
    return out[np.column_stack([here, here != there])]


def cells_of(rings: list[np.ndarray], edges: int = EDGES, depth: int = DEPTH):
    """A shape's leaves (level, column, row, rings): the rings' parts inside the cell, or none where all of the cell is
    inside. A cell with more than `edges` edges is cut in four."""
    todo = [(0, 0, 0, [r for r in rings if len(r) > 2])]
    while todo:
        level, column, row, parts = todo.pop()
        size = 2 * WORLD / 2**level
        x0, y0 = column * size - WORLD, row * size - WORLD
        x1, y1 = x0 + size, y0 + size
        # edges along the cell's border are no border of the shape
        inner = count = 0
        for r in parts:
            after = np.roll(r, -1, axis=0)
            along = np.zeros(len(r), bool)
            for axis, bounds in ((0, (x0, x1)), (1, (y0, y1))):
                for bound in bounds:
                    along |= (r[:, axis] == bound) & (after[:, axis] == bound)
            inner += int((~along & (r != after).any(axis=1)).sum())
            count += len(r)
        if not inner:
            x, y, crossed = (x0 + x1) / 2, (y0 + y1) / 2, 0
            for r in parts:
                after = np.roll(r, -1, axis=0)
                k = np.flatnonzero((r[:, 1] > y) != (after[:, 1] > y))
                crossed += int((x < (after[k, 0] - r[k, 0]) * (y - r[k, 1]) / (after[k, 1] - r[k, 1]) + r[k, 0]).sum())
            if crossed % 2:
                yield level, column, row, []
        elif count <= edges or level >= depth:
            yield level, column, row, parts
        else:
            x, y = (x0 + x1) / 2, (y0 + y1) / 2
            for right in (0, 1):
                side = [h for r in parts if len(h := _half(r, 0, x, bool(right))) > 2]
                for upper in (0, 1):
                    if quarter := [h for r in side if len(h := _half(r, 1, y, bool(upper))) > 2]:
                        todo.append((level + 1, 2 * column + right, 2 * row + upper, quarter))


_LEAF = "name string, level int, column long, row long, rings array<array<struct<lon:double,lat:double>>>"


def index(polygons: DataFrame) -> DataFrame:
    """The leaves (name, level, column, row, rings) of the quadtrees of all shapes (name, rings); a task takes a shape."""
    def go(batches):
        for b in batches:
            for name, rings in zip(b.column("name").to_pylist(), b.column("rings").to_pylist(), strict=True):
                shape = [np.array([(p["lon"], p["lat"]) for p in r], np.float64).reshape(-1, 2) for r in rings or () if r]
                out = list(cells_of(shape))
                for lo in range(0, len(out), 4_096):
                    part = out[lo: lo + 4_096]
                    told = [[[{"lon": x, "lat": y} for x, y in r.tolist()] for r in rs] for *_, rs in part]
                    columns = [pa.array([name] * len(part), pa.string()), pa.array([c[0] for c in part], pa.int32()), *[pa.array([c[k] for c in part], pa.int64()) for k in (1, 2)], pa.array(told, pa.list_(pa.list_(pa.struct([("lon", pa.float64()), ("lat", pa.float64())]))))]
                    yield pa.RecordBatch.from_arrays(columns, ["name", "level", "column", "row", "rings"])
    return polygons.select("name", "rings").mapInArrow(go, _LEAF)


def by_polygon(frame: DataFrame, polygons: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Records inside a region (name, rings), with its name; those without coordinates are discarded, and repeated
    records stay repeated. A row of `polygons` is one shape with its holes; shapes of one name are one region.

    Shapes are cut up by quadtrees. Distinct places are looked up, not records: a place meets the leaves of each level at
    one cell, by equal keys. Most leaves lie inside whole, others hold a few edges that a ray is cast at, so no shape is
    carried along. On a border between cells, as on any border, what counts is which side rounding puts a point on."""
    leaves = written(index(polygons.where(F.col("name").isin(names)) if names is not None else polygons), "leaves")
    levels = sorted(r.level for r in leaves.select("level").distinct().collect())  # some twenty at most
    x, y = F.col("longitude"), F.col("latitude")
    known = (F.abs(x) < WORLD) & (F.abs(y) < WORLD)
    given = frame.where(known)
    at = lambda c: F.floor((F.col(c) + WORLD) / (F.lit(2 * WORLD) / F.pow(F.lit(2.0), F.col("level"))))
    places = given.select("longitude", "latitude").distinct().withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]) if levels else F.array().cast("array<int>")))
    met = places.withColumns({"column": at("longitude"), "row": at("latitude")}).join(leaves, ["level", "column", "row"])
    inside = met.where((F.size("rings") == 0) | in_shape(x, y, F.col("rings")))
    # shapes of one name may overlap
    found = inside.select(F.col("longitude").alias("_x"), F.col("latitude").alias("_y"), F.col("name").alias("region")).distinct()
    return given.join(found, (x == F.col("_x")) & (y == F.col("_y"))).select(*[given[c] for c in frame.columns], "region")


def catalogue(lookup: DataFrame, column: str) -> DataFrame:
    return lookup.select(F.col(column).alias("name")).where("name is not null").distinct().orderBy("name")


def unknown_names(spark, asked: list[str], lookup: DataFrame, column: str) -> DataFrame:
    """Those of the asked names that the catalogue lacks."""
    return spark.createDataFrame([(x,) for x in asked], "name string").join(catalogue(lookup, column), "name", "left_anti")
