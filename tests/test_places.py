"""Quadtrees and shapefiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from strandforge.operators import region
from strandforge.plans import catalogue
from strandforge.sources import readers, shapefile


def inside(x, y, rings):
    crossed = 0
    for r in rings:
        for (x2, y2), (x1, y1) in zip(r, [r[-1], *r[:-1]]):
            crossed += (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return crossed % 2 == 1


def star(rng, n, x, y):
    angle = np.sort(rng.uniform(0, 2 * np.pi, n))
    size = rng.uniform(4, 40, n)
    return [(x + a * np.cos(b), y + a * np.sin(b)) for a, b in zip(size.tolist(), angle.tolist())]


def frame(spark, shapes):
    return spark.createDataFrame([(n, [[{"lon": float(x), "lat": float(y)} for x, y in r] for r in rings]) for n, rings in shapes], "name string, rings array<array<struct<lon:double,lat:double>>>")


def test_regions_against_all_edges(spark):
    rng = np.random.default_rng(5)
    hole = [(x / 9 + 18, y / 9 + 4) for x, y in star(rng, 60, 20, 5)]
    shapes = [("a", [star(rng, 700, 20, 5), hole]), ("a", [star(rng, 40, 60, 20)]), ("b", [star(rng, 5, -100, -40)]), ("none", []), ("line", [[(0, 0), (9, 9)]])]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-150, 110, (3_000, 2)).tolist())] + [(7_000, 20.0, 5.0)] * 3 + [(8_000, None, 1.0), (8_001, float("nan"), 1.0), (8_002, 1e9, 5.0)]
    table = spark.createDataFrame(points, "id int, longitude double, latitude double").withColumn("level", F.lit(1)).withColumn("region_", F.lit("x"))
    got = sorted((r.id, r.region) for r in region.by_polygon(table, frame(spark, shapes)).collect())
    want = []
    for i, x, y in points:
        if x is not None and x == x:
            want += [(i, n) for n in {n for n, rings in shapes if inside(x, y, rings)}]
    assert len(got) > 100 and set(got) == set(want) and got == sorted(want)
    assert region.by_polygon(table, frame(spark, [])).count() == 0


def test_leaves_have_few_edges():
    rng = np.random.default_rng(6)
    leaves = list(region.cells_of([np.array(star(rng, 2_000, 0, 0))]))
    assert max(sum(map(len, rings)) for *_, rings in leaves) <= region.EDGES
    whole = sum(4.0 ** -level for level, _, _, rings in leaves if not rings)
    assert whole > 0  # some cells lie inside


def test_shapefile_in_ranges(spark, tmp_path):
    rng = np.random.default_rng(7)
    shapes = {f"name {i % 40} {i}": [star(rng, 30, float(i), 0.0)] for i in range(200)}
    for end, data in zip(("shp", "dbf", "shx"), catalogue.shapefile_bytes(shapes)):
        (tmp_path / f"p.{end}").write_bytes(data)
    spark.dataSource.register(shapefile.Shapefile)
    read = spark.read.format("shapefile").option("attribute", "NAME").option("range", "4096").load(str(tmp_path / "p.shp"))
    assert read.rdd.getNumPartitions() > 5
    rows = read.collect()
    assert {r.name: [[(p.lon, p.lat) for p in ring] for ring in r.rings] for r in rows} == shapes and sorted(r.shape for r in rows) == list(range(200))
    asked = list(shapes)[3:9]
    assert sorted(r.name for r in readers.shapefile(spark, str(tmp_path / "p.shp"), "NAME", asked).collect()) == sorted(asked)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = spark.read.format("shapefile").option("attribute", "NAME").option("push", "true").load(str(tmp_path / "p.shp")).where(F.col("name").isin(asked))
        assert sorted(r.name for r in pushed.collect()) == sorted(asked)
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    reader = shapefile.PushingReader({"path": str(tmp_path / "p.shp"), "attribute": "NAME"})
    other = GreaterThan(("shape",), 3)
    assert list(reader.pushFilters([In(("name",), tuple(asked)), other, EqualTo(("name",), asked[1])])) == [other]
    assert [r[0] for p in reader.partitions() for r in reader.read(p)] == [asked[1]]
    with pytest.raises(ValueError):
        shapefile.attribute((tmp_path / "p.dbf").read_bytes(), "OTHER")
