"""Reprojection over many sheets: batches of the series, sheets dealt by number, pixels that are joined with nothing large."""

import pytest
from pyspark.sql import functions as F

from strataspark.functions import crs
from strataspark.operators import mosaic
from strataspark.plans import terrain_queries

DATA = "/root/testdata/sf0.001"


def _sheets(spark, n=40):
    meta = spark.range(n).selectExpr("concat('s', id) as plik", "25.0D as res", "7400000.0D + id * 1000 as left", "5450000.0D + id * 1000 as bottom", "7400200.0D + id * 1000 as right", "5450200.0D + id * 1000 as top")
    cells = spark.range(64).selectExpr("cast(id div 8 as int) as row", "cast(id % 8 as int) as col", "cast(id as double) as z").crossJoin(meta.select("plik"))
    return meta.coalesce(1), cells.select("plik", "row", "col", "z")


def test_batches_follow_the_series(spark):
    places = [(k, 7_400_000.0 + k * 997, 5_450_000.0 + k * 1009) for k in range(200)] + [(200, None, 5e6), (201, 7e6, None)]
    moved = crs.moved_in_batches(F.col("x"), F.col("y"), 2178, 2180)
    got = {r.k: r.m for r in spark.createDataFrame(places, "k int, x double, y double").select("k", moved.alias("m")).collect()}
    for k, x, y in places[:200]:
        assert tuple(got[k]) == pytest.approx(crs.transform(x, y, 2178, 2180), abs=1e-7, rel=0)
    assert tuple(got[200]) == tuple(got[201]) == (None, None)


def test_the_mesh_joins_no_pixels(spark):
    """Spark took the table of pixels to be as small as its sheets and sent all of it to the driver, to be broadcast."""
    found = terrain_queries.raster_mesh(spark, DATA)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where("near").count() == found.count() > 0


def test_sheets_are_dealt_by_number(spark):
    """Small rows that become many pixels: merged by bytes, they were one task."""
    grids = mosaic.reprojected(*_sheets(spark), 2178, 2180)[0]
    assert grids.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and grids.count() == 40


@pytest.mark.parametrize("tolerance", [None, 0.125])
def test_pixels_meet_cells_by_sorting(spark, tolerance):
    """Neither way of placing pixels has them broadcast, whatever Spark takes their table's size to be."""
    moved = mosaic.reprojected(*_sheets(spark), 2178, 2180, tolerance)[1]
    plan = moved._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "SortMergeJoin" in joins[0] and "srow" in joins[0] and not any("srow" in line or "row#" in line for line in joins[1:])
    got = {(r.plik, r.row, r.col): r.z for r in moved.collect()}
    assert len({k[0] for k in got}) == 40
    for (name, row, col), z in list(got.items())[::97]:
        x, y = 7_400_000.0 + int(name[1:]) * 1000, 5_450_200.0 + int(name[1:]) * 1000
        assert tolerance is not None or z == _cell(row, col, x, y)


def _cell(row, col, left, top):
    """The source cell of a pixel, by the series on numbers."""
    sides = [crs.transform(left + u * 200, top - v * 200, 2178, 2180) for k in range(9) for u, v in ((k / 8, 0), (k / 8, 1), (0, k / 8), (1, k / 8))]
    west, north = min(x for x, _ in sides) // 25 * 25, -(-max(y for _, y in sides) // 25) * 25
    sx, sy = crs.transform(west + (col + 0.5) * 25, north - (row + 0.5) * 25, 2180, 2178)
    return float((top - sy) // 25 * 8 + (sx - left) // 25)
