"""Hand-computed cases of FIXTURES.md and invariants."""

import functools
import io
import json
import math
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from strataspark import cli
from strataspark.functions import crs, geometry, grid, numeric
from strataspark.operators import catalog, levels, mosaic, plan, stats, warp
from strataspark.sources import archive, ascii, geotiff, index
from strataspark.sources.files import Files
from strataspark.operators.convert import Conversions
from strataspark.store import LayerStore, StoreError, ascii_grid_rows, find_stores, sheets_geojson
from strataspark.streaming.snapshots import follow_index
from strataspark.yearrun import Settings, run_years

HEAD = "ncols 3\nnrows 2\n{0} {1}\n{2} {3}\ncellsize 1\nnodata_value -9999\n1.005 2 -9999\n3.456 4 5.125\n"
SQUARE = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]]


def raster(cells, value="z"):
    return {(r["row"], r["col"]): round(r[value], 4) for r in cells.collect()}


def test_ascii_grid_corner_and_centre(spark):  # F1, F2
    files = spark.createDataFrame([("a.asc", HEAD.format("xllcorner", 500000, "yllcorner", 400000)), ("b.asc", HEAD.format("xllcenter", 500000.5, "yllcenter", 400000.5))], "plik string, text string")
    meta, cells = ascii.read_grid(files)
    assert {(r.left, r.bottom, r.right, r.top, r.ncols, r.nrows) for r in meta.collect()} == {(500000.0, 400000.0, 500003.0, 400002.0, 3, 2)}
    assert raster(cells.where("plik = 'a.asc'")) == {(0, 0): 1.0, (0, 1): 2.0, (1, 0): 3.46, (1, 1): 4.0, (1, 2): 5.12}
    assert [r[0] for r in files.select(ascii.format_of(F.col("text"))).collect()] == ["grid", "grid"]


def test_xyz(spark):  # F3, F4
    text = "X Y Z\n500000.5 400001.5 10.005\n500001.5 400001.5 11.125\n500000.5 400000.5 12\n500001.5 400000.5 13\n500001.5 400000.5 14.375\n"
    meta, cells = ascii.read_xyz(ascii.lines_of(spark.createDataFrame([("N_p.xyz", text), ("N_l.xyz", text)], "plik string, text string")))
    m = meta.collect()
    assert [(r.plik, r.res, r.left, r.top, r.ncols, r.nrows) for r in m] == [("N_p.xyz", 1.0, 500000.0, 400002.0, 2, 2)]
    assert raster(cells) == pytest.approx({(0, 0): 10.0, (0, 1): 11.12, (1, 0): 12.0, (1, 1): 14.38}, abs=0.011)
    names = spark.createDataFrame([("N-33_p.asc",), ("N-33_P.asc",), ("N-33_l.asc",), ("N-33.asc",)], "n string")
    assert [r[0] for r in names.select(ascii.kept_variant(F.col("n"))).collect()] == [True, True, False, True]


def test_grid_algebra(spark):  # F5-F11
    assert tuple(n * 0.5 for n in grid.Lattice(0.5).extent((-3.2, -1.1, -0.4, 0.0))) == (-3.5, -1.5, 0.0, 0.0)
    g = grid.Grid.covering((3.2, 1.1, 17.9, 9.4), 0.5, (10, 20))
    assert g.bounds == (0, 0, 20, 10) and (g.width, g.height) == (40, 20)
    g = grid.Grid.covering((3.2, 1.1, 17.9, 9.4), 1.0)
    assert g.bounds == (3, 1, 18, 10) and (g.width, g.height) == (15, 9) and grid.Grid.from_json(g.to_json()) == g
    assert grid.level_factors(0.5, [5, 20]) == [10, 40]
    for bad in ([0.5], [0.7], [5, 5]):
        with pytest.raises(ValueError):
            grid.level_factors(0.5, bad)
    small = grid.Grid(0, 4, 1.0, 5, 4)
    want = [(0, 2, 0, 2), (0, 2, 2, 4), (0, 2, 4, 5), (2, 4, 0, 2), (2, 4, 2, 4), (2, 4, 4, 5)]
    assert want == [(r.y0, r.y1, r.x0, r.x1) for r in small.blocks(spark, 2).orderBy("by", "bx").collect()]
    pairs = spark.createDataFrame([(0, 0, 2, 2, 2, 0, 4, 2), (0, 0, 2, 2, 1, 1, 3, 3), (0, 0, 2, 2, 3, 0, 4, 2)], [f"{k}_{c}" for k in "ab" for c in grid.SIDES])
    assert [tuple(r) for r in pairs.select(grid.overlaps("a_", "b_"), grid.overlaps("a_", "b_", strict=False)).collect()] == [(False, True), (True, True), (False, False)]
    base = grid.Grid(0, 40, 0.5, 80, 80)
    assert [grid.Level(base, f, 2048).block for f in (1, 10, 40)] == [2048, 204, 128]
    assert [grid.Level(base, f, 2048).name for f in (1, 10)] == ["0.5m", "5m"]
    with pytest.raises(ValueError):
        _ = grid.Level(base, 7, 2048).grid


SHEETS = {"A": (0.5, "2022-01-01", [[1, None, None, None], [2, 3, None, None]]), "B": (1.0, "2020-01-01", [[9, 8, None, None], [9, 9, 7, None]]), "C": (5.0, None, [[5, 5, 5, None], [5, 5, 5, 5]])}


def stacked(spark):
    rows = [(k, d, r, c, float(z) if z is not None else None, res) for k, (res, d, m) in SHEETS.items() for r, line in enumerate(m) for c, z in enumerate(line)]
    return spark.createDataFrame(rows, "plik string, akt_data string, row int, col int, z float, res_src float")


def test_mosaic_levels_shares_and_cover(spark):  # F12-F14, F19
    order = [F.coalesce("akt_data", F.lit(catalog.UNKNOWN_DATE)), F.col("plik")]
    layer = mosaic.first_wins(stacked(spark), ["row", "col"], order, "z", ("res_src",)).cache()
    assert raster(layer) == {(0, 0): 1, (0, 1): 8, (0, 2): 5, (1, 0): 2, (1, 1): 3, (1, 2): 7, (1, 3): 5}
    assert {r.res: r.share for r in stats.resolution_shares(layer).collect()} == {0.5: 0.4286, 1.0: 0.2857, 5.0: 0.2857}
    assert raster(levels.coarsest(layer, 2), "res_src") == {(0, 0): 1, (0, 1): 5}
    assert raster(levels.resample(layer, 2, "average")) == pytest.approx({(0, 0): 3.5, (0, 1): 5.67}, abs=0.001)
    ranked = stacked(spark).where("z is not null").withColumn("rank", F.when(F.col("plik") == "A", 1).when(F.col("plik") == "B", 2).otherwise(3))
    seven = layer.select("row", "col")
    assert stats.covering_prefix(ranked, seven).head() == (3, True)
    assert stats.covering_prefix(ranked, seven.union(spark.createDataFrame([(0, 3)], "row int, col int"))).head() == (3, False)


@pytest.mark.parametrize("method", ["nearest", "bilinear", "cubic", "average"])
def test_levels_keep_a_constant(spark, method):
    flat = spark.range(64).selectExpr("cast(id div 8 as int) as row", "cast(id % 8 as int) as col", "cast(7.25 as float) as z")
    got = raster(levels.resample(flat, 2, method, height=4, width=4))
    assert len(got) == 16 and set(got.values()) == {7.25}


def test_layer_reports(spark):  # F16-F18
    data = [[1, 2, 3, None, None], [1.004, 2.6, None, 4, None], [4, 2.6, 3, 4.01, None]]
    cells = spark.createDataFrame([(i, 0, c, None if z is None else float(z)) for i, line in enumerate(data) for c, z in enumerate(line)], "indeks int, row int, col int, z float")
    got = {r.indeks: (r.n_common, round(r.share_0, 4), round(r.share_1, 4), round(r.share_2, 4)) for r in stats.change_shares(cells).collect()}
    assert got == {1: (2, 0.5, 0.5, 0.0), 2: (3, 0.6667, 0.3333, 0.3333)}
    s = {r.indeks: (round(r.z_min, 3), r.z_mean, round(r.z_max, 3), r.n) for r in stats.layer_stats(cells, "indeks").collect()}
    assert s[0] == (1.0, 2.0, 3.0, 3) and s[1][1] == pytest.approx(2.53467, abs=1e-4) and s[2][1] == pytest.approx(3.4025, abs=1e-4)
    assert {r.indeks: r.coverage for r in stats.coverage(cells, "indeks").collect()} == {0: 0.75, 1: 0.75, 2: 1.0}


def test_time_axis(spark):  # F20
    year = spark.createDataFrame([(2020,)], "y int")
    assert tuple(year.select(*stats.time_axis(F.col("y"))).head()) == (1593561600, 1577836800, 1609459199)
    assert tuple(year.select(*stats.time_axis(F.col("y"), unit="days")).head()) == (18444, 18262, 18628)


def test_crs(spark):  # F21, F22
    for lon, lat, epsg, want in ((19, 52, 2180, (500000.0, 459309.2094)), (21.0122, 52.2297, 2180, (637382.2044, 486757.2095)), (21.0122, 52.2297, 2178, (7500833.5124, 5788456.4865)), (18.57, 54.44, 2177, (6536979.8719, 6034576.9862))):
        assert crs.to_plane(lon, lat, epsg) == pytest.approx(want, abs=1e-3)
        assert crs.to_degrees(*crs.to_plane(lon, lat, epsg), epsg) == pytest.approx((lon, lat), abs=1e-10)
    row = spark.createDataFrame([(7500833.5124, 5788456.4865)], "x double, y double")
    assert tuple(row.select(*crs.transform(F.col("x"), F.col("y"), 2178, 2180, crs.COLUMNS)).head()) == pytest.approx((637382.2044, 486757.2095), abs=1e-3)
    lines = [("a", 0, "# x"), ("a", 1, "6536979.8 6034576.9 1"), ("b", 0, "1, 472120.2; 730752.7 5"), ("c", 0, "4100000 500000 1"), ("d", 0, "x")]
    lines += [("e", 0, "7500833.5 5788456.5 101.2 0"), ("f", 0, "1 472120.2 730752.7"), ("g", 0, "6536979.8 5 1"), ("g", 1, "5 6536979.8 x"), ("g", 200, "6536979.8 6034576.9"), ("h", 0, "6536979.8 6034576.9")]
    got = {r.plik: r.epsg for r in crs.detect(spark.createDataFrame(lines, "plik string, line_no int, text string")).collect()}
    assert got == {"a": 2177, "b": 2180, "c": None, "d": None, "e": 2178, "f": 2180, "g": None, "h": 2177}


def test_detection_takes_the_last_of_equal_numbers_in_file_order(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from strataspark.plans import terrain_queries

    def lines(orders, zone):  # line 3 of every order, in the zone
        n = len(orders)
        return pa.table({"l_orderkey": orders, "l_linenumber": pa.array([3] * n, pa.int32()), "l_partkey": [zone] * n, "l_suppkey": [200] * n, "l_extendedprice": [1000.5] * n, "l_returnflag": ["N"] * n})

    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    pq.write_table(lines([*range(50)], 5), folder / "a.parquet")
    pq.write_table(lines([*range(20_000), *range(30)], 7), folder / "b.parquet")  # the larger file, which Spark reads first
    pq.write_table(lines([*range(30, 40)], 8), folder / "c.parquet")
    want = {k: 2178 for k in range(20_000)} | {k: 2179 for k in range(30, 40)}
    assert {r.plik: r.epsg for r in terrain_queries.crs_detect(spark, str(tmp_path)).collect()} == want


def test_reprojection_returns(spark):
    x, y = crs.to_plane(21.0, 52.0, 2178)
    meta = spark.createDataFrame([("s", 10.0, float(round(x)), float(round(y)), round(x) + 60.0, round(y) + 60.0)], "plik string, res double, left double, bottom double, right double, top double")
    cells = spark.range(36).selectExpr("'s' as plik", "cast(id div 6 as int) as row", "cast(id % 6 as int) as col", "cast(id as float) as z")
    new, moved = mosaic.reprojected(meta, cells, 2178, 2180)
    got = moved.collect()
    assert 30 <= len(got) <= 44 and {r.z for r in got} <= {float(i) for i in range(36)}
    m = new.head()
    assert m.left % 10 == 0 and m.right - m.left == m.ncols * 10


def test_mesh_keeps_its_bound(spark):
    """A sheet as large as a county at 1 m, one of a few pixels, one of a single row; each pixel's place against the full series."""
    x, y = map(round, crs.to_plane(22.4, 53.1, 2180))
    shapes = {"large": (30_000, 20_000), "small": (7, 5), "thin": (3_000, 1)}
    grids = spark.createDataFrame([(k, 1.0, float(x), float(y), w, h) for k, (w, h) in shapes.items()], "plik string, res double, left double, top double, ncols int, nrows int")
    cells = warp.mesh(grids, 2178, 2180)
    by_sheet = {k: [r for r in cells.collect() if r.plik == k] for k in shapes}
    assert len(by_sheet["small"]) == 1 and 4 < len(by_sheet["large"]) < 5_000 and not any(r.bent for rows in by_sheet.values() for r in rows)
    for k, (w, h) in shapes.items():
        assert sum((r.r1 - r.r0) * (r.c1 - r.c0) for r in by_sheet[k]) == w * h
    # The middle, where a cell bends most, and a corner.
    middle = cells.withColumns({"keep": F.expr("array((r0 + r1) div 2, r0)"), "kept": F.expr("array((c0 + c1) div 2, c0)")})
    u, v = F.expr("(col + 0.5D - c0) / (c1 - c0)"), F.expr("(row + 0.5D - r0) / (r1 - r0)")
    picked = middle.select("*", F.explode(F.arrays_zip(F.col("keep").alias("row"), F.col("kept").alias("col"))).alias("at")).select("*", "at.row", "at.col")
    for r in picked.withColumns({"u": u, "v": v}).collect():
        ex, ey = crs.transform(x + r.col + 0.5, y - r.row - 0.5, 2180, 2178)
        for axis, e in (("a", ex), ("b", ey)):
            north, south = r.nw[axis] + (r.ne[axis] - r.nw[axis]) * r.u, r.sw[axis] + (r.se[axis] - r.sw[axis]) * r.u
            assert abs(north + (south - north) * r.v - e) <= warp.TOLERANCE


def test_bent_cells_go_through_the_series(spark):
    x, y = map(round, crs.to_plane(22.4, 53.1, 2180))
    grids = spark.createDataFrame([("s", 1.0, float(x), float(y), 6, 4)], "plik string, res double, left double, top double, ncols int, nrows int")
    cells = warp.mesh(grids, 2178, 2180)
    for bent in (False, True):
        off = warp.centres(cells.withColumn("bent", F.lit(bent)), 2178, 2180).collect()
        assert len(off) == 24
        for r in off:
            ex, ey = crs.transform(x + r.col + 0.5, y - r.row - 0.5, 2180, 2178)
            assert max(abs(r.sx - ex), abs(r.sy - ey)) < (1e-7 if bent else 0.125)


def test_polygon(spark):
    points = spark.createDataFrame([(0.5, 0.5), (1.5, 1.5), (5.0, 1.0), (3.9, 3.9)], "x double, y double")
    assert [r[0] for r in points.select(geometry.contains_point(SQUARE, F.col("x"), F.col("y"))).collect()] == [True, False, False, True]
    cells = spark.range(400).selectExpr("cast(id div 20 as int) as row", "cast(id % 20 as int) as col")
    x, y = F.col("col") * 0.25 + 0.125, F.lit(4.5) - (F.col("row") + 0.5) * 0.25
    want = {(r.row, r.col) for r in cells.where(geometry.contains_point(SQUARE, x, y)).collect()}
    assert {(r.row, r.col) for r in geometry.inside(cells, SQUARE, x, 4.5, -0.25).collect()} == want and len(want) == 240
    boxes = spark.createDataFrame([(4.0, 0.0, 5.0, 1.0), (4.1, 0.0, 5.0, 1.0), (1.2, 1.2, 1.8, 1.8), (-9.0, -9.0, 9.0, 9.0), (3.0, 3.0, 3.1, 3.1)], "left double, bottom double, right double, top double")
    assert {r.left for r in catalog.touching(boxes, SQUARE).collect()} == {4.0, -9.0, 3.0}


def frame(spark, keys):
    return spark.createDataFrame([(k[0], k[2:], 0.0, 0.0, 1.0, 1.0) for k in keys], "plik string, akt_data string, left double, bottom double, right double, top double")


@pytest.mark.parametrize(("old", "new", "status", "skip", "force", "want"), [
    (None, ["a@1", "b@1"], None, [], False, ("nowa", 2, 0, [], None)),
    (["a@1", "b@1"], ["a@1", "b@1"], "kompletna", [], False, ("aktualna", 0, 0, [], None)),
    (["a@1", "b@1"], ["a@2", "b@1"], "kompletna", [], False, ("zmiana", 1, 1, ["a"], 2)),
    (["a@1", "b@1"], ["a@1"], "kompletna", [], False, ("zmiana", 0, 1, [], 1)),
    (["a@1"], ["a@1"], "w_toku", [], False, ("przebudowa", 0, 0, [], None)),
    (["a@1"], ["a@1"], "kompletna", [], True, ("przebudowa", 0, 0, [], None)),
    (["a@1", "b@1"], ["a@1", "b@1", "c@1"], "kompletna", ["c@1"], False, ("aktualna", 0, 0, [], None)),
    (["a@1", "b@1"], ["a@1", "b@1", "c@1"], "kompletna", [], False, ("zmiana", 1, 0, [], 1)),
])
def test_plan(spark, old, new, status, skip, force, want):  # N1-N9
    got = plan.action(frame(spark, new), frame(spark, old) if old else None, status, frame(spark, skip), force)
    assert (got["akcja"], len(got["dodane"]), len(got["usuniete"]), got["zmienione"], got["brudne"] and got["brudne"].count()) == want


def sheet(spark, name, date, left, z, n=4):
    meta = spark.createDataFrame([(name, 1.0, left, 0.0, left + n, float(n), date)], "plik string, res double, left double, bottom double, right double, top double, akt_data string")
    cells = spark.range(n * n).select(F.lit(name).alias("plik"), F.floor(F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"), F.lit(float(z)).cast("float").alias("z"))
    return meta, cells


def test_store_is_incremental_and_recovers(spark, tmp_path):
    a, b, c = sheet(spark, "a", "2020-01-01", 0.0, 1), sheet(spark, "b", "2021-01-01", 2.0, 2), sheet(spark, "b", "2022-01-01", 2.0, 9)
    both = lambda x, y: (x[0].union(y[0]), x[1].union(y[1]))
    g = grid.Grid(0.0, 4.0, 1.0, 8, 4)
    store = LayerStore(spark, str(tmp_path / "s"), block=2).create(g, (2,))
    with pytest.raises(StoreError):
        store.create(g)
    meta, cells = both(a, b)
    assert store.update_year(2020, meta, meta, cells)["akcja"] == "nowa"
    assert store.update_year(2020, meta, meta, cells)["akcja"] == "aktualna"
    assert store.manifest[2020]["status"] == "kompletna" and store.manifest[2020]["udzial_rozdzielczosci"] == {"1": 1.0}
    meta, cells = both(a, c)
    done = store.update_year(2020, meta, meta, cells)
    assert done["akcja"] == "zmiana" and done["zmienione"] == ["b"] and (0, 0) not in done["bloki"]
    fresh = LayerStore(spark, str(tmp_path / "t"), block=2).create(g, (2,))
    fresh.update_year(2020, meta, meta, cells)
    for f in (1, 2):
        assert raster(store.read(2020, f), "nmt") == raster(fresh.read(2020, f), "nmt")
    store.save_record(2020, store.manifest[2020] | {"status": "w_toku"})  # a run that was cut off
    assert store.update_year(2020, meta, meta, cells)["akcja"] == "przebudowa"
    assert "older" in store.update_year(2019, a[0], a[0], a[1])["ostrzezenie"] and store.years() == [2020, 2019]
    assert store.report(1).count() == 2
    assert store.differences(1.0, [2]) == [] and len(store.differences(0.5, [4])) == 2
    assert find_stores(spark, str(tmp_path)) == [f"{tmp_path}/s", f"{tmp_path}/t"]
    axis = store.rewrite_time(bounds=False, unit="days", fragments="one")
    assert "start" not in axis.columns and sorted((r.level, r.rok, r.indeks, r.time) for r in axis.collect()) == [(f, y, i, d) for f in (1, 2) for y, i, d in ((2019, 1, 18078), (2020, 0, 18444))]
    axis = store.rewrite_time("start")
    assert {(r.rok, r.time, r.end) for r in store.time_axis(2).collect()} == {(2020, 1577836800, 1609459199), (2019, 1546300800, 1577836799)} and store.about["czas"]["bounds"] == "time_bnds"
    store.export(str(tmp_path / "out"), year=2019)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 16
    with pytest.raises(KeyError):
        store.read(1999)
    assert ascii_grid_rows(store.read(2019), g, "nmt").orderBy("row").head().line == "1.0 1.0 1.0 1.0 -9999 -9999 -9999 -9999"


def test_archives_and_downloads(spark, tmp_path):
    def zipped(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, text in members.items():
                z.writestr(f"d/{name}.{'xyz' if text else 'pdf'}", text)
        return out.getvalue()

    rows = [("x/a.zip", bytearray(zipped(one="1 2 3"))), ("x/b.zip", bytearray(zipped(two=""))), ("x/c.zip", bytearray(b"no"))]
    found = archive.members(spark.createDataFrame(rows, "path string, content binary")).cache()
    assert {(r.archive, r.member, r.text) for r in found.collect()} == {("a.zip", "one.xyz", "1 2 3"), ("b.zip", "two.pdf", ""), ("c.zip", None, None)}
    assert [r.archive for r in archive.without_ascii(found).collect()] == ["b.zip"]
    several = [("y/d.zip", bytearray(zip_bytes(**{"S_l__xyz": "0", "f/S_p__xyz": "1", "T__xyz": "2"})))]
    first = archive.first_allowed(archive.members(spark.createDataFrame(several, "path string, content binary"))).collect()
    assert [(r.member, r.text) for r in first] == [("S_p.xyz", "1")]
    answers = [(503, "", b""), (200, "text/html", b""), (200, "application/zip", b"x" * 6000)]
    waits = []
    fetch = lambda url, timeout: answers.pop(0)
    assert archive.download("http://h/a.zip", str(tmp_path), fetch, sleep=waits.append) == "done" and waits == [5, 10]
    assert archive.download("http://h/a.zip", str(tmp_path), fetch) == "present"
    assert archive.download("http://h/b.zip", str(tmp_path), lambda *_: (404, "", b""), sleep=waits.append).startswith("failed: status 404")


def test_index_and_config(spark, tmp_path):
    (tmp_path / "i.xml").write_text("""<w:C xmlns:w="u" xmlns:g="v"><w:S><g:boundedBy><g:Envelope><g:lowerCorner>1 2</g:lowerCorner><g:upperCorner>3 4</g:upperCorner></g:Envelope></g:boundedBy><w:godlo>N-33</w:godlo></w:S><w:S><w:godlo>none</w:godlo></w:S></w:C>""")
    rows = index.read_index(spark, str(tmp_path / "i.xml"), "S", 2020).collect()
    assert [(r.godlo, tuple(r.bounds)) for r in rows] == [("N-33", (1.0, 2.0, 3.0, 4.0))]
    names = spark.createDataFrame([("powiat EŁK",), ("powiat ełkx",)], "name string")
    assert index.named(names, "ełk").count() == 1
    (tmp_path / "c.json").write_text('{"cache_dir": ""}')
    with pytest.raises(ValueError):
        index.read_config(str(tmp_path / "c.json"), ("cache_dir",))
    assert index.year_list(" AUTO", 2018, 2020) == [2018, 2019, 2020] == index.year_list("2018, 2019,2020", 0, 0)
    (tmp_path / "b.json").write_text('{"features": [{"properties": {"JPT_NAZWA_": "p"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1]]]]}}]}')
    assert index.read_boundaries(spark, str(tmp_path / "b.json")).head().rings == [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]]


def test_numbers(spark):
    row = spark.createDataFrame([(2.675, 1.005, float("nan"))], "a double, b float, c double").select(numeric.round_half_even(F.col("a")), numeric.nan_to_null(F.col("c")), numeric.short_number_column(F.lit(0.5)), numeric.short_number_column(F.lit(5.0))).head()
    assert tuple(row) == (2.68, None, "0.5", "5")


def test_reissued_archives_are_loaded_anew(spark, tmp_path):
    for name in ("a.zip", "b.zip"):
        (tmp_path / name).write_bytes(b"o" * 6000)
    urls = spark.createDataFrame([("http://h/a.zip",), ("http://h/b.zip",)], "url string")
    again = spark.createDataFrame([("a.zip",)], "plik string")
    got = archive.download_all(urls, str(tmp_path), lambda url, timeout: (200, "application/zip", b"n" * 6000), reissued=again).collect()
    assert {(r.url[-5:], r.result) for r in got} == {("a.zip", "done"), ("b.zip", "present")}
    assert (tmp_path / "a.zip").read_bytes() == b"n" * 6000 and (tmp_path / "b.zip").read_bytes() == b"o" * 6000


def written_blocks(spark, store, year=2020):
    """(level, by, bx) of the last version of each level."""
    last = max(int(n[0]) for vs in store.manifest[year]["wersje"].values() for n in vs)
    found = []
    for level in store.levels():
        where = f"{store._folder(level.factor, year)}/wersja={last}"
        found += [(level.factor, r.by, r.bx) for r in (spark.read.parquet(where).collect() if store.files.exists(where) else [])]
    return sorted(found)


def test_a_change_of_one_sheet_writes_only_touched_blocks_on_every_level(spark, tmp_path):
    parts = [sheet(spark, n, "2020-01-01", left, z, 8) for n, left, z in (("a", 0.0, 1), ("b", 8.0, 2), ("c", 56.0, 3))]
    meta, cells = (parts[0][k].union(parts[1][k]).union(parts[2][k]) for k in (0, 1))
    g = grid.Grid(0.0, 8.0, 1.0, 64, 8)
    store = LayerStore(spark, str(tmp_path / "s"), block=8).create(g, (2,), method="cubic")
    level = grid.Level(g, 2, 8)
    assert level.block == 128  # so the level has one block; a smaller one shows that the others stay
    store.update_year(2020, meta, meta, cells)
    new_meta, new_cells = sheet(spark, "c", "2021-01-01", 56.0, 9, 8)
    meta2, cells2 = parts[0][0].union(parts[1][0]).union(new_meta), parts[0][1].union(parts[1][1]).union(new_cells)
    done = store.update_year(2020, meta2, meta2, cells2)
    assert done["bloki"] == [(0, 7)] and written_blocks(spark, store) == [(1, 0, 7), (2, 0, 0)]
    fresh = LayerStore(spark, str(tmp_path / "t"), block=8).create(g, (2,), method="cubic")
    fresh.update_year(2020, meta2, meta2, cells2)
    for f in (1, 2):
        assert raster(store.read(2020, f), "nmt") == raster(fresh.read(2020, f), "nmt")


def test_level_blocks_far_from_the_change_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(grid.Level, "block", property(lambda self: self.base_block // self.factor))
    parts = [sheet(spark, n, "2020-01-01", left, z, 8) for n, left, z in (("a", 0.0, 1), ("b", 32.0, 2), ("c", 56.0, 3))]
    meta, cells = (parts[0][k].union(parts[1][k]).union(parts[2][k]) for k in (0, 1))
    g = grid.Grid(0.0, 8.0, 1.0, 64, 8)
    changed = sheet(spark, "b", "2021-01-01", 32.0, 9, 8)
    meta2, cells2 = (parts[0][k].union(parts[2][k]).union(changed[k]) for k in (0, 1))
    store, fresh = (LayerStore(spark, str(tmp_path / n), block=8).create(g, (2,)) for n in "st")
    store.update_year(2020, meta, meta, cells)
    done = store.update_year(2020, meta2, meta2, cells2)
    fresh.update_year(2020, meta2, meta2, cells2)
    beside = [(0, 3), (0, 4), (0, 5)]  # their cells weigh changed pixels
    assert done["poziomy"] == {1: [(0, 4)], 2: beside}
    assert written_blocks(spark, store) == [(1, 0, 4), *((2, 0, x) for x in (3, 4, 5))]
    for f in (1, 2):
        assert raster(store.read(2020, f), "nmt") == raster(fresh.read(2020, f), "nmt")


def test_an_orphaned_description_goes_only_when_a_store_is_made(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "s"), block=2).create(grid.Grid(0.0, 4.0, 1.0, 4, 4))
    assert store.exists() and store.about["atrybuty"]["Conventions"] == "CF-1.8"
    (tmp_path / "s" / "warstwy").rmdir()
    assert not store.exists() and list((tmp_path / "s" / "dziennik").glob("*.json"))  # reading removes nothing
    with pytest.warns(UserWarning):
        store.create(grid.Grid(0.0, 4.0, 1.0, 8, 4))
    assert store.grid.width == 8 and store.manifest == {}


def test_two_writers_lose_no_update_and_readers_keep_their_snapshot(spark, tmp_path, monkeypatch):
    a, b, c = sheet(spark, "a", "2020-01-01", 0.0, 1), sheet(spark, "b", "2021-01-01", 0.0, 2), sheet(spark, "a", "2022-01-01", 0.0, 9)
    store = LayerStore(spark, str(tmp_path / "s"), block=2).create(grid.Grid(0.0, 4.0, 1.0, 4, 4), (2,))
    other = LayerStore(spark, store.path, block=2)
    source, first = Files.create, []

    def late(self, path, content):  # each time the first writer is about to commit, another year is committed before it
        if not first:
            first.append(1)
            other.update_year(2021, b[0], b[0], b[1])
        return source(self, path, content)

    monkeypatch.setattr(Files, "create", late)
    assert store.update_year(2020, a[0], a[0], a[1])["akcja"] == "nowa"
    assert {y: (r["indeks"], r["status"]) for y, r in store.manifest.items()} == {2021: (0, "kompletna"), 2020: (1, "kompletna")}
    assert source(store.files, store._entry(1), b"{}") is False and json.loads(store.files.read(store._entry(1)))["warstwy"] == {}
    kept, seen = store.snapshot(), []
    read = LayerStore._only

    def during(self, *args):  # a reader in the middle of an update, and a second writer of the same year
        seen.append(raster(LayerStore(spark, store.path, block=2).read(2020), "nmt"))
        return read(self, *args)

    monkeypatch.setattr(LayerStore, "_only", during)
    assert store.update_year(2020, c[0], c[0], c[1])["akcja"] == "zmiana"
    assert set(seen[0].values()) == {1.0} and len(seen[0]) == 16
    assert set(raster(store.read(2020), "nmt").values()) == {9.0} and set(raster(kept.read(2020), "nmt").values()) == {1.0}
    with pytest.raises(StoreError):
        kept.save_record(2020, {})

    def overtaken(self, *args):
        monkeypatch.setattr(LayerStore, "_only", read)
        other.update_year(2020, a[0], a[0], a[1], force=True)
        return read(self, *args)

    monkeypatch.setattr(LayerStore, "_only", overtaken)
    with pytest.raises(StoreError, match="took over"):
        store.update_year(2020, c[0], c[0], c[1], force=True)
    assert set(raster(store.read(2020), "nmt").values()) == {1.0} and store.manifest[2020]["status"] == "kompletna"
    assert store.clean() and store.clean() == [] and set(raster(store.read(2020), "nmt").values()) == {1.0} and store.read(2021).count() == 16
    with pytest.raises(StoreError):
        kept.read(2020)


def test_versions_are_written_together(spark, tmp_path, monkeypatch):
    from strataspark import store as stores

    monkeypatch.setattr(stores, "MOST_VERSIONS", 2)
    store = LayerStore(spark, str(tmp_path / "s"), block=2).create(grid.Grid(0.0, 4.0, 1.0, 8, 4))
    left = sheet(spark, "l", "2020-01-01", 0.0, 1)
    for k in range(4):
        right = sheet(spark, "r", f"202{k}-01-01", 4.0, k)
        store.update_year(2020, left[0].union(right[0]), left[0].union(right[0]), left[1].union(right[1]))
        assert {v for (_, c), v in raster(store.read(2020), "nmt").items() if c >= 4} == {float(k)} and store.read(2020).count() == 32
        assert len(store.manifest[2020]["wersje"]["1"]) <= 2
    assert store.manifest[2020]["wersje"]["1"][0][0].endswith("-razem")


def zip_bytes(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "."), text)
    return out.getvalue()


def grid_text(left, bottom, z, n=4):
    return f"ncols {n}\nnrows {n}\nxllcorner {left}\nyllcorner {bottom}\ncellsize 1\nnodata_value -9999\n" + "\n".join([f"{z} " * n] * n)


def test_year_run_from_archives_to_layers(spark, tmp_path):
    east, north = crs.to_plane(*crs.to_degrees(500004.0, 400000.0, 2180), 2177)
    xyz = "".join(f"{round(east) + x + 0.5} {round(north) + y + 0.5} 30\n" for x in range(6) for y in range(6))
    served = {
        "a.zip": zip_bytes(A__asc=grid_text(500000, 400000, 1)), "b.zip": zip_bytes(**{"d/B_p__xyz": xyz, "d/B_l__xyz": xyz}),
        "c.zip": b"no archive " * 600, "d.zip": zip_bytes(readme__pdf="x"), "e.zip": zip_bytes(E__asc=grid_text(500000, 400000, 7)),
    }
    asked = []

    def index_of(dates):
        rows = [(2019 if n == "e" else 2020, f"{n}.zip", f"http://h/{n}.zip", 2177 if n == "b" else 2180, d, 500000.0, 400000.0, 500008.0, 400008.0) for n, d in dates.items()]
        return spark.createDataFrame(rows, "rok int, plik string, url string, epsg int, akt_data string, left double, bottom double, right double, top double")

    def fetch(url, timeout):
        with open(tmp_path / "asked", "a") as f:
            f.write(url + "\n")
        body = served[url.rsplit("/", 1)[-1]]
        return 200, "application/zip", body + b" " * 6000

    rings = [[(500000.0, 400000.0), (500008.0, 400000.0), (500008.0, 400008.0), (500000.0, 400008.0)]]
    settings = Settings.of({"poziomy": [2], "blok_px": 4})
    dates = {"a": "2020-01-01", "b": "2020-02-01", "c": "2020-01-01", "d": "2020-01-01", "e": "2019-01-01"}
    done = run_years(spark, index_of(dates), rings, settings, str(tmp_path / "w"), fetch, "X")
    assert {y: d["akcja"] for y, d in done.items()} == {2019: "nowa", 2020: "nowa"}
    store = LayerStore(spark, str(tmp_path / "w" / "store"), 4)
    assert store.manifest[2020]["pominiete"] == ["c.zip"] and [r["plik"] for r in store.manifest[2020]["nieobslugiwane"]] == ["d.zip"]
    values = raster(store.read(2020), "nmt")
    assert set(values.values()) == {1.0, 30.0} and values[7, 0] == 1.0 and values[7, 5] == 30.0
    asked = (tmp_path / "asked").read_text().split()
    assert sorted(asked) == sorted(f"http://h/{n}.zip" for n in dates)
    dates["a"] = "2021-01-01"
    served["a.zip"] = zip_bytes(A__asc=grid_text(500000, 400000, 5))
    done = run_years(spark, index_of(dates), rings, settings, str(tmp_path / "w"), fetch, "X")
    assert done[2019]["akcja"] == "aktualna" and done[2020]["akcja"] == "zmiana" and done[2020]["zmienione"] == ["a.zip"]
    assert (tmp_path / "asked").read_text().split()[len(asked):] == ["http://h/a.zip"]  # the others are present
    assert set(raster(store.read(2020), "nmt").values()) == {5.0, 30.0} or set(raster(store.read(2020), "nmt").values()) == {5.0}
    meta, _ = Conversions(spark, str(tmp_path / "w" / "rok=2020" / "converted")).read()
    assert {(r.member, r.plik, r.akt_data) for r in meta.collect()} == {("A.asc", "a.zip", "2021-01-01"), ("B_p.xyz", "b.zip", "2020-02-01")}
    raw = run_years(spark, index_of({"a": "2021-01-01"}), rings, Settings(convert=False), str(tmp_path / "raw"), fetch)
    assert {d["akcja"] for d in raw.values()} == {"surowe"} and (tmp_path / "raw" / "rok=2020" / "archives" / "a.zip").exists()
    single = run_years(spark, index_of({"a": "2021-01-01"}), rings, Settings(store=False, mosaic=True), str(tmp_path / "m"), fetch)
    assert single[2020]["komorka"] == 1.0
    assert set(raster(geotiff.read(spark, str(tmp_path / "m" / "mosaics" / "2020.tif"), "pixels")).values()) >= {5.0}
    for wrong in ({"zarr": True, "geotiff": True}, {"resampling_poziomow": "x"}, {"rozdzielczosc": 2.0, "poziomy": [3]}):
        with pytest.raises(ValueError):
            Settings.of(wrong)
    with pytest.warns(UserWarning):
        raw = Settings.of({"konwersja": False, "geotiff": True, "zarr": True})
    assert not raw.store and not raw.mosaic and not raw.convert and raw.download


def test_cli_geojson_texts_stream_and_cached_boundaries(spark, tmp_path, capsys):
    meta, cells = sheet(spark, "a", "2020-01-01", 0.0, 1)
    store = LayerStore(spark, str(tmp_path / "s"), block=2).create(grid.Grid(0.0, 4.0, 1.0, 4, 4), (2,))
    store.update_year(2020, meta, meta, cells)
    assert cli.main(["info", store.path]) == 0 and "2020: 100.0% covered" in capsys.readouterr().out
    assert cli.main(["export", store.path, "--out", str(tmp_path / "out"), "--factor", "2"]) == 0 and spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert cli.main(["time", store.path, "--unit", "days", "--bounds", "no"]) == 0 and "18444" in capsys.readouterr().out
    box = spark.createDataFrame([("a", None, 500000.0, 400000.0, 500100.0, 400100.0)], "plik string, akt_data string, left double, bottom double, right double, top double")
    feature = sheets_geojson(box).head().feature
    assert '"akt_data":""' in feature and feature.count("[") == 7 and "18.99999" not in feature.split("coordinates")[1][:8]
    (tmp_path / "t" / "x").mkdir(parents=True)
    for name in ("one.ASC", "two.pdf"):
        (tmp_path / "t" / "x" / name).write_text("ncols 1")
    assert [(r.plik, r.text) for r in archive.read_texts(spark, str(tmp_path / "t")).collect()] == [("one.ASC", "ncols 1")]
    kept = str(tmp_path / "b.json")
    shape = b'{"features": [{"properties": {"JPT_NAZWA_": "p"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}}]}'
    assert index.cached_boundaries(spark, kept, lambda: shape).count() == 1 == index.cached_boundaries(spark, kept).count()
    (tmp_path / "snap").mkdir()
    (tmp_path / "snap" / "1.json").write_text('{"rok": 2020, "plik": "a"}\n{"rok": 2021, "plik": "b"}\n')
    seen = []
    query = follow_index(spark, str(tmp_path / "snap"), "rok int, plik string", str(tmp_path / "cp"), lambda year, rows: seen.append((year, rows.count())))
    query.awaitTermination()
    assert seen == [(2020, 1), (2021, 1)]


def test_dense_ordinals_and_dates(spark):
    rows = spark.createDataFrame([(v, k) for k, v in enumerate([3, 1, None, 3, 7, 7, 2, 9])], "v int, k int")
    for descending in (False, True):
        got = {r.k: (r.v, r.n) for r in catalog.dense_ordinals(rows, ["v"], "n", descending).collect()}
        order = sorted({v for v, _ in got.values()}, key=lambda v: (v is not None, v or 0), reverse=descending)
        assert all(order[n] == v for v, n in got.values())
    assert catalog.dense_ordinals(rows.limit(0), ["v"], "n").count() == 0
    dates = spark.createDataFrame([("2020-01-02",), ("x",), (None,)], "d string").select(catalog.iso_date(F.col("d")), catalog.shown(F.col("d")))
    assert [tuple(r) for r in dates.collect()] == [("2020-01-02", "2020-01-02"), ("", "x"), ("", "")]
    two = spark.createDataFrame([("s", "2020-01-01", 1), ("r", "2020-01-01", 2), ("q", None, 3)], "plik string, akt_data string, seq int")
    assert [r.plik for r in two.orderBy(*catalog.newest_first()).collect()] == ["s", "r", "q"]
    assert [r.plik for r in two.orderBy(*catalog.newest_first(path_descending=False)).collect()] == ["s", "r", "q"]


def test_boxes_meet_on_lattices_by_size(spark):
    def frame_of(boxes):
        return spark.createDataFrame([(k, *map(float, b)) for k, b in enumerate(boxes)], ["k", *grid.SIDES])

    rng = random.Random(5)
    some = lambda n: [(x := rng.randint(-40, 40) / 4, y := rng.randint(-40, 40) / 4, x + rng.choice([0, 0.25, 1, 3, 17]), y + rng.choice([0, 0.25, 1, 9])) for _ in range(n)]
    a, b = some(120), some(90)
    for strict in (True, False):
        le = (lambda p, q: p < q) if strict else (lambda p, q: p <= q)
        want = sorted((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if le(p[0], q[2]) and le(q[0], p[2]) and le(p[1], q[3]) and le(q[1], p[3]))
        assert sorted((r.k, r.d_k) for r in plan.meeting(frame_of(a), frame_of(b), strict).collect()) == want
    assert plan.meeting(frame_of(a), frame_of(b).limit(0)).count() == 0
    # One large sheet among many small ones brings no small ones together.
    small = [(x, y, x + 1, y + 1) for x in range(0, 100, 2) for y in range(0, 80, 2)]
    met = plan.meeting(frame_of([*small, (0, 0, 5000, 5000)]), frame_of([*((x + 0.5, y + 0.5, r, t) for x, y, r, t in small), (0, 0, 4000, 4000)]))
    assert met.count() == 3 * len(small) + 1
    joined = max(int(n) for n in re.findall(r"Join.*?number of output rows: ([\d,]+)", ran(met)) or ["0"])
    assert joined < 40 * len(small)


def ran(df):
    """Rows that each operator of the executed plan gave."""
    plan_ = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    out, todo = [], [plan_]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        metrics = node.metrics()
        if metrics.contains("numOutputRows"):
            out.append(f"{name} number of output rows: {metrics.apply('numOutputRows').value()}")
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return "\n".join(out)


def test_the_mosaic_of_sheets_is_a_hash_aggregate(spark):
    parts = [sheet(spark, n, d, left, z) for n, d, left, z in (("a", "2020-01-01", 0.0, 1), ("b", "2020-01-01", 2.0, 2), ("c", None, 0.0, 3), ("d", None, 4.0, 4))]
    meta, cells = (functools.reduce(lambda x, y: x.union(y), (p[k] for p in parts)) for k in (0, 1))
    g = grid.Grid(0.0, 4.0, 1.0, 8, 4)
    layer = mosaic.base_layer(meta, cells, g)
    shown = layer._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate(key=[row" not in shown and shown.count("HashAggregate(keys=[row") == 2
    found, other = raster(layer), raster(mosaic.base_layer(meta, cells, g, path_descending=False))
    assert [found[0, c] for c in range(8)] == [1, 1, 2, 2, 2, 2, 4, 4] and [other[0, c] for c in range(8)] == [1, 1, 1, 1, 2, 2, 4, 4]
    order = [F.coalesce(F.col("akt_data"), F.lit(catalog.UNKNOWN_DATE)), F.col("plik")]
    assert found == raster(mosaic.first_wins(mosaic.on_grid(meta, cells, g), ["row", "col"], order))


def clipped(e, b):
    """Whether a segment shares a point with a box, by clipping."""
    x1, y1, x2, y2 = e
    lo, hi = 0.0, 1.0
    for d, s, a, z in ((x2 - x1, x1, b[0], b[2]), (y2 - y1, y1, b[1], b[3])):
        if d == 0:
            if not a <= s <= z:
                return False
        else:
            t = sorted(((a - s) / d, (z - s) / d))
            lo, hi = max(lo, t[0]), min(hi, t[1])
    return lo <= hi


def test_boxes_are_classed_against_a_polygon(spark):
    rng = random.Random(2)
    star = [(50 + (40 if k % 2 else 15 + rng.randint(0, 10)) * math.cos(k * math.pi / 60), 50 + (40 if k % 2 else 20) * math.sin(k * math.pi / 60)) for k in range(120)]
    rings = [star, [(48.0, 48.0), (52.0, 48.0), (52.0, 52.0), (48.0, 52.0)]]
    boxes = [(x := rng.randint(0, 400) / 4, y := rng.randint(0, 400) / 4, x + rng.choice([0.25, 1, 8, 30]), y + rng.choice([0.25, 1, 8])) for _ in range(400)]
    boxes += [(48.0, 48.0, 49.0, 49.0), (49.0, 49.0, 51.0, 51.0), (0.0, 0.0, 100.0, 100.0), (-9.0, -9.0, -8.0, -8.0)]
    frame_ = spark.createDataFrame([(k, *map(float, b)) for k, b in enumerate(boxes)], ["k", *grid.SIDES])
    found = {r.k: r.place for r in geometry.classed(frame_, rings, ["k"]).collect()}

    def expected(b):
        every = geometry.edges(rings)
        if any(clipped(e, b) for e in every):
            return "boundary"
        x, y = (b[0] + b[2]) / 2, (b[1] + b[3]) / 2
        odd = sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for x1, y1, x2, y2 in every) % 2
        return "inside" if odd else "outside"

    assert found == {k: expected(b) for k, b in enumerate(boxes)} and set(found.values()) == {"inside", "outside", "boundary"}
    twice = frame_.union(frame_)
    assert sorted(r.k for r in catalog.touching(twice, rings).collect()) == sorted(2 * [k for k, p in found.items() if p != "outside"])
    # A long boundary: 50,000 edges, most of them met by few boxes.
    n = 50_000
    round_ = [[(50_000 + 40_000 * math.cos(2 * math.pi * k / n), 50_000 + 40_000 * math.sin(2 * math.pi * k / n)) for k in range(n)]]
    blocks = grid.Grid(0.0, 100_000.0, 10.0, 10_000, 10_000).blocks(spark, 500)
    for r in geometry.classed(blocks, round_, ["by", "bx"]).collect():
        corners = [math.hypot(x - 50_000, y - 50_000) for x in (r.left, r.right) for y in (r.bottom, r.top)]
        near = math.hypot(max(r.left - 50_000, 0, 50_000 - r.right), max(r.bottom - 50_000, 0, 50_000 - r.top))
        want = "inside" if max(corners) < 39_999 else "outside" if near > 40_001 else "boundary" if near < 39_999 and max(corners) > 40_001 else None
        assert want in (None, r.place)  # a box whose corner is about on the circle may be either


def test_blocks_outside_the_county_are_not_built(spark, tmp_path):
    parts = [sheet(spark, n, "2020-01-01", left, z, 8) for n, left, z in (("a", 0.0, 1), ("b", 8.0, 2), ("c", 16.0, 3))]
    meta, cells = (functools.reduce(lambda x, y: x.union(y), (p[k] for p in parts)) for k in (0, 1))
    store = LayerStore(spark, str(tmp_path / "s"), block=8).create(grid.Grid(0.0, 8.0, 1.0, 24, 8))
    rings = [[(1.0, 1.0), (7.0, 1.0), (7.0, 7.0), (1.0, 7.0)]]
    store.update_year(2020, meta, meta, cells, rings)
    assert {(r.by, r.bx, r.n) for r in store.chunks(2020).collect()} == {(0, 0, 36)}
    assert raster(store.read(2020), "nmt") == {(r, c): 1.0 for r in range(1, 7) for c in range(1, 7)}


def test_coordinates_and_migration_of_format_1(spark, tmp_path):
    a = sheet(spark, "a", "2020-01-01", 0.0, 1)
    store = LayerStore(spark, str(tmp_path / "s"), block=2).create(grid.Grid(0.0, 4.0, 1.0, 4, 4), (2,))
    store.update_year(2020, a[0], *a)
    assert {(r.axis, r.n, r.at) for r in store.coordinates(2).collect()} == {("x", 0, 1.0), ("x", 1, 3.0), ("y", 0, 3.0), ("y", 1, 1.0)}
    old = LayerStore(spark, str(tmp_path / "old"), block=2)
    with pytest.raises(StoreError):
        old.migrate()
    for f in (1, 2):  # as format 1 had it
        store.read(2020, f).drop("level", "rok").write.partitionBy("by", "bx").parquet(f"{old.path}/warstwy/level={f}/rok=2020")
    data = store._load()
    data["opis"]["wersja_formatu"] = 1
    data["warstwy"]["2020"].pop("wersje")
    (tmp_path / "old" / "opis.json").write_text(json.dumps(data))
    with pytest.raises(StoreError):
        old.create(grid.Grid(0.0, 4.0, 1.0, 4, 4))
    old.migrate()
    assert not (tmp_path / "old" / "opis.json").exists() and old.update_year(2020, a[0], *a)["akcja"] == "aktualna"
    for f in (1, 2):
        assert raster(old.read(2020, f), "nmt") == raster(store.read(2020, f), "nmt") and old.clean() == []


def test_a_damaged_member_makes_its_archive_corrupt(spark):
    whole = bytearray(zip_bytes(A__asc="1 2 3 4 5 6 7 8 9", B__asc="x"))
    broken = bytearray(whole)
    broken[40] ^= 0xFF
    found = archive.members(spark.createDataFrame([("d/w.zip", whole), ("d/b.zip", broken), ("d/n.zip", None)], "path string, content binary")).collect()
    assert [(r.member, r.place) for r in found if r.archive == "w.zip"] == [("A.asc", 0), ("B.asc", 1)]
    assert [(r.member, r.error is not None) for r in found if r.archive == "b.zip"] == [(None, True)]
