"""Raster files: fixed bytes, round trips, header scans."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataspark.functions.grid import Grid
from strataspark.operators import chunks
from strataspark.sources import geotiff
from strataspark.store import LayerStore
from tests.test_terrain import raster, sheet


def test_head_has_the_bytes_of_the_format():
    held = geotiff.Raster(Grid(500000.0, 400032.0, 2.0, 40, 16), 16, (("akt_data", "2020-01-01"),))
    place, size = np.array([0, 0, 7]), np.array([7, 0, 9])
    head = held.head(place, size)
    assert head[:10] == b"II*\0\x08\0\0\0" + struct.pack("<H", 17)
    entries = [struct.unpack_from("<HHII", head, 10 + 12 * k) for k in range(17)]
    assert [e[0] for e in entries] == sorted(e[0] for e in entries)  # the format wants them ascending
    at = {t: (kind, n, v) for t, kind, n, v in entries}
    assert at[256] == (4, 1, 40) and at[257] == (4, 1, 16) and at[258] == (3, 1, 32) and at[259] == (3, 1, 8) and at[322] == (3, 1, 16) and at[339] == (3, 1, 3)
    assert struct.unpack_from("<3I", head, at[324][2]) == (len(head), 0, len(head) + 7) and struct.unpack_from("<3I", head, at[325][2]) == (7, 0, 9)
    assert struct.unpack_from("<3d", head, at[33550][2]) == (2.0, 2.0, 0.0) and struct.unpack_from("<6d", head, at[33922][2]) == (0, 0, 0, 500000.0, 400032.0, 0)
    assert struct.unpack_from("<16H", head, at[34735][2]) == (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, 2180)
    assert head[at[42112][2] :].startswith(b'<GDALMetadata><Item name="akt_data">2020-01-01</Item></GDALMetadata>\0')
    assert at[42113] == (2, 4, int.from_bytes(b"nan\0", "little")) and len(head) % 2 == 0
    big = held.head(place, size, big=True)
    assert big[:16] == b"II+\0\x08\0\0\0" + struct.pack("<Q", 16) and struct.unpack_from("<Q", big, 16) == (17,)


@pytest.mark.parametrize("big", [False, True])
def test_heads_read_back_without_pixels(tmp_path, big):
    held = geotiff.Raster(Grid(-3.5, 7.0, 0.5, 300, 17, 2177), 16, (("a", "<&>"), ("b", "ż")))
    size = np.arange(held.tiles)
    (tmp_path / "f.tif").write_bytes(held.head(np.cumsum(size) - size, size, big))  # no pixel follows
    fs, where = geotiff.opened(str(tmp_path / "f.tif"))
    with fs.open_input_file(where) as source:
        found, place, sizes = geotiff.read_head(source)
    assert found == held and (sizes == size).all() and (np.diff(place[1:]) == size[1:-1]).all()
    (tmp_path / "g.tif").write_bytes(b"MM\0*" + b"\0" * 30)
    with fs.open_input_file(str(tmp_path / "g.tif")) as source, pytest.raises(ValueError, match="little-endian"):
        geotiff.read_head(source)


@pytest.mark.parametrize(("height", "width", "block"), [(40, 70, 32), (50, 33, 20), (5, 3, 2), (600, 530, 512)])
def test_round_trip(spark, tmp_path, height, width, block):
    rng = np.random.default_rng(block)
    n = min(height * width // 2, 3000)
    at = rng.choice(height * width, n, replace=False)
    rows = [(2020, int(p // width), int(p % width), float(np.float32(z)), 1.0) for p, z in zip(at, rng.normal(size=n) * 100, strict=True) if not 16 <= p % width < 32]
    layout, grid = chunks.Layout(height, width, block), Grid(10.0, 20.0, 0.5, width, height)
    cells = spark.createDataFrame(rows, "rok int, row int, col int, nmt float, res_src float").repartition(3)
    path = str(tmp_path / "out.tif")
    for uri in (path, f"file://{path}"):
        geotiff.write(chunks.packed(cells, layout), layout, grid, uri, tags={"rok": "2020"})
    assert [p.name for p in tmp_path.iterdir()] == ["out.tif"]
    assert {(r.row, r.col, r.z) for r in geotiff.read(spark, path, "pixels").collect()} == {(r, c, z) for _, r, c, z, _ in rows}
    head = geotiff.read(spark, str(tmp_path)).collect()
    assert [(h.plik, h.res, h.left, h.top, h.ncols, h.nrows, h.epsg, h.tags) for h in head] == [("out.tif", 0.5, 10.0, 20.0, width, height, 2180, {"rok": "2020"})]
    assert head[0].right == 10.0 + 0.5 * width and head[0].bottom == 20.0 - 0.5 * height


def test_tiles_are_those_of_the_format(spark, tmp_path):
    layout, grid = chunks.Layout(16, 32, 16), Grid(0.0, 16.0, 1.0, 32, 16)
    cells = spark.createDataFrame([(2020, 15, 31, 2.5, 1.0)], "rok int, row int, col int, nmt float, res_src float")
    geotiff.write(chunks.packed(cells, layout), layout, grid, str(tmp_path / "o.tif"))
    raw = (tmp_path / "o.tif").read_bytes()
    at = {e[0]: e for e in (struct.unpack_from("<HHII", raw, 10 + 12 * k) for k in range(16))}
    place, size = struct.unpack_from("<2I", raw, at[324][3]), struct.unpack_from("<2I", raw, at[325][3])
    tile = np.frombuffer(zlib.decompress(raw[place[1] : place[1] + size[1]]), "<f4").reshape(16, 16)
    assert place[0] == size[0] == 0 and place[1] + size[1] == len(raw) and tile[15, 15] == 2.5 and np.isnan(tile).sum() == 255
    spark.dataSource.register(geotiff.GeoTiff)
    held = geotiff.Raster(grid, 16).to_json()
    one = spark.createDataFrame([(0, zlib.compress(np.zeros((16, 16), "<f4").tobytes()))], "tile long, data binary")
    with pytest.raises(Exception, match="there is a file"):
        one.write.format("geotiff").option("raster", held).mode("append").save(str(tmp_path / "o.tif"))
    assert (tmp_path / "o.tif").read_bytes() == raw and len(list(tmp_path.iterdir())) == 1
    one.limit(0).write.format("geotiff").option("raster", held).mode("overwrite").save(str(tmp_path / "e.tif"))
    assert geotiff.read(spark, str(tmp_path / "e.tif"), "pixels").count() == 0 and geotiff.read(spark, str(tmp_path / "none")).count() == 0


def test_sheets_and_store_years_as_files(spark, tmp_path):
    (m1, c1), (m2, c2) = sheet(spark, "a", "2020-01-01", 0.0, 1), sheet(spark, "b", None, 4.0, 2)
    named = m1.union(m2).withColumns({"ncols": F.lit(4), "nrows": F.lit(4), "epsg": F.lit(2177)}).withColumnRenamed("plik", "member")
    done = geotiff.write_sheets(named, c1.union(c2).withColumnRenamed("plik", "member"), str(tmp_path / "sheets"))
    assert sorted((r.member, r.n) for r in done.collect()) == [("a", 16), ("b", 16)]
    meta = {r.plik: r for r in geotiff.read(spark, str(tmp_path / "sheets")).collect()}
    assert (meta["b.tif"].left, meta["b.tif"].top, meta["b.tif"].res, meta["b.tif"].tags) == (4.0, 4.0, 1.0, {"akt_data": "", "epsg": "2177"}) and meta["a.tif"].tags["akt_data"] == "2020-01-01"
    store = LayerStore(spark, str(tmp_path / "s"), block=2).create(Grid(0.0, 4.0, 1.0, 8, 4), (2,))
    both = m1.union(m2), c1.union(c2)
    store.update_year(2020, both[0], *both)
    made = store.export_geotiff(str(tmp_path / "out"), factor=2)
    assert made == [f"{tmp_path}/out/s_2m_2020.tif"] and store.export_geotiff(str(tmp_path / "out"), value="res_src", year=2020) == [f"{tmp_path}/out/s_rozdzielczosc_zrodla_2020.tif"]
    assert raster(geotiff.read(spark, made[0], "pixels")) == raster(store.read(2020, 2), "nmt")
    assert geotiff.read(spark, made[0]).head().res == 2.0
    with pytest.raises(KeyError):
        store.export_geotiff(str(tmp_path / "out"), year=1999)
