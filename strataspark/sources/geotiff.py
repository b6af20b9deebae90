"""GeoTIFF files (K1, K3, K9, G14, S12): a sink of tiled single-band rasters, and a source that reads headers or pixels.

A raster of any size is one file. Its tiles are cut and deflated in tasks, which append them to files of their own; the
commit lays these one after the other behind a directory that is made from their sizes. It copies compressed bytes in
pieces and holds one number per tile, no pixels. Tiles without data are not stored, which readers take for missing.

Header scans read the directory of a file by ranged reads and never its pixels. Files go through Arrow's file systems, on
executors too, so a path may be a mounted folder or a URI that Arrow knows. Files are classic TIFF, or BigTIFF from 4 GiB.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from strataspark.functions.grid import Grid
from strataspark.operators import chunks
from strataspark.sources.files import opened

#: Largest side of a tile; sides are multiples of ``TILE_STEP``, as the format has them.
TILE, TILE_STEP = 256, 16
PIECE = 1 << 22

# Fixed values of the format: tags, types, and the keys of a projected system whose pixels are areas.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, SAMPLES, PLANAR = 256, 257, 258, 259, 262, 277, 284
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_SIZES, SAMPLE_FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS, METADATA, NO_DATA = 33550, 33922, 34735, 42112, 42113
ASCII, SHORT, LONG, DOUBLE, LONG8 = 2, 3, 4, 12, 16
DEFLATE, FLOATS, BLACK_IS_ZERO, CHUNKY = 8, 3, 1, 1
FORMAT = {ASCII: "s", SHORT: "H", LONG: "I", DOUBLE: "d", LONG8: "Q"}
MODEL_TYPE, RASTER_TYPE, PROJECTED_SYSTEM, PROJECTED, PIXEL_IS_AREA = 1024, 1025, 3072, 1, 1


def tile_side(width: int, height: int) -> int:
    return max(TILE_STEP, min(TILE, width, height) // TILE_STEP * TILE_STEP)


@dataclass(frozen=True)
class Raster:
    """What a file says of itself, but for where its tiles lie."""

    grid: Grid
    tile: int
    tags: tuple[tuple[str, str], ...] = ()

    @property
    def across(self) -> int:
        return -(-self.grid.width // self.tile)

    @property
    def tiles(self) -> int:
        return self.across * -(-self.grid.height // self.tile)

    def to_json(self) -> str:
        return json.dumps({"grid": json.loads(self.grid.to_json()), "tile": self.tile, "tags": dict(self.tags)})

    @classmethod
    def from_json(cls, text: str) -> Raster:
        held = json.loads(text)
        return cls(Grid(**held["grid"]), held["tile"], tuple(held["tags"].items()))

    def head(self, place: np.ndarray, size: np.ndarray, big: bool | None = None) -> bytes:
        """Header and directory of a file whose tiles follow at ``place``, counted from the end of what this returns; size
        0: no tile. ``big``: BigTIFF, by default where the file needs it."""
        if big is None:
            big = int(size.sum()) + 32 * len(size) + 65536 >= 1 << 32
        g, kind = self.grid, LONG8 if big else LONG
        about = ElementTree.Element("GDALMetadata")
        for name, value in self.tags:
            ElementTree.SubElement(about, "Item", name=name).text = value
        keys = [1, 1, 0, 3, MODEL_TYPE, 0, 1, PROJECTED, RASTER_TYPE, 0, 1, PIXEL_IS_AREA, PROJECTED_SYSTEM, 0, 1, g.epsg]
        entries = [
            (WIDTH, LONG, [g.width]), (HEIGHT, LONG, [g.height]), (BITS, SHORT, [32]), (COMPRESSION, SHORT, [DEFLATE]), (PHOTOMETRIC, SHORT, [BLACK_IS_ZERO]),
            (SAMPLES, SHORT, [1]), (PLANAR, SHORT, [CHUNKY]), (TILE_WIDTH, SHORT, [self.tile]), (TILE_HEIGHT, SHORT, [self.tile]), (TILE_OFFSETS, kind, None), (TILE_SIZES, kind, size),
            (SAMPLE_FORMAT, SHORT, [FLOATS]), (PIXEL_SCALE, DOUBLE, [g.cellsize, g.cellsize, 0.0]), (TIE_POINT, DOUBLE, [0.0, 0.0, 0.0, g.left, g.top, 0.0]), (GEO_KEYS, SHORT, keys),
            *([(METADATA, ASCII, ElementTree.tostring(about) + b"\0")] if self.tags else []), (NO_DATA, ASCII, b"nan\0"),
        ]
        width = 8 if big else 4
        raw = {t: v if k == ASCII else np.asarray(v if v is not None else np.zeros(len(size)), f"<{FORMAT[k].replace('d', 'f8').replace('H', 'u2').replace('I', 'u4').replace('Q', 'u8')}").tobytes() for t, k, v in entries}
        start = (16 + 8 + 20 * len(entries) + 8) if big else (8 + 2 + 12 * len(entries) + 4)
        at, end = {}, start
        for tag, _, _ in entries:
            if len(raw[tag]) > width:
                at[tag], end = end, end + len(raw[tag]) + len(raw[tag]) % 2
        raw[TILE_OFFSETS] = np.where(size > 0, place + end, 0).astype("<u8" if big else "<u4").tobytes()
        out = [struct.pack("<2sHHHQQ", b"II", 43, 8, 0, 16, len(entries)) if big else struct.pack("<2sHIH", b"II", 42, 8, len(entries))]
        for tag, k, _ in entries:
            count = len(raw[tag]) // struct.calcsize(FORMAT[k])
            value = struct.pack("<Q" if big else "<I", at[tag]) if tag in at else raw[tag].ljust(width, b"\0")
            out.append(struct.pack("<HHQ" if big else "<HHI", tag, k, count) + value)
        out.append(b"\0" * width)  # no further directory
        out += [raw[tag] + b"\0" * (len(raw[tag]) % 2) for tag, _, _ in entries if tag in at]
        return b"".join(out)


def read_head(source: pa.NativeFile) -> tuple[Raster, np.ndarray, np.ndarray]:
    """(raster, tile offsets, tile sizes) of a file as this module writes it, by ranged reads of its directory."""

    def get(offset: int, n: int) -> bytes:
        source.seek(offset)
        return source.read(n)

    first = get(0, 16)
    if first[:2] != b"II" or first[2] not in (42, 43):
        raise ValueError("no little-endian TIFF")
    big = first[2] == 43
    where = struct.unpack("<Q" if big else "<I", first[8:16] if big else first[4:8])[0]
    step, count_size = (20, 8) if big else (12, 2)
    count = int.from_bytes(get(where, count_size), "little")
    table = get(where + count_size, step * count)
    found: dict[int, np.ndarray | bytes] = {}
    for k in range(count):
        tag, kind, n = struct.unpack_from("<HHQ" if big else "<HHI", table, step * k)
        if kind not in FORMAT:
            continue
        own = table[step * (k + 1) - (8 if big else 4) : step * (k + 1)]
        size = n * struct.calcsize(FORMAT[kind])
        raw = own[:size] if size <= len(own) else get(int.from_bytes(own, "little"), size)
        found[tag] = raw if kind == ASCII else np.frombuffer(raw, {SHORT: "<u2", LONG: "<u4", DOUBLE: "<f8", LONG8: "<u8"}[kind])
    if TILE_OFFSETS not in found or found[COMPRESSION][0] != DEFLATE or found[BITS][0] != 32 or found[SAMPLE_FORMAT][0] != FLOATS:
        raise ValueError("no tiled raster of deflated floats")
    keys = found.get(GEO_KEYS, np.zeros(4, int)).reshape(-1, 4)
    epsg = next((int(v) for key, _, _, v in keys[1:] if key == PROJECTED_SYSTEM), 0)
    tie = found[TIE_POINT]
    grid = Grid(float(tie[3]), float(tie[4]), float(found[PIXEL_SCALE][0]), int(found[WIDTH][0]), int(found[HEIGHT][0]), epsg)
    tags = ElementTree.fromstring(found[METADATA].rstrip(b"\0")) if METADATA in found else ()
    told = tuple((item.get("name"), item.text or "") for item in tags)
    return Raster(grid, int(found[TILE_WIDTH][0]), told), found[TILE_OFFSETS].astype(np.int64), found[TILE_SIZES].astype(np.int64)


def deflated(block: np.ndarray, tile: int) -> bytes | None:
    """A tile's bytes, filled up with missing pixels at the grid's edges; None if it has no data."""
    if np.isnan(block).all():
        return None
    whole = np.full((tile, tile), np.nan, "<f4")
    whole[: block.shape[0], : block.shape[1]] = block
    return zlib.compress(whole.tobytes(), 6)


def tiles(found: DataFrame, layout: chunks.Layout, tile: int, value: str) -> DataFrame:
    """(tile long, data binary): deflated tiles of the chunks of one layer. Blocks that are whole tiles are cut where they lie;
    of others the pieces of one tile meet."""
    across = -(-layout.width // tile)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [batch.column(c).to_pylist() for c in ("y0", "x0", "height", "width")]
            for i, (y0, x0, h, w) in enumerate(zip(*places, strict=True)):
                block, out = layout.array(batch.column(value)[i].as_py(), h, w), []
                for ty in range(y0 // tile, (y0 + h - 1) // tile + 1):
                    for tx in range(x0 // tile, (x0 + w - 1) // tile + 1):
                        top, left = max(y0, ty * tile), max(x0, tx * tile)
                        part = block[top - y0 : (ty + 1) * tile - y0, left - x0 : (tx + 1) * tile - x0]
                        if whole:
                            data = deflated(part, tile)
                        else:
                            data = None if np.isnan(part).all() else np.ascontiguousarray(part, "<f4").tobytes()
                        if data is not None:
                            out.append((ty * across + tx, top % tile, left % tile, *part.shape, data))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["tile", "y", "x", "h", "w", "data"])

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks.runs(batches, ["tile"]):
            block = np.full((tile, tile), np.nan, "<f4")
            for r in part.to_pylist():
                block[r["y"] : r["y"] + r["h"], r["x"] : r["x"] + r["w"]] = np.frombuffer(r["data"], "<f4").reshape(r["h"], r["w"])
            yield pa.RecordBatch.from_arrays([pa.array([part.column("tile")[0].as_py()], pa.int64()), pa.array([deflated(block, tile)], pa.binary())], names=["tile", "data"])

    whole, types = layout.block % tile == 0, [pa.int64(), *[pa.int32()] * 4, pa.binary()]
    cut = found.select("y0", "x0", "height", "width", value).mapInArrow(pieces, "tile long, y int, x int, h int, w int, data binary")
    if whole:
        return cut.select("tile", "data")
    return cut.repartition("tile").sortWithinPartitions("tile").mapInArrow(assembled, "tile long, data binary")


@dataclass
class Part(WriterCommitMessage):
    path: str | None
    tiles: list[int]
    sizes: list[int]


class TileWriter(DataSourceArrowWriter):
    """Rows (tile, data) of one raster, each tile once, in any order."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.raster = options["path"], overwrite, Raster.from_json(options["raster"])
        self.job = uuid.uuid4().hex

    @property
    def parts(self) -> str:
        return f"{self.path}.part-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, where = opened(self.parts)
        fs.create_dir(where)
        name, found, sizes, out = f"{where}/{uuid.uuid4().hex}", [], [], None  # another attempt writes another file
        for batch in iterator:
            for tile, data in zip(batch.column("tile").to_pylist(), batch.column("data"), strict=True):
                out = out or fs.open_output_stream(name)
                out.write(data.as_buffer())
                found.append(tile)
                sizes.append(len(data.as_buffer()))
        if out:
            out.close()
        return Part(name if out else None, found, sizes)

    def commit(self, messages: list[Part | None]) -> None:
        fs, where = opened(self.path)
        if not self.overwrite and fs.get_file_info(where).type != arrow_fs.FileType.NotFound:
            self.abort(messages)
            raise ValueError(f"there is a file at {self.path}")
        place, size, end = np.zeros(self.raster.tiles, np.int64), np.zeros(self.raster.tiles, np.int64), 0
        parts = [m for m in messages if m is not None and m.path]
        for part in parts:
            for tile, n in zip(part.tiles, part.sizes, strict=True):
                place[tile], size[tile], end = end, n, end + n
        _, held = opened(self.parts)
        fs.create_dir(held)
        with fs.open_output_stream(f"{held}/whole") as out:
            out.write(self.raster.head(place, size))
            for part in parts:
                with fs.open_input_stream(part.path) as source:
                    while piece := source.read(PIECE):
                        out.write(piece)
        fs.move(f"{held}/whole", where)  # the file appears whole
        fs.delete_dir(held)

    def abort(self, messages: list[Part | None]) -> None:
        fs, held = opened(self.parts)
        if fs.get_file_info(held).type != arrow_fs.FileType.NotFound:
            fs.delete_dir(held)


@dataclass
class Paths(InputPartition):
    paths: list[str]


HEADERS = "path string, plik string, res double, left double, bottom double, right double, top double, ncols int, nrows int, epsg int, tile int, tags map<string,string>"
PIXELS = "path string, row int, col int, z float"


class TiffReader(DataSourceReader):
    """One file a partition for pixels, up to 64 for headers."""

    def __init__(self, path: str, pixels: bool):
        self.path, self.pixels = path, pixels

    def partitions(self) -> list[Paths]:
        fs, where = opened(self.path)
        info = fs.get_file_info(where)
        found = [where] if info.type == arrow_fs.FileType.File else sorted(f.path for f in fs.get_file_info(arrow_fs.FileSelector(where, recursive=True, allow_not_found=True)) if f.extension == "tif")
        step = 1 if self.pixels else 64
        return [Paths(found[k : k + step]) for k in range(0, len(found), step)] or [Paths([])]

    def read(self, partition: Paths) -> Iterator[pa.RecordBatch] | Iterator[tuple]:
        fs, _ = opened(self.path)
        for path in partition.paths:
            with fs.open_input_file(path) as source:
                raster, place, size = read_head(source)
                if not self.pixels:
                    left, bottom, right, top = raster.grid.bounds
                    yield (path, path.rsplit("/", 1)[-1], raster.grid.cellsize, left, bottom, right, top, raster.grid.width, raster.grid.height, raster.grid.epsg, raster.tile, dict(raster.tags))
                    continue
                for k in np.flatnonzero(size).tolist():
                    source.seek(int(place[k]))
                    block = np.frombuffer(zlib.decompress(source.read(int(size[k]))), "<f4").reshape(raster.tile, raster.tile)
                    row, col = np.nonzero(~np.isnan(block))
                    z, row, col = block[row, col], row + k // raster.across * raster.tile, col + k % raster.across * raster.tile
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(path, pa.string()), len(z)), pa.array(row, pa.int32()), pa.array(col, pa.int32()), pa.array(z)], names=["path", "row", "col", "z"])


class GeoTiff(DataSource):
    """``format("geotiff")``. Reading: option ``content`` is ``headers`` (the default) or ``pixels``; writing: see ``write``."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    @property
    def _pixels(self) -> bool:
        content = self.options.get("content", "headers")
        if content not in ("headers", "pixels"):
            raise ValueError(f"content {content}: headers or pixels")
        return content == "pixels"

    def schema(self) -> str:
        return PIXELS if self._pixels else HEADERS

    def reader(self, schema) -> TiffReader:
        return TiffReader(self.options["path"], self._pixels)

    def writer(self, schema, overwrite: bool) -> TileWriter:
        return TileWriter(dict(self.options), overwrite)


def read(spark: SparkSession, path: str, content: str = "headers") -> DataFrame:
    """(path, plik, res, bounds, ncols, nrows, epsg, tile, tags) of each ``.tif`` below a folder, or of a file; ``pixels``:
    (path, row, col, z)."""
    spark.dataSource.register(GeoTiff)
    return spark.read.format("geotiff").option("content", content).load(path)


def write(found: DataFrame, layout: chunks.Layout, grid: Grid, path: str, value: str = "nmt", tags: dict[str, str] | None = None) -> None:
    """K3, K9: the chunks of one layer as one file, which replaces one that is there."""
    found.sparkSession.dataSource.register(GeoTiff)
    raster = Raster(grid, tile_side(grid.width, grid.height), tuple((tags or {}).items()))
    tiles(found, layout, raster.tile, value).write.format("geotiff").option("raster", raster.to_json()).mode("overwrite").save(path)


def write_sheets(meta: DataFrame, cells: DataFrame, folder: str, name: str = "member", value: str = "z") -> DataFrame:
    """K1, K2: one file a sheet below ``folder``, made in the task that has the sheet's pixels; (name, path, n) of each.

    ``meta``: name, res, left, top, ncols, nrows, and what else it has as tags; ``cells``: name, row, col, value. Nothing is
    written before the result is read.
    """
    told = [c for c in meta.columns if c not in (name, "res", "left", "bottom", "right", "top", "ncols", "nrows")]
    about = meta.select(name, "res", "left", "top", "ncols", "nrows", F.to_json(F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in told)) if told else F.struct()).alias("tags"))
    rows = about.join(cells.select(name, "row", "col", F.col(value).cast("float").alias("z")), name, "left").repartition(name).sortWithinPartitions(name)
    out = pa.schema([(name, pa.string()), ("path", pa.string()), ("n", pa.int64())])

    def sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = opened(folder)
        fs.create_dir(where)
        for part in chunks.runs(batches, [name]):
            first = part.slice(0, 1).to_pylist()[0]
            part = part.filter(part.column("row").is_valid())
            grid = Grid(first["left"], first["top"], first["res"], first["ncols"], first["nrows"])
            raster = Raster(grid, tile_side(grid.width, grid.height), tuple(json.loads(first["tags"]).items()))
            whole = np.full((grid.height, grid.width), np.nan, np.float32)
            whole[part.column("row").to_numpy(), part.column("col").to_numpy()] = part.column("z").to_numpy()
            _whole_file(fs, f"{where}/{first[name]}.tif", raster, lambda y, x, t=raster.tile, w=whole: deflated(w[y * t : (y + 1) * t, x * t : (x + 1) * t], t))
            yield pa.RecordBatch.from_arrays([pa.array([first[name]]), pa.array([f"{folder}/{first[name]}.tif"]), pa.array([int(np.count_nonzero(~np.isnan(whole)))])], schema=out)

    return rows.mapInArrow(sheets, f"`{name}` string, path string, n long")


def _whole_file(fs: arrow_fs.FileSystem, path: str, raster: Raster, tile_of: Callable[[int, int], bytes | None]) -> None:
    data = [tile_of(*divmod(k, raster.across)) for k in range(raster.tiles)]
    size = np.array([len(d or b"") for d in data], np.int64)
    part = f"{path}.part-{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(raster.head(np.cumsum(size) - size, size))
        for d in data:
            out.write(d or b"")
    fs.move(part, path)
