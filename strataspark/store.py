"""Layer store: layers of dense chunks, a log of descriptions, incremental years.

A year is ``w_toku`` while it is written and ``kompletna`` afterwards; anything not complete is rebuilt. The grid and
the levels are frozen when the store is made. Files go through Spark, so a store may lie in any file system it knows.

Changes are committed, never made in place. A layer is a list of versions, each a folder of chunks of all blocks or of
the touched ones; a description names the versions that make its layers. The log holds descriptions by number, and the
next number is taken by whoever creates its file first. Readers see one description, before or after a change; a year
that is being rebuilt reads as before until its commit. ``clean`` removes what is no longer referred to.
"""

from __future__ import annotations

import datetime
import json
import uuid
import warnings
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.functions.grid import SIDES, Grid, Level
from strataspark.operators import catalog, chunks, levels, mosaic, plan, stats
from strataspark.sources.files import Files

FORMAT_VERSION = 2
#: Commits that are tried before giving up; versions of a layer before they are written together.
ATTEMPTS, MOST_VERSIONS = 20, 8
CHUNKS = f"{chunks.PLACE}, {chunks.Layout(0, 0, 1).about}, rok int, wersja string"
IN_PROGRESS, COMPLETE = "w_toku", "kompletna"
#: K15, fixed values: names, units and axes as the CF convention has them.
ATTRIBUTES = {
    "Conventions": "CF-1.8",
    "nmt": {"long_name": "numeryczny model terenu", "units": "m"},
    "rozdzielczosc_zrodla": {"long_name": "rozdzielczosc arkusza zrodlowego", "units": "m"},
    "x": {"axis": "X", "standard_name": "projection_x_coordinate", "long_name": "x coordinate of projection", "units": "m"},
    "y": {"axis": "Y", "standard_name": "projection_y_coordinate", "long_name": "y coordinate of projection", "units": "m"},
    "time": {"axis": "T", "standard_name": "time", "long_name": "time"},
}


class StoreError(RuntimeError):
    pass


def _now() -> str:
    return datetime.datetime.now(datetime.UTC).replace(microsecond=0).isoformat()


@dataclass
class LayerStore:
    """``block``: pixels a side of a base block, of stores that are made or migrated; afterwards the description's holds.
    ``at``: the entry of the log that is read, the latest one if None."""

    spark: SparkSession
    path: str
    block: int = 2048
    at: int | None = None

    @property
    def files(self) -> Files:
        return Files(self.spark)

    # The log: one numbered file per state of the whole description
    def _entry(self, number: int) -> str:
        return f"{self.path}/dziennik/{number:012d}.json"

    def _entries(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/dziennik") if n.endswith(".json"))

    def _read(self) -> tuple[int, dict]:
        found = self._entries()
        if not found or self.at is not None and self.at not in found:
            raise StoreError(f"no store at {self.path}" if not found else f"{self.path} has no entry {self.at} any more")
        number = found[-1] if self.at is None else self.at
        return number, json.loads(self.files.read(self._entry(number)))

    def _commit(self, change: Callable[[dict], None]) -> int:
        """Apply ``change`` to the latest state and write that as the next entry, which only one writer can create; whoever
        comes second applies its change to what the first one wrote. The new entry's number."""
        if self.at is not None:
            raise StoreError("a snapshot is read only")
        for _ in range(ATTEMPTS):
            number, data = self._read()
            change(data)
            if self.files.create(self._entry(number + 1), json.dumps(data, ensure_ascii=False).encode()):
                return number + 1
        raise StoreError(f"{self.path}: {ATTEMPTS} other writers were faster")

    def _load(self) -> dict:
        return self._read()[1]

    def snapshot(self) -> LayerStore:
        """The store as it is now, for reading; later changes do not touch what it reads until ``clean``."""
        return replace(self, at=self._read()[0])

    def exists(self) -> bool:
        """A description whose layers' folder is gone describes nothing. Nothing is removed here, as a mount or a listing
        may be late; ``create`` removes it."""
        return bool(self._entries()) and self.files.exists(f"{self.path}/warstwy")

    def create(self, grid: Grid, factors: tuple[int, ...] = (), county: str = "", method: str = "bilinear") -> LayerStore:
        """Refuses if there is one already, or layers without a description (L6). U6: an orphaned description goes, so
        that its years are built anew."""
        if self.exists():
            raise StoreError(f"there is a store at {self.path}")
        if self.files.names(f"{self.path}/warstwy"):
            raise StoreError(f"{self.path} holds layers of an unknown format; remove them and build anew")
        for f in factors:
            _ = Level(grid, f, self.block).grid
        for orphan in ("dziennik", "czas"):
            if self.files.remove(f"{self.path}/{orphan}"):
                warnings.warn(f"{self.path}/{orphan} described layers that are not there; it was removed", stacklevel=2)
        about = {"wersja_formatu": FORMAT_VERSION, "rola": "baza", "siatka": json.loads(grid.to_json()), "faktory_poziomow": list(factors), "blok_px": self.block, "utworzono": _now(), "powiat": county, "resampling_poziomow": levels.method_name(method), "atrybuty": ATTRIBUTES | {"title": f"NMT {county}".strip()}}
        self.files.folder(f"{self.path}/warstwy")
        if not self.files.create(self._entry(1), json.dumps({"opis": about, "warstwy": {}}, ensure_ascii=False).encode()):
            raise StoreError(f"there is a store at {self.path}")
        return self

    @property
    def about(self) -> dict:
        found = self._load()["opis"]
        if found.get("wersja_formatu") != FORMAT_VERSION:
            raise StoreError(f"{self.path} has another format; rebuild it")
        return found

    @property
    def manifest(self) -> dict[int, dict]:
        return {int(k): v for k, v in sorted(self._load()["warstwy"].items())}

    @property
    def grid(self) -> Grid:
        return Grid(**self.about["siatka"])

    @property
    def factors(self) -> list[int]:
        return self.about["faktory_poziomow"]

    def save_record(self, year: int, record: dict) -> None:
        """K8."""
        self._commit(lambda data: data["warstwy"].update({str(year): record | {"zmieniono": _now()}}))

    def years(self) -> list[int]:
        """In storage order."""
        found = self.manifest
        return sorted(found, key=lambda y: found[y]["indeks"])

    def levels(self) -> list[Level]:
        """The base first."""
        about = self.about
        base = Grid(**about["siatka"])
        return [Level(base, f, about["blok_px"]) for f in (1, *about["faktory_poziomow"])]

    def differences(self, resolution: float | None = None, wanted: list[float] | None = None) -> list[str]:
        """How a configuration differs from what the store has frozen; the store's values hold."""
        base, stored = self.grid.cellsize, [x.grid.cellsize for x in self.levels()[1:]]
        found = []
        if wanted is not None and sorted(map(float, wanted)) != sorted(stored):
            found.append(f"levels {wanted} differ from the store's {stored}")
        if resolution and abs(float(resolution) - base) > 1e-9:
            found.append(f"resolution {resolution:g} differs from the store's {base:g}")
        return found

    def reserve(self, year: int, known: dict[int, dict] | None = None) -> tuple[int, str | None]:
        """(storage index, warning). A known year keeps its index; an older year is appended at the end."""
        found = self.manifest if known is None else known
        if len({r["indeks"] for r in found.values()}) < len(found):
            raise StoreError(f"{self.path}: two years share one place on the time axis")
        if year in found:
            return found[year]["indeks"], None
        late = f"{year} is older than {max(found)} and stored after it" if found and year < max(found) else None
        return max((r["indeks"] for r in found.values()), default=-1) + 1, late

    # Time axis
    def rewrite_time(self, position: str = "middle", bounds: bool = True, unit: str = "seconds", fragments: str = "each") -> DataFrame:
        """Write the axis of every level anew: middle or start of the year, with or without bounds, in seconds or days,
        one file per year (``each``) or one for all (``one``). Layers are not touched. (level, indeks, rok, time[, start, end])."""
        order = self.spark.createDataFrame([(y, r["indeks"]) for y, r in self.manifest.items()], "rok int, indeks int")
        at, start, end = stats.time_axis(F.col("rok"), position, unit)
        ends = [start.alias("start"), end.alias("end")] if bounds else []
        axis = order.select("indeks", "rok", at.alias("time"), *ends).crossJoin(F.broadcast(self.spark.createDataFrame([(x.factor,) for x in self.levels()], "level int")))
        dealt = axis.repartition("level") if fragments == "one" else axis.repartition("level", "indeks")
        name = uuid.uuid4().hex
        writer = dealt.write.mode("overwrite").partitionBy("level", *(["indeks"] if fragments == "each" else []))
        writer.parquet(f"{self.path}/czas/zapis={name}")
        told = {"zapis": name, "units": f"{unit} since 1970-01-01", "calendar": "standard", "pozycja": position, "fragmenty": fragments} | ({"bounds": "time_bnds"} if bounds else {})
        self._commit(lambda data: data["opis"].update(czas=told))
        return self.time_axis()

    def time_axis(self, factor: int | None = None) -> DataFrame:
        """The axis as it was written last."""
        written = self.about.get("czas")
        if not written:
            raise StoreError("no time axis was written")
        axis = self.spark.read.parquet(f"{self.path}/czas/zapis={written['zapis']}")
        return axis if factor is None else axis.where(F.col("level") == factor)

    def coordinates(self, factor: int = 1) -> DataFrame:
        """K5: (axis, n, at) of a level: centres of its columns (x) and, from the north, of its rows (y)."""
        g = self._level(factor).grid
        n = F.col("n").cast("int").alias("n")
        x = self.spark.range(g.width).select(F.lit("x").alias("axis"), F.col("id").alias("n")).select("axis", n, g.x_of(F.col("n")).alias("at"))
        y = self.spark.range(g.height).select(F.lit("y").alias("axis"), F.col("id").alias("n")).select("axis", n, g.y_of(F.col("n")).alias("at"))
        return x.union(y)

    def migrate(self) -> LayerStore:
        """A store of format 1 (``opis.json``, and one folder of pixels per block) to this format. Old pixels are packed into
        chunks and committed; only then the old description and folders go, so a migration that was cut off is done again."""
        old = f"{self.path}/opis.json"
        if not self.files.exists(old):
            raise StoreError(f"{self.path} has no description of format 1")
        data = json.loads(self.files.read(old))
        if data["opis"].get("wersja_formatu") != 1:
            raise StoreError(f"{self.path} has another format; rebuild it")
        base, done = Grid(**data["opis"]["siatka"]), []
        for year, record in data["warstwy"].items():
            record["wersje"] = {}
            for factor in (1, *data["opis"]["faktory_poziomow"]):
                where = self._folder(factor, int(year))
                blocks = [n for n in self.files.names(where) if n.startswith("by=")]
                if blocks:
                    level = Level(base, factor, self.block)
                    cells = self.spark.read.option("basePath", where).parquet(*(f"{where}/{n}" for n in blocks)).select(F.lit(int(year)).alias("rok"), "row", "col", "nmt", "res_src")
                    self._write(chunks.packed(cells, self.layout(level)), factor, int(year), "format-1")
                    record["wersje"][str(factor)] = [["format-1", None]]
                    done += [f"{where}/{n}" for n in blocks]
        data["opis"] |= {"wersja_formatu": FORMAT_VERSION, "blok_px": self.block}
        data["opis"].pop("czas", None)  # the axis is written anew on demand
        if not self.files.create(self._entry(1), json.dumps(data, ensure_ascii=False).encode()):
            raise StoreError(f"there is a store at {self.path}")
        for path in (old, f"{self.path}/czas", *done):
            self.files.remove(path)
        return self

    # Layers
    def _folder(self, factor: int, year: int) -> str:
        return f"{self.path}/warstwy/level={factor}/rok={year}"

    def layout(self, level: Level) -> chunks.Layout:
        return chunks.Layout(level.grid.height, level.grid.width, level.block)

    def _live(self, factor: int, versions: dict[int, list]) -> DataFrame:
        """Chunks of the years' versions, [name, blocks or None for all] each, oldest first: a block's last version holds."""
        paths, gone = [], []
        for year, found in versions.items():
            for k, (name, _) in enumerate(found):
                paths.append(f"{self._folder(factor, year)}/wersja={name}")
                gone += [(year, name, by, bx) for _, blocks in found[k + 1 :] for by, bx in blocks]
        if not paths:
            return self.spark.createDataFrame([], CHUNKS)
        read = self.spark.read.schema(CHUNKS).option("basePath", f"{self.path}/warstwy/level={factor}").parquet(*paths)
        if gone:  # at most every block once per version, and versions are few
            read = read.join(F.broadcast(self.spark.createDataFrame(gone, "rok int, wersja string, by int, bx int").distinct()), ["rok", "wersja", "by", "bx"], "left_anti").select(*read.columns)
        return read

    def chunks(self, year: int | None = None, factor: int = 1) -> DataFrame:
        """Dense chunks of a level, of one year if given: columns of ``chunks.Layout``; masks, ranges and values are pruned."""
        found = self.manifest
        if year is not None and year not in found:
            raise KeyError(year)
        versions = {y: r.get("wersje", {}).get(str(factor), []) for y, r in found.items() if year in (None, y)}
        return self._live(factor, versions).drop("wersja")

    def _level(self, factor: int) -> Level:
        return next(x for x in self.levels() if x.factor == factor)

    def read(self, year: int | None = None, factor: int = 1, value: str | None = None) -> DataFrame:
        """Cells of a level, of one year if given; only chunks of the years and values asked for are read."""
        cells = chunks.cells(self.chunks(year, factor), self.layout(self._level(factor)), None if value is None else tuple(dict.fromkeys(("nmt", value))))
        return cells.withColumn("level", F.lit(factor)) if value is None else cells.select("rok", "row", "col", value)

    def _write(self, made: DataFrame, factor: int, year: int, name: str) -> None:
        """K6: chunks of a layer, or of some blocks of it, beside what is there; nothing reads them before they are committed."""
        made.drop("rok").write.mode("overwrite").option("compression", "zstd").parquet(f"{self._folder(factor, year)}/wersja={name}")

    def _versions(self, factor: int, year: int, before: list, name: str, blocks: list[tuple[int, int]] | None) -> list:
        """The versions of a layer with a new one; many are written together as one."""
        if blocks is None:
            return [[name, None]]
        after = [*before, [name, [list(b) for b in blocks]]] if blocks else before
        if len(after) <= MOST_VERSIONS:
            return after
        self._write(self._live(factor, {year: after}).drop("wersja"), factor, year, f"{name}-razem")
        return [[f"{name}-razem", None]]

    def clean(self) -> list[str]:
        """Remove entries of the log but the latest, and what no layer of that refers to. Snapshots and writers that are at
        work then fail, so there should be none. What was removed."""
        number, data = self._read()
        kept = {(int(y), int(f), n) for y, r in data["warstwy"].items() for f, vs in r.get("wersje", {}).items() for n, _ in vs}
        gone = [self._entry(n) for n in self._entries() if n < number]
        gone += [f"{self.path}/czas/{n}" for n in self.files.names(f"{self.path}/czas") if n != f"zapis={data['opis'].get('czas', {}).get('zapis')}"]
        for level in self.files.names(f"{self.path}/warstwy"):
            for year in self.files.names(f"{self.path}/warstwy/{level}"):
                for name in self.files.names(f"{self.path}/warstwy/{level}/{year}"):
                    if name.startswith("wersja=") and (int(year[4:]), int(level[6:]), name[7:]) not in kept:
                        gone.append(f"{self.path}/warstwy/{level}/{year}/{name}")
        for path in gone:
            self.files.remove(path)
        return gone

    def _hit(self, level: Level, dirty: DataFrame | None) -> list[tuple[int, int]] | None:
        """The level's blocks whose cells weigh a pixel of a dirty rectangle, all of them without rectangles (None)."""
        if dirty is None:
            return None
        far = levels.reach(self.about["resampling_poziomow"], level.factor) * level.base.cellsize
        wide = dirty.select(*((F.col(c) + far * sign).alias(c) for c, sign in zip(SIDES, (-1, -1, 1, 1), strict=True)))
        hit = plan.touched_blocks(level.grid.blocks(self.spark, level.block), wide)
        return sorted((r.by, r.bx) for r in hit.select("by", "bx").collect())  # bounded by the grid's block count

    def _only(self, cells: DataFrame, level: Level, blocks: list[tuple[int, int]] | None) -> DataFrame:
        if blocks is None:
            return cells
        chosen = self.spark.createDataFrame(blocks or [(-1, -1)], "by int, bx int")
        return cells.withColumns(level.block_columns()).join(F.broadcast(chosen), ["by", "bx"], "left_semi").drop("by", "bx")

    def _around(self, base: DataFrame, level: Level, blocks: list[tuple[int, int]]) -> DataFrame:
        """Base chunks of the blocks that the level's blocks need, with the margin that the widest kernel reaches."""
        finest, reach = self.levels()[0], 2 * level.factor + 2
        need = set()
        for by, bx in blocks:
            sides = []
            for k in (by, bx):
                first, last = k * level.block * level.factor - reach, (k + 1) * level.block * level.factor + reach - 1
                sides.append(range(max(0, first) // finest.block, last // finest.block + 1))
            need |= {(y, x) for y in sides[0] for x in sides[1]}
        near = base.where(F.col("by").between(min(y for y, _ in need), max(y for y, _ in need)) & F.col("bx").between(min(x for _, x in need), max(x for _, x in need)))  # skips row groups
        return near.join(F.broadcast(self.spark.createDataFrame(sorted(need), "by int, bx int")), ["by", "bx"], "left_semi").select(*base.columns)

    def update_year(self, year: int, sheets: DataFrame, meta: DataFrame, cells: DataFrame, rings=None, force: bool = False, archives_without_ascii: DataFrame | None = None) -> dict:
        """L2, L3: bring one year up to date from its sheet list and the converted sheets; what was done.

        ``sheets``: plik, akt_data, left, bottom, right, top. ``meta`` and ``cells`` as the readers give them; where one
        archive holds several sheets both have a column ``member``. A change reads only the sheets that meet a touched
        block, and writes only touched blocks, on every level.
        """
        record = self.manifest.get(year)
        old = self._sheet_frame(record["arkusze"]) if record else None
        skip = self._sheet_frame(record.get("nieobslugiwane", [])) if record else None
        sheets = plan.last_of_each(sheets)
        todo = plan.action(sheets, old, record and record["status"], skip, force)
        if todo["akcja"] == "aktualna":
            return todo
        tiles, foreign = plan.used(meta, sheets)
        if tiles.isEmpty():
            return todo | {"akcja": "blad", "powod": "no usable sheet"}
        dated = tiles.drop("akt_data").join(sheets.select("plik", "akt_data"), "plik")
        histogram = {f"{r.res:g}": r.n for r in catalog.resolution_histogram(tiles.select(catalog.stored_resolution(F.col("res")).alias("res"))).orderBy("res").collect()}
        task, placed = uuid.uuid4().hex, {}
        started = {"status": IN_PROGRESS, "arkusze": self._rows(sheets.join(tiles.select("plik").distinct(), "plik", "left_semi")), "rozdzielczosci_zrodlowe": histogram, "zadanie": task}

        def start(data: dict) -> None:
            known = {int(k): v for k, v in data["warstwy"].items()}
            placed["indeks"], placed["ostrzezenie"] = self.reserve(year, known)
            data["warstwy"][str(year)] = started | {"indeks": placed["indeks"], "wersje": known.get(year, {}).get("wersje", {}), "zmieniono": _now()}

        name = str(self._commit(start))
        before = self.manifest[year]["wersje"]
        base, *coarser = self.levels()
        blocks = self._hit(base, todo["brudne"])
        if rings is not None:  # J11: blocks outside the polygon are never built
            dated = plan.touched_blocks(dated, catalog.touching(base.grid.blocks(self.spark, base.block), rings))
        if blocks is not None:
            edge = base.grid.blocks(self.spark, base.block).join(F.broadcast(self.spark.createDataFrame(blocks or [(-1, -1)], "by int, bx int")), ["by", "bx"], "left_semi")
            dated = plan.touched_blocks(dated, edge)  # L3: sheets that meet none of the blocks are not read
        layer = mosaic.base_layer(dated, cells, base.grid, rings).select(F.lit(year).alias("rok"), "row", "col", F.col("z").alias("nmt"), "res_src")
        if blocks is None or blocks:
            self._write(chunks.packed(self._only(layer, base, blocks), self.layout(base)), 1, year, name)
        versions = {"1": self._versions(1, year, before.get("1", []), name, blocks)}
        method, touched = self.about["resampling_poziomow"], {base.factor: blocks}
        fresh = self._live(1, {year: versions["1"]}).drop("wersja")
        for level in coarser:
            key = str(level.factor)
            hit = touched[level.factor] = self._hit(level, todo["brudne"])
            if hit is None or hit:
                source = fresh if hit is None else self._around(fresh, level, hit)
                made = chunks.level(source, self.layout(base), level.factor, method, self.layout(level))
                if hit is not None:
                    made = made.join(F.broadcast(self.spark.createDataFrame(hit, "by int, bx int")), ["by", "bx"], "left_semi").select(*made.columns)
                self._write(made, level.factor, year, name)
            versions[key] = self._versions(level.factor, year, before.get(key, []), name, hit)
        shares = {f"{r.res:g}": r.share for r in stats.resolution_shares(chunks.cells(fresh, self.layout(base))).orderBy("res").collect()}
        none = archives_without_ascii if archives_without_ascii is not None else self.spark.createDataFrame([], "archive string")
        rest = plan.unused(sheets, tiles, none).select("plik", "akt_data", "powod").collect()
        done = started | {
            "status": COMPLETE, "wersje": versions, "udzial_rozdzielczosci": shares, "pominiete": sorted(r.plik for r in rest if r.powod == "pominiete"),
            "nieobslugiwane": [{"plik": r.plik, "akt_data": str(r.akt_data or "")} for r in rest if r.powod != "pominiete"],
        }

        def finish(data: dict) -> None:
            own = data["warstwy"].get(str(year), {})
            if own.get("zadanie") != task:
                raise StoreError(f"{self.path}: another writer took over {year}")
            data["warstwy"][str(year)] = done | {"indeks": own["indeks"], "zmieniono": _now()}

        self._commit(finish)
        counts = catalog.resolution_counters(tiles, base.grid.cellsize).head().asDict()
        return todo | placed | {"bloki": blocks, "poziomy": touched, "obce": foreign.count()} | counts

    @staticmethod
    def _rows(sheets: DataFrame) -> list[dict]:
        """One record per sheet of a year: the manifest holds them all."""
        return [r.asDict() | {"akt_data": str(r.akt_data or "")} for r in sheets.select("plik", "akt_data", *SIDES).orderBy("plik").collect()]

    def _sheet_frame(self, records: list[dict]) -> DataFrame:
        rows = [tuple(r.get(k) for k in ("plik", "akt_data", *SIDES)) for r in records]
        return self.spark.createDataFrame(rows, "plik string, akt_data string, left double, bottom double, right double, top double")

    def export(self, folder: str, factor: int = 1, year: int | None = None, value: str = "nmt") -> None:
        """K9: one folder per year; an error if there is none."""
        cells = self.read(year, factor, value)
        if cells.isEmpty():
            raise StoreError("nothing to export")
        cells.write.mode("overwrite").partitionBy("rok").parquet(folder)

    def export_geotiff(self, folder: str, factor: int = 1, year: int | None = None, value: str = "nmt") -> list[str]:
        """K9: one raster file per year, named by store, level, value and year; an error if there is none. Their paths."""
        from strataspark.sources import geotiff

        level, found = self._level(factor), self.manifest
        if year is not None and year not in found:
            raise KeyError(year)
        parts = [self.path.rstrip("/").rsplit("/", 1)[-1], *([level.name] if factor > 1 else []), *(["rozdzielczosc_zrodla"] if value == "res_src" else [])]
        made = []
        for y in [y for y, r in found.items() if year in (None, y) and r.get("wersje")]:
            made.append(f"{folder}/{'_'.join(parts)}_{y}.tif")
            self.files.folder(folder)
            geotiff.write(self.chunks(y, factor), self.layout(level), level.grid, made[-1], value, {"rok": str(y), "zmienna": value})
        if not made:
            raise StoreError("nothing to export")
        return made

    def report(self, factor: int | None = None) -> DataFrame:
        """Per layer in storage order its statistics and the change against the layer before, from chunks: nothing is
        shuffled by pixel."""
        level = self._level(factor or (self.factors or [1])[0])
        order = self.spark.createDataFrame([(y, r["indeks"]) for y, r in self.manifest.items()], "rok int, indeks int")
        found = self.chunks(factor=level.factor).join(F.broadcast(order), "rok")
        changes = chunks.change_shares(found, self.layout(level))
        return chunks.layer_stats(found, self.layout(level), "indeks").join(changes, "indeks", "left").join(order, "indeks").orderBy("indeks")

    def coverage(self, factor: int | None = None) -> DataFrame:
        """(rok, coverage) of a level, from masks alone."""
        return chunks.coverage(self.chunks(factor=factor or (self.factors or [1])[-1]))


def find_stores(spark: SparkSession, folder: str) -> list[str]:
    """Folders below ``folder`` whose description says that they are a base store."""
    found = []
    for name in Files(spark).names(folder):
        store = LayerStore(spark, f"{folder}/{name}")
        if store._entries() and store._load()["opis"].get("rola") == "baza":
            found.append(store.path)
    return found


def ascii_grid_rows(cells: DataFrame, grid: Grid, value: str = "z", no_data: float = -9999) -> DataFrame:
    """K3: (row, line) body lines of an ASCII grid; a row's cells are gathered, never a whole layer."""
    filled = cells.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("col", F.col(value).cast("string")))).alias("m"))
    every = cells.sparkSession.range(grid.height).select(F.col("id").cast("int").alias("row"))
    line = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(grid.width - 1)), lambda c: F.coalesce(F.try_element_at("m", c.cast("int")), F.lit(f"{no_data:g}"))), " ")
    return every.join(filled, "row", "left").select("row", line.alias("line"))


def sheets_geojson(sheets: DataFrame, epsg: int = 2180) -> DataFrame:
    """One GeoJSON feature per sheet with its corners in degrees; null properties become ''."""
    from strataspark.functions import crs
    
    corners = [("left", "bottom"), ("right", "bottom"), ("right", "top"), ("left", "top"), ("left", "bottom")]
    ring = F.array(*(F.array(*crs.to_degrees(F.col(x), F.col(y), epsg, crs.COLUMNS)) for x, y in corners))
    properties = F.struct(*(catalog.shown(F.col(c)).alias(c) for c in sheets.columns if c not in ("left", "bottom", "right", "top")))
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    return sheets.select(F.to_json(feature).alias("feature"))
