"""Year run (L11-L15, K14): from the sheet index over downloads and conversions to layers and single mosaics, year by year."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.functions import geometry
from strataspark.functions.grid import SIDES, Grid, level_factors
from strataspark.operators import catalog, chunks, levels, mosaic, plan
from strataspark.operators.convert import Conversions
from strataspark.sources import archive, geotiff, index
from strataspark.sources.files import Files
from strataspark.store import LayerStore


@dataclass(frozen=True)
class Settings:
    """Every decision comes from the configuration, nothing is asked."""

    resolution: float | None = None
    levels: list[float] = field(default_factory=list)
    resampling: str = "bilinear"
    block: int = 2048
    download: bool = True
    convert: bool = True
    store: bool = True
    mosaic: bool = False
    force: bool = False

    @classmethod
    def of(cls, section: dict) -> Settings:
        """P23, from the run's section of a configuration: names and levels are checked before anything runs."""
        part = index.checked_options(section)
        mosaic_only = bool(part.get("geotiff", False))
        own = cls(
            part.get("rozdzielczosc"), list(part.get("poziomy", [])), levels.method_name(part.get("resampling_poziomow", "bilinear")), part.get("blok_px", 2048),
            part.get("pobierz") is not False, part.get("konwersja", True), part.get("konwersja", True) and part.get("zarr") is not False and not mosaic_only, mosaic_only, part.get("wymus", False),
        )
        if own.resolution:
            level_factors(own.resolution, own.levels)
        return own


def run_years(spark: SparkSession, sheets: DataFrame, rings: geometry.Rings, settings: Settings, folder: str, fetch: archive.Fetch | None = None, county: str = "") -> dict[int, dict]:
    """What was done for each year. A year that fails is reported and does not stop the others.

    ``sheets``: rok, plik, url, epsg, akt_data, left, bottom, right, top; a column lp, if there is one, numbers the rows of
    the index, whose last row of a sheet holds. Folders: ``rok=<year>/archives`` holds the
    archives, ``rok=<year>/converted`` the conversions, ``store`` the layers, ``mosaics/<year>.tif`` single mosaics.
    """
    done: dict[int, dict] = {}
    for year in [r.rok for r in sheets.select("rok").distinct().orderBy("rok").collect()]:
        try:
            done[year] = run_year(spark, year, sheets.where(F.col("rok") == year), rings, settings, folder, fetch, county)
        except Exception as e:  # noqa: BLE001 - any failure belongs to its year
            done[year] = {"akcja": "blad", "powod": str(e).splitlines()[0]}
    return done


def run_year(spark: SparkSession, year: int, sheets: DataFrame, rings: geometry.Rings, settings: Settings, folder: str, fetch: archive.Fetch | None, county: str = "") -> dict:
    store = LayerStore(spark, f"{folder}/store", settings.block)
    own = f"{folder}/rok={year}"
    keys = sheets.select("plik", "akt_data", *SIDES, *(["lp"] if "lp" in sheets.columns else []))
    again = []
    if settings.store and store.exists():
        record = store.manifest.get(year)
        if record:
            todo = plan.action(plan.last_of_each(keys), store._sheet_frame(record["arkusze"]), record["status"], store._sheet_frame(record.get("nieobslugiwane", [])), settings.force)
            if todo["akcja"] == "aktualna":
                return todo
            again = todo["zmienione"]
    Files(spark).folder(f"{own}/archives")
    out: dict = {}
    if settings.download and fetch:
        reissued = spark.createDataFrame([(p,) for p in again], "plik string")  # L11: else the present archive would be kept
        loaded = archive.download_all(sheets.select("url"), f"{own}/archives", fetch, reissued=reissued).collect()  # one row per sheet of a year
        out["pobrane"] = {r.url.rsplit("/", 1)[-1]: r.result for r in loaded}
    if not settings.convert:
        return out | {"akcja": "surowe"}  # K14: the archives are all that was wanted
    found = archive.read_archives(spark, f"{own}/archives")
    meta, cells = Conversions(spark, f"{own}/converted").update(found, sheets)
    if settings.store:
        if not store.exists():
            finest = settings.resolution or catalog.finest(plan.used(meta, keys)[0]).head().finest
            if finest is None:
                return out | {"akcja": "blad", "powod": "no usable sheet"}
            factors = tuple(level_factors(finest, settings.levels))
            store.create(Grid.covering(geometry.bounds(rings), finest, factors), factors, county, settings.resampling)
        out["roznice"] = store.differences(settings.resolution, settings.levels)
        out |= store.update_year(year, keys, meta, cells, rings, settings.force, archive.without_ascii(found))
    if settings.mosaic:
        Files(spark).folder(f"{folder}/mosaics")
        try:  # L14: a mosaic that fails does not undo the rest
            out |= {"akcja": "mozaika", "komorka": single_mosaic(meta, cells, rings, f"{folder}/mosaics/{year}.tif", settings.resolution, settings.block)}
        except Exception as e:  # noqa: BLE001
            out |= {"mozaika": f"failed: {str(e).splitlines()[0]}"}
    return out


def single_mosaic(meta: DataFrame, cells: DataFrame, rings: geometry.Rings, where: str, cell: float | None = None, block: int = 2048) -> float:
    """K3: one mosaic of all sheets as a GeoTIFF file; its cell, the finest sheet's as it is by default.

    O2: newest first, sheets of one date in the order of their conversion, which is by name. Sheets are ranked once; a
    pixel's first value is a partial aggregate over ranks.
    """
    size = cell or catalog.finest(meta, rounded=False).head().finest
    grid = Grid.covering(geometry.bounds(rings), size)
    first = mosaic.base_layer(meta.withColumn("plik", F.col("member")), cells, grid, rings, path_descending=False)
    layout = chunks.Layout(grid.height, grid.width, block, ("z", "res_src"), keys=())
    geotiff.write(chunks.packed(first, layout), layout, grid, where, "z")
    return size
