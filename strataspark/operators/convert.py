"""Sheets from archive members (L4): lookups of CRS and date, readers by format, reprojection, and kept conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.functions import crs
from strataspark.operators import catalog, mosaic, plan
from strataspark.sources import ascii as texts
from strataspark.sources.files import Files

TARGET = 2180


def sheet_texts(found: DataFrame) -> DataFrame:
    """(member, archive, text) of ``archive.members``: sheet texts only, one per lower-cased name; of several archives
    with that name the last one in scan order has it (J2, S8)."""
    usable = found.where("error is null and member is not null").where(texts.is_ascii_name(F.col("member")))
    best = F.max_by(F.struct("member", "archive", "text"), F.struct("archive", "member")).alias("best")
    return usable.groupBy(F.lower("member").alias("name")).agg(best).select("best.*")


def described(members: DataFrame, sheets: DataFrame) -> DataFrame:
    """Members with ``epsg`` and ``akt_data``, by their own name in the sheet list, else by their archive's;
    2180 and no date where neither is listed. ``plik`` is the archive."""
    known = plan.last_of_each(sheets.select("plik", "epsg", "akt_data", *(["lp"] if "lp" in sheets.columns else [])), ("plik",))
    info = known.select("plik", F.struct("epsg", "akt_data").alias("info"))
    own, archive = (info.withColumnRenamed("plik", k) for k in ("member", "archive"))
    unknown = F.struct(F.lit(TARGET).alias("epsg"), F.lit(None).cast("string").alias("akt_data"))
    told = members.join(own.withColumnRenamed("info", "own_"), "member", "left").join(archive.withColumnRenamed("info", "archive_"), "archive", "left")
    epsg = F.coalesce("own_.epsg", "archive_.epsg", unknown.epsg)
    date = F.coalesce("own_.akt_data", "archive_.akt_data").cast("string")
    return told.withColumns({"plik": F.col("archive"), "epsg": epsg.cast("int"), "akt_data": date}).drop("own_", "archive_", "archive")


def converted(every: DataFrame, systems: list[int]) -> tuple[DataFrame, DataFrame]:
    """L4: (meta, cells) of the texts of ``described`` on grids of EPSG 2180, whose sources are in one of ``systems``.

    meta: member, plik, epsg (of the source), akt_data, res, left, bottom, right, top, ncols, nrows; cells: member, row,
    col, z. A text that cannot be read has no meta row.
    """
    files = every.select(F.col("member").alias("plik"), "text").withColumn("format", texts.format_of(F.col("text")))
    grids, points = files.where("format = 'grid'").drop("format"), files.where("format = 'xyz'").drop("format")
    parts = [texts.read_grid(grids), texts.read_xyz(texts.lines_of(points))]
    shape = ["plik", "res", "left", "bottom", "right", "top", "ncols", "nrows"]
    meta = parts[0][0].select(*shape).union(parts[1][0].select(*shape)).where("res > 0 and left is not null and bottom is not null and ncols > 0 and nrows > 0")
    cells = parts[0][1].union(parts[1][1].select(*parts[0][1].columns))
    system = every.select(F.col("member").alias("plik"), "epsg")
    placed, own = meta.join(system, "plik"), []
    for code in [c for c in crs.PROJECTIONS if c in {TARGET, *systems}]:  # a fixed handful
        some = placed.where(F.col("epsg") == code).drop("epsg")
        moved = (some, cells.join(some.select("plik"), "plik", "left_semi")) if code == TARGET else mosaic.reprojected(some, cells, code, TARGET)
        own.append((moved[0].select(*shape), moved[1].select("plik", "row", "col", "z")))
    metas, values = own[0]
    for m, c in own[1:]:
        metas, values = metas.union(m), values.union(c)
    named = metas.withColumnRenamed("plik", "member").join(every.select("member", "plik", "epsg", "akt_data"), "member")
    return named, values.withColumnRenamed("plik", "member")


class Conversions:
    """Converted sheets as Parquet below a folder, one sub-folder for each run.

    A run writes its cells first and its sheets' metadata (with source file and date) last, so a run that was cut off
    has no metadata and counts as not done. Of several conversions of a sheet the latest run's holds.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder, Files(spark)

    def runs(self) -> list[int]:
        have = (self.files.exists(f"{self.folder}/{name}/meta/_SUCCESS") and int(name[4:]) for name in self.files.names(self.folder) if name.startswith("run="))
        return sorted(run for run in have if run)

    def read(self) -> tuple[DataFrame, DataFrame] | None:
        """(meta, cells) of the latest conversion of each sheet; None before the first run."""
        runs = self.runs()
        if not runs:
            return None
        load = lambda what: self.spark.read.option("basePath", self.folder).parquet(*(f"{self.folder}/run={r}/{what}" for r in runs))
        latest = catalog.first_of(load("meta"), ["member"], [F.col("run").desc()])
        cells = load("cells").join(latest.select("member", "run"), ["member", "run"], "left_semi")
        return latest.drop("run"), cells.drop("run")

    def update(self, found: DataFrame, sheets: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Convert what is new, or was issued again with another date; the state afterwards."""
        have = self.read()
        if have is not None:
            dates = described(have[0].select("member", F.col("plik").alias("archive")), sheets).select(F.col("member").alias("plik"), "akt_data")
            old = plan.stale(have[0].select(F.col("member").alias("plik"), "akt_data"), dates)
            done = have[0].select("member").join(old.select(F.col("plik").alias("member")), "member", "left_anti")
            found = found.join(done, "member", "left_anti")
            if sheet_texts(found).isEmpty():  # a run without sheets would be one more folder to read
                return self.read()
        where = f"{self.folder}/run={max(self.runs(), default=0) + 1}"
        self.files.remove(where)
        described(sheet_texts(found), sheets).write.parquet(f"{where}/texts")  # archives are unpacked once
        every = self.spark.read.parquet(f"{where}/texts")
        meta, cells = converted(every, [r.epsg for r in every.select("epsg").distinct().collect()])
        cells.repartition("member").sortWithinPartitions("member", "row", "col").write.parquet(f"{where}/cells")
        meta.write.parquet(f"{where}/meta")
        self.files.remove(f"{where}/texts")
        return self.read()
