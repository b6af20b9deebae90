"""Readers of sheet texts: ASCII grids (S9, G11, P13), XYZ point grids (S10, P11, P12, W3, A12, A13, A18), dispatch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataspark.functions.numeric import no_data_to_null, round_float, round_half_even

EXTENSIONS = ("asc", "xyz", "txt")


def kept_variant(name: Column) -> Column:
    """A stem that ends in ``_<letter>`` counts only as ``_p``."""
    stem = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.[^.]*$", "")
    return F.lower(F.regexp_extract(stem, "_([A-Za-z])$", 1)).isin("", "p")


def is_ascii_name(name: Column) -> Column:
    return F.lower(name).rlike(r"\.(" + "|".join(EXTENSIONS) + ")$")


def format_of(text: Column) -> Column:
    """``grid`` if the first line has ``ncols``."""
    return F.when(F.lower(F.substring_index(text, "\n", 1)).contains("ncols"), F.lit("grid")).otherwise(F.lit("xyz"))


def read_grid(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(meta, cells) of ``files``(plik, text) in the ARC/INFO form: six header lines, then rows from the north.

    meta: plik, res, left, bottom, right, top, ncols, nrows. cells: plik, row, col, z; no-data cells are absent.
    """
    lines = F.split(F.regexp_replace("text", "\r", ""), "\n")
    words = lambda x: F.split(F.trim(x), r"\s+")
    entries = F.transform(F.slice("lines", 1, 6), lambda x: F.struct(F.lower(F.try_element_at(words(x), F.lit(1))).alias("key"), F.try_element_at(words(x), F.lit(2)).try_cast("double").alias("value")))
    head = files.select("plik", lines.alias("lines")).withColumn("head", entries)
    get = lambda key: F.try_element_at(F.filter("head", lambda e: e.key == key), F.lit(1)).value
    cell, half = get("cellsize"), get("cellsize") / 2
    meta = head.select(
        "plik", cell.alias("res"), get("ncols").cast("int").alias("ncols"), get("nrows").cast("int").alias("nrows"), get("nodata_value").alias("no_data"), "lines",
        F.coalesce(get("xllcorner"), get("xllcenter") - half).alias("left"), F.coalesce(get("yllcorner"), get("yllcenter") - half).alias("bottom"),
    )
    values = F.filter(F.split(F.array_join(F.slice("lines", F.lit(7), F.size("lines")), " "), r"\s+"), lambda v: v != "")
    body = meta.select("plik", "ncols", "no_data", F.posexplode(values).alias("pos", "value"))
    z = no_data_to_null(F.col("value").cast("float"), F.coalesce(F.col("no_data"), F.lit(float("nan"))))
    cells = body.select("plik", (F.floor(F.col("pos") / F.col("ncols"))).cast("int").alias("row"), (F.col("pos") % F.col("ncols")).cast("int").alias("col"), round_float(z).alias("z")).where("z is not null")
    out = meta.select("plik", "res", "left", "bottom", (F.col("left") + F.col("ncols") * F.col("res")).alias("right"), (F.col("bottom") + F.col("nrows") * F.col("res")).alias("top"), "ncols", "nrows")
    return out, cells


def xyz_points(lines: DataFrame) -> DataFrame:
    """(plik, line_no, x, y, z) of the lines of exactly three numbers."""
    part = F.split(F.btrim("text", F.lit(" \t\n\x0b\f\r")), r"\s+")
    number = lambda k: F.try_element_at("part_", F.lit(k + 1)).try_cast("double")
    # Through a generator, so that the filters on the values do not split the text again.
    rows = lines.select("plik", "line_no", F.explode(F.array(part)).alias("part_")).where(F.size("part_") == 3)
    return rows.select("plik", "line_no", *(number(k).alias(n) for k, n in enumerate("xyz"))).where("x is not null and y is not null and z is not null")


def extent_and_step(points: DataFrame) -> DataFrame:
    """(plik, x0, x1, y0, y1, step) in one pass over the points: A12's box, and W3's step (null where there is none).

    A task keeps the distinct coordinates of a sheet on either axis, with the least and the greatest value of each.
    """
    sides = F.array(*(F.struct(F.lit(n).alias("axis"), F.col(n).cast("double").alias("at")) for n in "xy"))
    values = points.select("plik", F.inline(sides)).groupBy("plik", "axis", round_half_even(F.col("at"), 3).alias("v")).agg(F.min("at").alias("low"), F.max("at").alias("high"))
    gap = F.col("v") - F.lag("v").over(Window.partitionBy("plik", "axis").orderBy("v"))
    of = lambda axis, value: F.when(F.col("axis") == axis, value)
    ends = [f(of(n, F.col(side))).alias(f"{n}{k}") for n in "xy" for k, (f, side) in enumerate(((F.min, "low"), (F.max, "high")))]
    steps = [F.min(of(n, F.when(F.col("gap") > 0.05, F.col("gap")))).alias(f"step_{n}") for n in "xy"]
    return values.withColumn("gap", gap).groupBy("plik").agg(*ends, *steps).withColumn("step", round_half_even(F.coalesce("step_x", "step_y"))).drop("step_x", "step_y")


def infer_step(points: DataFrame) -> DataFrame:
    """(plik, step): least difference above 0.05 of distinct x (3 places), else of y; rounded to 2 places."""
    return extent_and_step(points).select("plik", "step").where("step > 0")


def read_xyz(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(meta, cells) of ``lines``(plik, line_no, text): cell centres as ``x y z``; the last line of a cell wins.

    Files of another variant or without a step are absent, as the sheet is then skipped.
    """
    points = xyz_points(lines.where(kept_variant(F.col("plik"))))
    meta = extent_and_step(points).where("step > 0")
    size = lambda a, b: (F.rint((F.col(b) - F.col(a)) / F.col("step")) + 1).cast("int")
    meta = meta.withColumns({"ncols": size("x0", "x1"), "nrows": size("y0", "y1")})
    place = points.join(meta, "plik").select(
        "plik", "line_no", F.rint((F.col("y1") - F.col("y")) / F.col("step")).cast("int").alias("row"), F.rint((F.col("x") - F.col("x0")) / F.col("step")).cast("int").alias("col"), "z")
    cells = place.groupBy("plik", "row", "col").agg(round_half_even(F.max_by("z", "line_no")).cast("float").alias("z"))
    half = F.col("step") / 2
    out = meta.select("plik", F.col("step").alias("res"), (F.col("x0") - half).alias("left"), (F.col("y0") - half).alias("bottom"), (F.col("x1") + half).alias("right"), (F.col("y1") + half).alias("top"), "ncols", "nrows")
    return out, cells


def lines_of(files: DataFrame) -> DataFrame:
    """(plik, line_no, text) of ``files``(plik, text)."""
    return files.select("plik", F.posexplode(F.split(F.regexp_replace("text", "\r", ""), "\n")).alias("line_no", "text"))
