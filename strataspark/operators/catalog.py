"""Sheet catalogue: filters, first-wins dedup, lookups with defaults, campaigns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataspark.functions import crs, geometry
from strataspark.functions.numeric import round_half_even

UNKNOWN_DATE = "0001-01-01"
#: Values that the ranges of a distributed rank are taken from.
RANGE_SAMPLE = 1_000


def file_name(url: Column) -> Column:
    """P8."""
    return F.element_at(F.split(url, "/"), -1)


def iso_date(value: Column) -> Column:
    """ISO date, or '' where it is none."""
    return F.coalesce(F.date_format(F.try_to_timestamp(value.cast("string")), "yyyy-MM-dd"), F.lit(""))


def shown(value: Column) -> Column:
    """P10."""
    return F.coalesce(value.cast("string"), F.lit(""))


def to_be_done(fmt: Column, mark: str = "TBD") -> Column:
    """P5."""
    return F.coalesce(F.upper(F.trim(fmt)).contains(mark), F.lit(False))


def known_crs(sheets: DataFrame, name: str = "uklad_xy", names: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(sheets with ``epsg``, sheets whose system is not in the table). The table has a fixed handful of rows."""
    table = sheets.sparkSession.createDataFrame(list((names or crs.CRS_NAMES).items()), f"{name} string, epsg int")
    return sheets.join(F.broadcast(table), name), sheets.join(F.broadcast(table), name, "left_anti")


def first_of(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; the limit is applied in each task before the shuffle."""
    return rows.withColumn("first_", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("first_ = 1").drop("first_")


def lookup_with_default(rows: DataFrame, first: DataFrame, second: DataFrame, key1: str, key2: str, value: str, default=None) -> DataFrame:
    """``value`` by ``key1`` in ``first``, else by ``key2`` in ``second``, else ``default``. Keys are unique there."""
    a = first.select(key1, F.col(value).alias("value1_"))
    b = second.select(key2, F.col(value).alias("value2_"))
    picked = F.coalesce("value1_", "value2_", F.lit(default)) if default is not None else F.coalesce("value1_", "value2_")
    return rows.join(a, key1, "left").join(b, key2, "left").withColumn(value, picked).drop("value1_", "value2_")


def last_archive(found: DataFrame) -> DataFrame:
    """Member to archive; of several archives the last one in scan order."""
    return found.groupBy("member").agg(F.max_by("archive", "seq").alias("archive"))


#: Edges of a polygon up to which a box tests them all as literals.
FEW_EDGES = 64


def touching(sheets: DataFrame, rings: geometry.Rings, left="left", bottom="bottom", right="right", top="top") -> DataFrame:
    """Sheets or blocks whose box shares a point with the polygon; the bounding box is tested first. Polygons of more
    than ``FEW_EDGES`` edges meet the distinct boxes on lattices (``geometry.classed``)."""
    if len(geometry.edges(rings)) > FEW_EDGES:
        sides = [F.col(c).cast("double").alias(n) for c, n in zip((left, bottom, right, top), geometry.SIDES, strict=True)]
        boxes = sheets.select(*sides).distinct().where("left is not null and bottom is not null and right is not null and top is not null")
        near = geometry.classed(boxes, rings, list(geometry.SIDES)).where("place <> 'outside'").select(*(F.col(n).alias(f"near_{n}") for n in geometry.SIDES))
        same = [sheets[c].cast("double") == near[f"near_{n}"] for c, n in zip((left, bottom, right, top), geometry.SIDES, strict=True)]
        return sheets.join(near, same, "left_semi")
    x0, y0, x1, y1 = geometry.bounds(rings)
    near = (F.col(left) <= x1) & (F.col(right) >= x0) & (F.col(bottom) <= y1) & (F.col(top) >= y0)
    return sheets.where(near & geometry.box_touches(rings, F.col(left), F.col(bottom), F.col(right), F.col(top)))


def total_bounds(sheets: DataFrame) -> DataFrame:
    """A1."""
    return sheets.agg(F.min("left").alias("left"), F.min("bottom").alias("bottom"), F.max("right").alias("right"), F.max("top").alias("top"))


def campaign_formats(sheets: DataFrame, campaign: str = "nr_zglosz", fmt: str = "format") -> DataFrame:
    """The pairs of campaign and format."""
    return sheets.select(campaign, fmt).distinct()


def of_campaign(sheets: DataFrame, campaign_value, fmt_value, campaign: str = "nr_zglosz", fmt: str = "format") -> DataFrame:
    """The sheets of one campaign in one format; null is a value of its own."""
    return sheets.where(F.col(campaign).eqNullSafe(F.lit(campaign_value)) & F.col(fmt).eqNullSafe(F.lit(fmt_value)))


def counters(sheets: DataFrame, fmt: str = "format", name: str = "uklad_xy", names: dict[str, int] | None = None, mark: str = "TBD") -> DataFrame:
    """One row (tbd, unknown_crs, all_rows)."""
    unknown = ~F.coalesce(F.col(name).isin(*(names or crs.CRS_NAMES)), F.lit(False))
    return sheets.agg(F.count_if(to_be_done(F.col(fmt), mark)).alias("tbd"), F.count_if(unknown).alias("unknown_crs"), F.count("*").alias("all_rows"))


def resolution_counters(tiles: DataFrame, base: float, res: str = "res") -> DataFrame:
    """One row (grubsze, drobniejsze): sheets coarser and finer than the base cell."""
    r = stored_resolution(F.col(res))
    return tiles.agg(F.count_if(r > base + 1e-6).alias("grubsze"), F.count_if(r < base - 1e-6).alias("drobniejsze"))


def stored_resolution(res: Column) -> Column:
    return round_half_even(res)


def finest(tiles: DataFrame, by: tuple[str, ...] = (), res: str = "res", rounded: bool = True) -> DataFrame:
    """A2: ``finest`` resolution, to two places for a store and as it is for a single mosaic."""
    value = stored_resolution(F.col(res)) if rounded else F.col(res)
    return tiles.groupBy(*by).agg(F.min(value).alias("finest"))


def coarsest(tiles: DataFrame, by: tuple[str, ...] = (), res: str = "res") -> DataFrame:
    """A3: ``coarsest`` resolution, to two places."""
    return tiles.groupBy(*by).agg(F.max(stored_resolution(F.col(res))).alias("coarsest"))


def campaigns(sheets: DataFrame, campaign: str, seq: str) -> DataFrame:
    """Campaigns in first-seen order with their ordinal from 0. Campaigns are ranked in parallel ranges."""
    seen = sheets.groupBy(campaign).agg(F.min(seq).alias("first_seq"))
    return dense_ordinals(seen, ["first_seq"], "ordinal")


def dense_ordinals(rows: DataFrame, order: list[str], name: str, descending: bool = False) -> DataFrame:
    """``name``: dense rank of each row from 0, without one task that sorts all rows.

    Rows are dealt by ranges of the first ordering column into buckets, ranked in each, and the number of distinct
    values in the buckets before is added; that table has one row per bucket. The ranges come from ``RANGE_SAMPLE``
    values drawn by their hash, so they do not change between the reads of a plan; they only balance the buckets.
    """
    first = F.col(order[0])
    drawn = rows.select(first.alias("v")).where("v is not null").distinct().orderBy(F.xxhash64("v"), "v").limit(RANGE_SAMPLE).collect()
    values = sorted(r.v for r in drawn)
    buckets = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    edges = sorted({values[k * len(values) // buckets] for k in range(1, buckets)}) if values else []
    above = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: first > e)) if edges else F.lit(0)
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    bucket = F.coalesce(F.when(first.isNotNull(), above), F.lit(-1))  # nulls are least
    placed = rows.withColumn("bucket_", -bucket if descending else bucket)
    within = placed.withColumn(name, F.dense_rank().over(Window.partitionBy("bucket_").orderBy(*map(way, order))))
    sizes = within.groupBy("bucket_").agg(F.max(name).alias("size_"))
    before = sizes.select("bucket_", (F.sum("size_").over(Window.orderBy("bucket_")) - F.col("size_")).alias("before_"))  # one row per bucket
    return within.join(F.broadcast(before), "bucket_").withColumn(name, (F.col(name) + F.col("before_") - 1).cast("int")).drop("bucket_", "before_")


def resolution_histogram(sheets: DataFrame, res: str = "res") -> DataFrame:
    """A4."""
    return sheets.groupBy(F.col(res)).agg(F.count("*").alias("n"))


def newest_first(path_descending: bool = True, date: str = "akt_data", path: str = "plik", seq: str = "seq") -> list[Column]:
    """O1 (store: path descending) and O2 (single mosaic: conversion order); an unknown date is the oldest (O3)."""
    when = F.coalesce(F.col(date).cast("string"), F.lit(UNKNOWN_DATE)).desc()
    return [when, F.col(path).desc() if path_descending else F.col(seq).asc()]
