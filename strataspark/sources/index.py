"""Sheet index, county boundary and configuration."""

from __future__ import annotations

import json
import warnings
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.sources.files import Files

#: Element names of the index that are read as columns.
INDEX_FIELDS = ("godlo", "akt_data", "format", "nr_zglosz", "uklad_xy", "url_do_pobrania", "char_przestrz", "uklad_h", "blad_sr_wys", "zrodlo_danych")


def read_config(path: str, required: tuple[str, ...] = ()) -> dict:
    """A JSON object; a missing file, bad JSON or a missing or empty required key raises ValueError."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise ValueError(f"configuration {path}: {e}") from e
    missing = [k for k in required if not found.get(k)]
    if missing:
        raise ValueError(f"configuration {path} lacks {', '.join(missing)}")
    return found


def checked_options(options: dict) -> dict:
    """Without conversion there is neither store nor mosaic, so both are switched off with a warning; after that, one
    excludes the other."""
    out = dict(options)
    if options.get("konwersja") is False:
        for name in ("zarr", "geotiff"):
            if options.get(name):
                warnings.warn(f"{name} needs conversion and is left out", stacklevel=2)
            out[name] = False
    if out.get("zarr") and out.get("geotiff"):
        raise ValueError("a layer store and a single mosaic exclude each other")
    return out


def year_list(value, start: int, this_year: int) -> list[int]:
    """A list, ``auto`` (start to this year) or a comma-separated string."""
    if isinstance(value, str) and value.strip().lower() == "auto":
        return list(range(start, this_year + 1))
    return [int(v) for v in (value if isinstance(value, list) else clean_list(value))]


def clean_list(value: str) -> list[str]:
    """P3."""
    return [v.strip() for v in value.split(",") if v.strip()]


def clean_list_column(value: Column) -> Column:
    return F.filter(F.transform(F.split(value, ","), lambda v: F.trim(v)), lambda v: v != "")


def named(counties: DataFrame, name: str, column: str = "name") -> DataFrame:
    """Whole-word, case-insensitive match; ``name`` is a pattern. Unicode letters count as such."""
    return counties.where(F.col(column).rlike(rf"(?iuU)\b{name}\b"))


def read_boundaries(spark: SparkSession, path: str, name: str = "JPT_NAZWA_") -> DataFrame:
    """(seq, name, rings) of a GeoJSON file of polygons or multipolygons."""
    schema = f"features array<struct<properties:struct<{name}:string>,geometry:struct<type:string,coordinates:string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.posexplode("features").alias("seq", "f"))
    polygon = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.flatten(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>"))
    return rows.select("seq", F.col(f"f.properties.{name}").alias("name"), F.when(F.col("f.geometry.type") == "Polygon", polygon).otherwise(many).alias("rings"))


_ENVELOPE = "boundedBy struct<Envelope:struct<lowerCorner:string,upperCorner:string>>"
INDEX_SCHEMA = ", ".join([*(f"{f} string" for f in INDEX_FIELDS), _ENVELOPE])


def index_rows(parsed: DataFrame, *keep: Column) -> DataFrame:
    """``keep``, the fields and ``bounds`` of parsed index elements; rows without both corners are dropped."""
    corner = lambda which, k: F.try_element_at(F.split(F.trim(F.col(f"boundedBy.Envelope.{which}")), r"\s+"), F.lit(k)).try_cast("double")
    bounds = F.struct(corner("lowerCorner", 1).alias("left"), corner("lowerCorner", 2).alias("bottom"), corner("upperCorner", 1).alias("right"), corner("upperCorner", 2).alias("top"))
    out = parsed.select(*keep, *INDEX_FIELDS, bounds.alias("bounds"))
    return out.where("bounds.left is not null and bounds.bottom is not null and bounds.right is not null and bounds.top is not null")


def read_index(spark: SparkSession, path: str, row_tag: str, year: int) -> DataFrame:
    """S3: index rows of one year from XML files."""
    rows = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).schema(INDEX_SCHEMA).load(path)
    return index_rows(rows, F.lit(year).alias("rok"))


def parse_index(elements: DataFrame, text: str, *keep: str) -> DataFrame:
    """S3 for elements that are a column: ``keep`` columns and what ``index_rows`` gives."""
    parsed = elements.select(*keep, F.from_xml(F.col(text), INDEX_SCHEMA, {"ignoreNamespace": "true", "mode": "PERMISSIVE"}).alias("element"))
    return index_rows(parsed.select(*keep, "element.*"), *map(F.col, keep))


def cached_boundaries(spark: SparkSession, path: str, fetch=None, name: str = "JPT_NAZWA_") -> DataFrame:
    """The boundaries kept at ``path``; where they are not, ``fetch()`` gives the GeoJSON bytes to keep."""
    files = Files(spark)
    if not files.exists(path):
        if fetch is None:
            raise FileNotFoundError(path)
        files.replace(path, fetch())
    return read_boundaries(spark, path, name)
