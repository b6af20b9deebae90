"""Rounding and missing values as array libraries have them (P14, P-NaN, P-ROUND) and short number names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, places: int = 2) -> Column:
    """rint(x * 10^p) / 10^p in double precision."""
    scale = F.lit(float(10**places))
    return F.rint(x.cast("double") * scale) / scale


def round_float(x: Column, places: int = 2) -> Column:
    """The same in single precision, as rasters are rounded: product and quotient are floats."""
    scale = F.lit(10**places).cast("float")
    return (F.rint((x.cast("float") * scale).cast("double")) / F.lit(float(10**places))).cast("float")


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x.cast("double")), x)


def no_data_to_null(x: Column, no_data: Column) -> Column:
    """The sentinel is compared in single precision."""
    return F.when(x.cast("float") != no_data.cast("float"), x.cast("float"))


def short_number(x: float) -> str:
    return f"{x:g}"


def short_number_column(x: Column) -> Column:
    """``%g`` for values that levels take: six significant digits, trailing zeros dropped."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", x.cast("double")), "0+$", ""), r"\.$", "")
