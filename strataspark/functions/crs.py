"""Transverse Mercator on GRS80 as column expressions (J14, G12), CRS names (P6) and CRS detection."""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# CRS names of the sheet index, and per EPSG code (central meridian, scale, false easting, false northing).
CRS_NAMES = {"PL-1992": 2180, "PL-2000:S5": 2176, "PL-2000:S6": 2177, "PL-2000:S7": 2178, "PL-2000:S8": 2179}
PROJECTIONS = {
    2180: (19.0, 0.9993, 500_000.0, -5_300_000.0),
    2176: (15.0, 0.999923, 5_500_000.0, 0.0),
    2177: (18.0, 0.999923, 6_500_000.0, 0.0),
    2178: (21.0, 0.999923, 7_500_000.0, 0.0),
    2179: (24.0, 0.999923, 8_500_000.0, 0.0),
}
_A, _F = 6378137.0, 1 / 298.257222101
_N = _F / (2 - _F)
_E = math.sqrt(_F * (2 - _F))
#: Krueger series to the fourth power of n: radius of the rectifying sphere, forward and inverse coefficients.
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)


class _Columns:
    """The functions of ``math`` that are used here, for columns; ``let``: name values once, use them often; ``then``: go
    on with a pair, which is made once."""

    sin, cos, tan, sinh, cosh, atan, atan2, sqrt = (staticmethod(f) for f in (F.sin, F.cos, F.tan, F.sinh, F.cosh, F.atan, F.atan2, F.sqrt))

    @staticmethod
    def atanh(x):
        return F.log((F.lit(1.0) + x) / (F.lit(1.0) - x)) / 2

    @staticmethod
    def asinh(x):
        return F.when(x < 0, -F.log(-x + F.sqrt(x * x + 1))).otherwise(F.log(x + F.sqrt(x * x + 1)))

    @staticmethod
    def _bound(value, body):
        def run(v):
            out = body(v)
            return F.struct(out[0].alias("a"), out[1].alias("b")) if isinstance(out, tuple) else out

        return F.transform(F.array(value), run)[0]

    @staticmethod
    def let(body, **values):
        return _Columns._bound(F.struct(*(x.alias(k) for k, x in values.items())), lambda v: body(**{k: v.getField(k) for k in values}))

    @staticmethod
    def then(body, pair):
        return _Columns._bound(pair, lambda v: body(*_pair(v)))


class _Floats:
    sin, cos, tan, sinh, cosh, atan, atan2, sqrt, atanh, asinh = (staticmethod(getattr(math, n)) for n in ("sin", "cos", "tan", "sinh", "cosh", "atan", "atan2", "sqrt", "atanh", "asinh"))

    @staticmethod
    def let(body, **values):
        return body(**values)

    @staticmethod
    def then(body, pair):
        return body(*pair)


class _Arrays(_Floats):
    """For arrays of double precision."""

    sin, cos, tan, sinh, cosh, atan, atan2, sqrt, atanh, asinh = (staticmethod(getattr(np, n)) for n in ("sin", "cos", "tan", "sinh", "cosh", "arctan", "arctan2", "sqrt", "arctanh", "arcsinh"))


COLUMNS, FLOATS, ARRAYS = _Columns, _Floats, _Arrays


def _pair(x: Any) -> tuple[Any, Any]:
    return x if isinstance(x, tuple) else (x.getField("a"), x.getField("b"))


def to_plane(lon: Any, lat: Any, epsg: int, m: Any = FLOATS) -> tuple[Any, Any]:
    """(easting, northing) of degrees; columns with ``m=COLUMNS``."""
    return _pair(_plane(lon, lat, epsg, m))


def _plane(lon: Any, lat: Any, epsg: int, m: Any) -> Any:
    lon0, k, fe, fn = PROJECTIONS[epsg]

    def series(xi, eta):
        x, y = eta, xi
        for j, a in enumerate(_ALPHA, 1):
            x = x + m.cos(xi * (2 * j)) * m.sinh(eta * (2 * j)) * a
            y = y + m.sin(xi * (2 * j)) * m.cosh(eta * (2 * j)) * a
        return x * (k * _R) + fe, y * (k * _R) + fn

    def sphere(t, lam):
        return m.let(series, xi=m.atan2(t, m.cos(lam)), eta=m.asinh(m.sin(lam) / m.sqrt(t * t + m.cos(lam) * m.cos(lam))))

    def conformal(phi, lam):
        return m.let(sphere, t=m.sinh(m.atanh(m.sin(phi)) - m.atanh(m.sin(phi) * _E) * _E), lam=lam)

    return m.let(conformal, phi=lat * (math.pi / 180), lam=(lon - lon0) * (math.pi / 180))


def to_degrees(east: Any, north: Any, epsg: int, m: Any = FLOATS) -> tuple[Any, Any]:
    return _pair(_degrees(east, north, epsg, m))


def _degrees(east: Any, north: Any, epsg: int, m: Any) -> Any:
    lon0, k, fe, fn = PROJECTIONS[epsg]

    def sphere(xi, eta):
        xi2, eta2 = xi, eta
        for j, b in enumerate(_BETA, 1):
            xi2 = xi2 - m.sin(xi * (2 * j)) * m.cosh(eta * (2 * j)) * b
            eta2 = eta2 - m.cos(xi * (2 * j)) * m.sinh(eta * (2 * j)) * b
        return m.let(conformal, xi=xi2, eta=eta2)

    def conformal(xi, eta):
        lam = m.atan2(m.sinh(eta), m.cos(xi))
        tau = m.sin(xi) / m.sqrt(m.sinh(eta) * m.sinh(eta) + m.cos(xi) * m.cos(xi))
        return m.let(step(3), goal=tau, tau=tau, lam=lam)

    def step(left):  # Newton steps from the conformal to the geographic latitude
        def latitude(goal, tau, lam):
            if not left:
                return lam * (180 / math.pi) + lon0, m.atan(tau) * (180 / math.pi)
            return m.let(refine, goal=goal, tau=tau, lam=lam, root=m.sqrt(tau * tau + 1))

        def refine(goal, tau, lam, root):
            return m.let(move, goal=goal, tau=tau, lam=lam, root=root, s=m.sinh(m.atanh(tau / root * _E) * _E))

        def move(goal, tau, lam, root, s):
            t = tau * m.sqrt(s * s + 1) - s * root
            better = tau + (goal - t) / m.sqrt(t * t + 1) * ((tau * tau * (1 - _E**2) + 1) / (root * (1 - _E**2)))
            return m.let(step(left - 1), goal=goal, tau=better, lam=lam)

        return latitude

    return m.let(sphere, xi=(north - fn) / (k * _R), eta=(east - fe) / (k * _R))


def transform(east: Any, north: Any, source: int, target: int, m: Any = FLOATS) -> tuple[Any, Any]:
    """Between two of the systems; their datum is the same."""
    if source == target:
        return east, north

    return _pair(moved(east, north, source, target, m))


def moved(east: Any, north: Any, source: int, target: int, m: Any = COLUMNS) -> Any:
    """``transform`` as one value: a struct (a, b) for columns, so that nothing is worked out twice."""
    if source == target:
        return F.struct(east.alias("a"), north.alias("b")) if m is COLUMNS else (east, north)
    return m.then(lambda lon, lat: _plane(lon, lat, target, m), _degrees(east, north, source, m))


def moved_in_batches(east: Column, north: Column, source: int, target: int) -> Column:
    """``moved`` for many rows: the same series on Arrow batches, where an expression of nested functions is interpreted row
    by row. Coordinates that are null are left out of the work; their place is null."""
    if source == target:
        return moved(east, north, source, target)

    def places(x: pa.Array, y: pa.Array) -> pa.Array:
        return _moved_arrays(x, y, source, target)

    return F.arrow_udf(places, "a double, b double")(east.cast("double"), north.cast("double"))


def _moved_arrays(x: pa.Array, y: pa.Array, source: int, target: int) -> pa.Array:
    missing = x.is_null().to_numpy(zero_copy_only=False) | y.is_null().to_numpy(zero_copy_only=False)
    east, north = (v.to_numpy(zero_copy_only=False)[~missing] for v in (x, y))
    sides = []
    with np.errstate(all="ignore"):
        for found in moved(east, north, source, target, ARRAYS):
            side = np.full(len(missing), np.nan)
            side[~missing] = found
            sides.append(pa.array(side, mask=missing))
    return pa.StructArray.from_arrays(sides, ["a", "b"])


def detect(lines: DataFrame, limit: int = 200, places: tuple[str, ...] = ()) -> DataFrame:
    """(plik, epsg) from ``lines``(plik, line_no from 0, text): the first of ``limit`` lines that tells.

    Lines that share a number are taken in the order of the columns ``places``, the last one first; without such
    columns any of them may tell.

    Lines that start with a letter or # are skipped; fields are parted by white space, commas or semicolons. Where the
    first value is below 100,000 and a third field is there, the first is an id and the next two are the coordinates.
    A line with a coordinate below 100,000, or one that is no number, does not tell. A coordinate above 4,000,000 tells
    the zone by its first digit, two coordinates of six digits tell PL-1992.
    """
    least, digits = F.lit(1e5), lambda x: F.floor(x).cast("string")
    part = F.filter(F.split(F.trim("text"), r"[\s,;]+"), lambda p: p != "")
    rows = lines.where((F.col("line_no") < limit) & ~F.col("text").rlike(r"^\s*[A-Za-z#]"))
    value: Callable = lambda p, k: F.try_element_at(p, F.lit(k + 1)).try_cast("double")
    # Through a generator, so that the filters on the values do not split the text again.
    told = F.transform(F.array(part), lambda p: F.struct(F.size(p).alias("fields"), *(value(p, k).alias(f"v{k}") for k in range(3))))
    numbers = rows.select("plik", "line_no", *places, F.inline(told)).where("fields >= 2 and v0 is not null and v1 is not null")
    has_id = (F.col("v0") < least) & (F.col("fields") >= 3)
    placed = numbers.select("plik", "line_no", *places, F.when(has_id, F.col("v1")).otherwise(F.col("v0")).alias("x"), F.when(has_id, F.col("v2")).otherwise(F.col("v1")).alias("y")).where((F.col("x") >= least) & (F.col("y") >= least))
    zone = F.substring(digits(F.when(F.col("x") > 4e6, F.col("x")).when(F.col("y") > 4e6, F.col("y"))), 1, 1)
    plane = F.greatest("x", "y") < 1e6
    epsg = F.when(zone.isin("5", "6", "7", "8"), F.lit(2171) + zone.cast("int")).when(plane & (F.least("x", "y") > least), F.lit(2180))
    first = F.max_by("epsg", F.struct(-F.col("line_no"), *places)) if places else F.min_by("epsg", "line_no")
    told = placed.withColumn("epsg", epsg).where("epsg is not null").groupBy("plik").agg(first.cast("int").alias("epsg"))
    return lines.select("plik").distinct().join(told, "plik", "left")
