"""Approximate transform of raster pixels between systems (J14): a mesh whose cells bend by less than a part of a pixel.

The series of a projection is evaluated at the nodes of the mesh only; pixels are placed between them by products of two
numbers. A sheet's mesh is as fine as its own bend asks for, and a cell that still bends too much has its pixels go
through the series, so the bound holds whatever the sheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataspark.functions import crs

#: How far a pixel's centre may be off, in pixels; the share of it that a mesh is laid out for.
TOLERANCE, AIM = 0.125, 0.5
_THIRDS = (0.0, 0.5, 1.0)


def _nodes(top: Column, bottom: Column, left: Column, right: Column, source: int, target: int) -> Column:
    """Corners, middles of edges and the centre of a cell (in rows and columns of a sheet), in the other system: nine (a, b) by rows."""
    at = [(left + (right - left) * u, top + (bottom - top) * v) for v in _THIRDS for u in _THIRDS]
    return F.array(*(crs.moved_in_batches(F.col("left") + c * F.col("res"), F.col("top") - r * F.col("res"), target, source) for c, r in at))


def _bend(nodes: Column) -> Column:
    """How far the middles are from where the corners' bilinear surface has them, at most, in either direction."""
    off = []
    for axis in ("a", "b"):
        v = [nodes[k].getField(axis) for k in range(9)]
        for middle, ends in ((1, (0, 2)), (3, (0, 6)), (5, (2, 8)), (7, (6, 8)), (4, (0, 2, 6, 8))):
            off.append(F.abs(v[middle] - sum((v[e] for e in ends[1:]), v[ends[0]]) / len(ends)))
    return F.greatest(*off)


def mesh(grids: DataFrame, source: int, target: int, tolerance: float = TOLERANCE, carried: tuple[str, ...] = ()) -> DataFrame:
    """Cells (r0, r1, c0, c1: rows and columns of a sheet, ends excluded) of the sheets of ``grids``(plik, res, left, top,
    ncols, nrows), which are in ``target``; with each the four corners' places in ``source``, whether it is ``bent`` and
    the columns ``carried`` of its sheet.

    What a smooth surface bends goes with the square of a cell's edge, so the bend of the whole sheet tells how many
    cells it needs each way. One row of a sheet becomes one row for each of its cells; nothing is shuffled.
    """
    zero, allowed = F.lit(0), F.col("res") * tolerance
    whole = grids.withColumn("nodes_", _nodes(zero, F.col("nrows"), zero, F.col("ncols"), source, target))
    wanted = F.ceil(F.sqrt(_bend(F.col("nodes_")) / (allowed * AIM))).cast("int")
    counted = whole.withColumn("n_", F.least(F.greatest(wanted, F.lit(1)), F.greatest("nrows", "ncols"))).drop("nodes_")
    steps = counted.withColumns({"dr_": F.ceil(F.col("nrows") / F.col("n_")).cast("int"), "dc_": F.ceil(F.col("ncols") / F.col("n_")).cast("int")})
    starts = lambda end, step: F.explode(F.sequence(zero, F.col(end) - 1, F.col(step)))
    cells = steps.withColumn("r0", starts("nrows", "dr_")).withColumn("c0", starts("ncols", "dc_"))
    cells = cells.withColumns({"r1": F.least(F.col("r0") + F.col("dr_"), F.col("nrows")), "c1": F.least(F.col("c0") + F.col("dc_"), F.col("ncols"))})
    placed = cells.withColumn("nodes_", _nodes(F.col("r0"), F.col("r1"), F.col("c0"), F.col("c1"), source, target))
    corners = [F.col("nodes_")[k].alias(name) for k, name in ((0, "nw"), (2, "ne"), (6, "sw"), (8, "se"))]
    return placed.select("plik", "res", "left", "top", *carried, "r0", "r1", "c0", "c1", *corners, (_bend(F.col("nodes_")) > allowed).alias("bent"))


def centres(cells: DataFrame, source: int, target: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """(plik, row, col, sx, sy): the centre of every pixel of a mesh in ``source``; columns ``carried`` of its cell travel
    with it, as Spark takes a table of pixels to be as small as the sheets it comes from, and joins it by broadcast."""
    pixel = cells.withColumn("row", F.explode(F.sequence("r0", F.col("r1") - 1))).withColumn("col", F.explode(F.sequence("c0", F.col("c1") - 1)))
    u = (F.col("col") + 0.5 - F.col("c0")) / (F.col("c1") - F.col("c0"))
    v = (F.col("row") + 0.5 - F.col("r0")) / (F.col("r1") - F.col("r0"))

    def between(axis: str) -> Column:
        at = lambda name: F.col(f"{name}.{axis}")
        north, south = at("nw") + (at("ne") - at("nw")) * u, at("sw") + (at("se") - at("sw")) * u
        return north + (south - north) * v

    x, y = F.col("left") + (F.col("col") + 0.5) * F.col("res"), F.col("top") - (F.col("row") + 0.5) * F.col("res")
    exact = F.when(F.col("bent"), crs.moved_in_batches(F.when(F.col("bent"), x), F.when(F.col("bent"), y), target, source))
    place = F.coalesce(exact, F.struct(between("a").alias("a"), between("b").alias("b")))
    return pixel.withColumn("place_", place).select("plik", "row", "col", *carried, F.col("place_.a").alias("sx"), F.col("place_.b").alias("sy"))
