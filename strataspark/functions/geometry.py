"""Polygon predicates as column expressions (J1, J11, J12, P16). A polygon is a list of rings of (x, y); holes are rings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.functions.grid import SIDES

Rings = list[list[tuple[float, float]]]


def edges(rings: Rings) -> list[tuple[float, float, float, float]]:
    out = []
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (x1, y1) != (x2, y2):
                out.append((float(x1), float(y1), float(x2), float(y2)))
    return out


def bounds(rings: Rings) -> tuple[float, float, float, float]:
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    return min(xs), min(ys), max(xs), max(ys)


def _edge_array(rings: Rings) -> Column:
    return F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(e, ("x1", "y1", "x2", "y2"), strict=True))) for e in edges(rings)))


def contains_point(rings: Rings, x: Column, y: Column) -> Column:
    """Even-odd rule with half-open edges: a centre on a shared edge belongs to one side only."""
    left, bottom, right, top = bounds(rings)
    crossing = F.filter(_edge_array(rings), lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1))
    near = (x >= F.lit(left)) & (x <= F.lit(right)) & (y >= F.lit(bottom)) & (y <= F.lit(top))
    return near & (F.size(crossing) % 2 == 1)


def inside(cells: DataFrame, rings: Rings, x: Column, origin: float, step: float, row: str = "row") -> DataFrame:
    """``cells`` whose centre (``x``, origin + step * (row + 0.5)) lies inside, by the rule of ``contains_point``.

    Where the boundary crosses each row is worked out once; a cell then looks at its own row's crossings only, found by an
    equi-join on the row, so the cost does not grow with the number of edges times cells.
    """
    spark, first = cells.sparkSession, f"{row}_crossed_"
    lines = spark.createDataFrame(edges(rings) or [(0.0, 0.0, 0.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    at = lambda y: (y - F.lit(float(origin))) / F.lit(float(step)) - 0.5
    low, high = F.least(at(F.col("y1")), at(F.col("y2"))), F.greatest(at(F.col("y1")), at(F.col("y2")))
    met = lines.withColumn(first, F.explode(F.sequence(F.floor(low), F.ceil(high))))
    y = F.lit(float(origin)) + F.lit(float(step)) * (F.col(first) + F.lit(0.5))
    crossed = met.where((F.col("y1") > y) != (F.col("y2") > y)).select(first, ((F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")).alias("x_"))
    places = crossed.groupBy(first).agg(F.collect_list("x_").alias("places_"))
    odd = F.size(F.filter("places_", lambda p: x < p)) % 2 == 1
    return cells.join(places, F.col(row).cast("long") == F.col(first)).where(odd).drop(first, "places_")


def edge_table(spark: SparkSession, rings: Rings) -> DataFrame:
    """(x1, y1, x2, y2, left, bottom, right, top) of every edge."""
    e = spark.createDataFrame(edges(rings) or [(0.0, 0.0, 0.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    return e.withColumns({"left": F.least("x1", "x2"), "bottom": F.least("y1", "y2"), "right": F.greatest("x1", "x2"), "top": F.greatest("y1", "y2")})


def edge_meets(box: str = "", edge: str = "d_") -> Column:
    """Whether an edge shares a point with a box, given that their boxes touch: corners of the box do not all lie strictly on
    one side of the edge's line."""
    c = lambda n: F.col(f"{edge}{n}")
    sides = [(c("x2") - c("x1")) * (F.col(f"{box}{y}") - c("y1")) - (c("y2") - c("y1")) * (F.col(f"{box}{x}") - c("x1")) for x in ("left", "right") for y in ("bottom", "top")]
    return (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def classed(boxes: DataFrame, rings: Rings, key: list[str], name: str = "place") -> DataFrame:
    """``boxes`` with ``name``: ``boundary`` where an edge of the polygon shares a point with the box, else ``inside`` or
    ``outside``. ``key`` names a box.

    Boxes meet edges on lattices by size (``plan.meeting``), so a box looks at the edges near it only, and a short edge at few
    boxes. Boxes that no edge meets are all inside or all outside: their centres count the edges that pass to their right,
    which they meet by the strip of y they lie in.
    """
    from strataspark.operators import plan

    spark, x0, y0, x1, y1 = boxes.sparkSession, *bounds(rings)
    near = boxes.where((F.col("left") <= x1) & (F.col("right") >= x0) & (F.col("bottom") <= y1) & (F.col("top") >= y0))
    lines = edge_table(spark, rings)
    met = plan.meeting(near.select(*key, *SIDES), lines, strict=False).where(edge_meets()).select(*key).distinct().withColumn("met_", F.lit(True))
    strips = max(1.0, (y1 - y0) / max(1, min(len(edges(rings)), 4096)))
    strip = lambda y: F.floor((y - F.lit(float(y0))) / F.lit(strips))
    cx, cy = (F.col("left") + F.col("right")) / 2, (F.col("bottom") + F.col("top")) / 2
    centre = near.join(met, key, "left_anti").select(*key, cx.alias("cx_"), cy.alias("cy_"), strip(cy).alias("strip_"))
    passed = lines.where("y1 <> y2").withColumn("strip_", F.explode(F.sequence(strip(F.col("bottom")), strip(F.col("top"))))).select("strip_", "x1", "y1", "x2", "y2")
    y = F.col("cy_")
    crossing = ((F.col("y1") > y) != (F.col("y2") > y)) & (F.col("cx_") < (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    odd = centre.join(passed, "strip_").where(crossing).groupBy(*key).agg((F.count("*") % 2 == 1).alias("odd_"))
    found = boxes.join(met, key, "left").join(odd, key, "left")
    place = F.when(F.col("met_"), "boundary").when(F.col("odd_"), "inside").otherwise("outside")
    return found.select(*boxes.columns, place.alias(name))


def box_touches(rings: Rings, left: Column, bottom: Column, right: Column, top: Column) -> Column:
    """Box and polygon share a point; touching passes. An edge meets the box (slab test), or the box lies inside."""

    def clip(e) -> Column:
        dx, dy = e.x2 - e.x1, e.y2 - e.y1
        lo, hi = F.lit(0.0), F.lit(1.0)
        ok = F.lit(True)
        for d, start, a, b in ((dx, e.x1, left, right), (dy, e.y1, bottom, top)):
            t1, t2 = (a - start) / F.when(d != 0, d), (b - start) / F.when(d != 0, d)
            ok = ok & F.when(d == 0, (start >= a) & (start <= b)).otherwise(F.lit(True))
            lo = F.greatest(lo, F.least(t1, t2))  # greatest and least skip the nulls of a parallel edge
            hi = F.least(hi, F.greatest(t1, t2))
        return ok & (lo <= hi)

    return F.exists(_edge_array(rings), clip) | contains_point(rings, (left + right) / 2, (bottom + top) / 2)
