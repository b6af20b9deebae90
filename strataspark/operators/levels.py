"""Coarser levels from the base layer (A6, A7, J15): nearest, bilinear, cubic, average; greatest source resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataspark.functions.numeric import round_float
from strataspark.operators import chunks

METHODS = {"nearest": "nearest", "bilinear": "bilinear", "cubic": "cubic", "bicubic": "cubic", "average": "average"}


def method_name(name: str) -> str:
    if name.lower() not in METHODS:
        raise ValueError(f"unknown resampling {name}; one of {', '.join(sorted(METHODS))}")
    return METHODS[name.lower()]


def reach(method: str, factor: int) -> int:
    """Base pixels beyond a level cell that weigh on it; the base itself has no kernel."""
    return 0 if factor == 1 else {"bilinear": 1, "cubic": 2}.get(method_name(method), 0) * factor


#: Pixels a side of the blocks that ``resample`` works on, unless told otherwise.
BLOCK = 512


def resample(cells: DataFrame, factor: int, method: str = "bilinear", keys: tuple[str, ...] = (), value: str = "z", height: int | None = None, width: int | None = None, round_places: int | None = 2, block: int = BLOCK) -> DataFrame:
    """(keys, row, col, value) of the level with cells of ``factor`` x ``factor`` base pixels.

    average and nearest group pixels by their parent, which combines before the shuffle; nearest takes child
    (factor // 2, factor // 2). The kernels are widened by the factor and renormalised over valid pixels: pixels are packed
    into dense blocks, one row shuffled a pixel, and blocks exchange partial sums (``chunks.level``). Cells outside height
    and width of the level are dropped; without these the kernels reach no further than the last pixel's parent.
    """
    method = method_name(method)
    valid = cells.where(F.col(value).isNotNull())
    parent = {"row": F.floor(F.col("row") / factor).cast("int"), "col": F.floor(F.col("col") / factor).cast("int")}
    v = F.col(value).cast("double")
    if method == "nearest":
        at = factor // 2
        out = valid.where((F.col("row") % factor == at) & (F.col("col") % factor == at)).withColumns(parent).select(*keys, "row", "col", v.alias(value))
    elif method == "average":
        out = valid.withColumns(parent).groupBy(*keys, "row", "col").agg(F.avg(v).alias(value))
    else:
        if height is None or width is None:
            last = valid.agg(F.max(parent["row"]), F.max(parent["col"])).head()  # two numbers
            height, width = (n if n is not None else (0 if k is None else k + 1) for n, k in zip((height, width), last, strict=True))
        base = chunks.Layout(height * factor, width * factor, block, (value,), "f8", keys)
        level = chunks.Layout(height, width, max(1, block // factor), (value,), "f8", keys)
        out = chunks.cells(chunks.level(chunks.packed(valid, base), base, factor, method, level, None), level).select(*keys, "row", "col", value)
    if height is not None:
        out = out.where((F.col("row") < height) & (F.col("col") < width))
    return out if round_places is None else out.withColumn(value, round_float(F.col(value), round_places))


def coarsest(cells: DataFrame, factor: int, keys: tuple[str, ...] = (), value: str = "res_src") -> DataFrame:
    """Greatest source resolution of each level cell, missing pixels ignored."""
    return cells.where(F.col(value).isNotNull()).groupBy(*keys, F.floor(F.col("row") / factor).cast("int").alias("row"), F.floor(F.col("col") / factor).cast("int").alias("col")).agg(F.max(value).alias(value))
