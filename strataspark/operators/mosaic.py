"""Mosaic of overlapping sheets: the first value by precedence wins each pixel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataspark.operators import catalog, warp


def first_wins(cells: DataFrame, pixel: list[str], precedence: list[Column], value: str = "z", carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per pixel: ``value`` and ``carried`` of the row with the greatest ``precedence`` among non-null values.

    Nulls of ``value`` (and NaN) never win, so coarser or older sheets fill the gaps. ``max_by`` is a partial
    aggregate: each task keeps one candidate per pixel before the shuffle, however many sheets overlap.
    """
    known = cells.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    names = (value, *carried)
    best = F.max_by(F.struct(*names), F.struct(*precedence))
    return known.groupBy(*pixel).agg(best.alias("best_")).select(*pixel, *(F.col(f"best_.{n}").alias(n) for n in names))


def on_grid(sheet_meta: DataFrame, sheet_cell: DataFrame, grid, rings=None) -> DataFrame:
    """Target pixels (row, col) of every sheet with (z, res_src, akt_data, plik), nearest cell.

    Sheets are told apart by ``member`` where the cells have it, else by ``plik``; that name is ``plik`` in the result.

    Each source cell is sent to the target pixels whose centres it holds (one if it is as fine, several if coarser),
    which is an equi-join on the sheet and no range join; pixels outside the grid or the polygon are dropped.
    """
    from strataspark.functions import geometry

    c = grid.cellsize
    key = "member" if "member" in sheet_cell.columns else "plik"
    cell = sheet_cell.select(key, "row", "col", "z").join(sheet_meta.select(key, "res", "left", "top", "akt_data"), key)
    x0, y1 = F.col("left") + F.col("col") * F.col("res"), F.col("top") - F.col("row") * F.col("res")
    first_col, last_col = F.ceil((x0 - grid.left) / c - 0.5), F.ceil((x0 + F.col("res") - grid.left) / c - 0.5) - 1
    first_row, last_row = F.ceil((grid.top - y1) / c - 0.5), F.ceil((grid.top - y1 + F.col("res")) / c - 0.5) - 1
    span = lambda a, b: F.explode(F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>")))
    placed = cell.withColumn("tc_", span(first_col, last_col)).withColumn("tr_", span(first_row, last_row))
    inside = placed.where((F.col("tc_") >= 0) & (F.col("tr_") >= 0) & (F.col("tc_") < grid.width) & (F.col("tr_") < grid.height))
    out = inside.select(F.col("tr_").cast("int").alias("row"), F.col("tc_").cast("int").alias("col"), "z", F.col("res").cast("float").alias("res_src"), "akt_data", F.col(key).alias("plik"))
    return out if rings is None else geometry.inside(out, rings, grid.x_of(F.col("col")), grid.top, -c)


def ranked(sheets: DataFrame, key: str, path_descending: bool = True) -> DataFrame:
    """(key, rank_ long): W1's precedence of sheets, the greater the earlier: newest first, an unknown date is the oldest,
    then by path. One sort of the sheets of one layer, all of which its manifest lists anyway; ``catalog.dense_ordinals``
    ranks tables that grow."""
    dated = sheets.groupBy(key).agg(F.max(F.coalesce(F.col("akt_data").cast("string"), F.lit(catalog.UNKNOWN_DATE))).alias("date_"))
    order = Window.orderBy("date_", F.col(key).asc() if path_descending else F.col(key).desc())
    return dated.select(key, F.row_number().over(order).cast("long").alias("rank_"))


def first_ranked(cells: DataFrame, pixel: list[str], rank: str = "rank_", value: str = "z", carried: tuple[str, ...] = ()) -> DataFrame:
    """``first_wins`` where precedence is one number: every buffer of the aggregate is of fixed width, so it is a hash
    aggregate and no pixel is sorted. Cells of one sheet and pixel have one value each."""
    known = cells.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return known.groupBy(*pixel).agg(*(F.max_by(n, rank).alias(n) for n in (value, *carried)))


def base_layer(sheet_meta: DataFrame, sheet_cell: DataFrame, grid, rings=None, path_descending: bool = True) -> DataFrame:
    """W1 on a grid: newest sheet first, then the greater path (or the lesser one); an unknown date is the oldest. The rank of
    a sheet and its resolution travel with its pixels as two numbers.

    A sheet coarser than the grid gives a pixel one value, a finer one the nearest cell, so a sheet has one value a pixel.
    """
    key = "member" if "member" in sheet_cell.columns else "plik"
    ranks = ranked(sheet_meta.select(key, "akt_data"), key, path_descending)
    placed = on_grid(sheet_meta, sheet_cell, grid, rings).join(ranks.withColumnRenamed(key, "plik"), "plik")
    return first_ranked(placed, ["row", "col"], "rank_", "z", ("res_src",))


def reprojected(sheet_meta: DataFrame, sheet_cell: DataFrame, source: int, target: int, tolerance: float | None = warp.TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """Sheets of one system on grids of another, nearest cell.

    A sheet's target cell is its own, rounded to 2 places, and its bounds are those of its transformed edge, snapped
    outward. Every target centre is taken back, at most ``tolerance`` of a pixel off (``warp``; None: by the full
    series), and equi-joined with the source cell that holds it.

    Sheets are dealt over tasks by number: they are small rows that become many pixels, so their bytes tell nothing of
    the work. Sheets are joined before they become pixels, and pixels by sorting, for the same reason.
    """
    from strataspark.functions import crs
    from strataspark.functions.numeric import round_half_even

    share = F.explode(F.transform(F.sequence(F.lit(0), F.lit(8)), lambda k: k / 8.0))
    deal = lambda sheets: sheets.repartition(int(sheets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "plik")
    dealt = deal(sheet_meta)
    edge = dealt.withColumn("s_", share).withColumn("side_", F.explode(F.array(*map(F.lit, range(4)))))
    mid = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * F.col("s_")
    x = F.when(F.col("side_") == 0, F.col("left")).when(F.col("side_") == 1, F.col("right")).otherwise(mid("left", "right"))
    y = F.when(F.col("side_") == 2, F.col("bottom")).when(F.col("side_") == 3, F.col("top")).otherwise(mid("bottom", "top"))
    cell = round_half_even(F.col("res"))
    box = edge.select("plik", cell.alias("cell_"), crs.moved_in_batches(x, y, source, target).alias("to_")).select("plik", "cell_", F.col("to_.a").alias("x_"), F.col("to_.b").alias("y_")).groupBy("plik", "cell_").agg(F.min("x_").alias("l"), F.min("y_").alias("b"), F.max("x_").alias("r"), F.max("y_").alias("t"))
    down, up = (lambda v: F.floor(F.col(v) / F.col("cell_")) * F.col("cell_")), (lambda v: F.ceil(F.col(v) / F.col("cell_")) * F.col("cell_"))
    new = deal(box).select("plik", F.col("cell_").alias("res"), down("l").alias("left"), down("b").alias("bottom"), up("r").alias("right"), up("t").alias("top"))
    new = new.withColumns({"ncols": F.rint((F.col("right") - F.col("left")) / F.col("res")).cast("int"), "nrows": F.rint((F.col("top") - F.col("bottom")) / F.col("res")).cast("int")})
    old = dealt.select("plik", F.col("left").alias("l"), F.col("top").alias("t"), F.col("res").alias("r"))
    both = new.join(old, "plik")
    if tolerance is None:
        pixel = both.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("nrows") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), F.col("ncols") - 1)))
        centre = crs.moved_in_batches(F.col("left") + (F.col("col") + 0.5) * F.col("res"), F.col("top") - (F.col("row") + 0.5) * F.col("res"), target, source)
        placed = pixel.withColumn("from_", centre).withColumns({"sx": F.col("from_.a"), "sy": F.col("from_.b")})
    else:
        placed = warp.centres(warp.mesh(both, source, target, tolerance, ("l", "t", "r")), source, target, ("l", "t", "r"))
    back = placed.select("plik", "row", "col", F.floor((F.col("t") - F.col("sy")) / F.col("r")).cast("int").alias("srow"), F.floor((F.col("sx") - F.col("l")) / F.col("r")).cast("int").alias("scol"))
    cells = back.hint("merge").join(sheet_cell.select("plik", F.col("row").alias("srow"), F.col("col").alias("scol"), "z"), ["plik", "srow", "scol"]).select("plik", "row", "col", "z")
    return new, cells
