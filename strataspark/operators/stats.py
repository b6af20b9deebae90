"""Layer reports (A5, A8-A11, A17, A19, W2, W6, J16, L10) and time axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataspark.functions.numeric import round_half_even

THRESHOLDS = (0.005, 0.5, 2.0)


def layer_stats(cells: DataFrame, layer: str = "rok", value: str = "z") -> DataFrame:
    """Least, mean, greatest and number of values."""
    v = F.col(value)
    return cells.groupBy(layer).agg(F.min(v).alias("z_min"), F.avg(v.cast("double")).alias("z_mean"), F.max(v).alias("z_max"), F.count(v).alias("n"))


def change_shares(cells: DataFrame, layer: str = "indeks", pixel: tuple[str, ...] = ("row", "col"), value: str = "z", thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """Per layer, the share of pixels it has in common with the layer stored just before that changed by
    more than each threshold. One shuffle by pixel: a window tells each value the one before it; a gap in the layers is
    no neighbour."""
    order = Window.partitionBy(*pixel).orderBy(layer)
    now = F.col(value).cast("double")
    pairs = cells.where(F.col(value).isNotNull()).select(layer, now.alias("now_"), F.lag(now).over(order).alias("before_"), F.lag(layer).over(order).alias("last_")).where(F.col("last_") == F.col(layer) - 1)
    d = F.abs(F.col("now_") - F.col("before_"))
    shares = [(F.sum(F.when(d > t, 1).otherwise(0)).cast("double") / F.count("*")).alias(f"share_{k}") for k, t in enumerate(thresholds)]
    return pairs.groupBy(layer).agg(F.count("*").alias("n_common"), *shares)


def resolution_shares(cells: DataFrame, res: str = "res_src") -> DataFrame:
    """A5: share of pixels by source resolution (4 places each)."""
    counts = cells.where(F.col(res).isNotNull()).groupBy(round_half_even(F.col(res), 4).alias("res")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.join(F.broadcast(total)).select("res", round_half_even(F.col("n") / F.col("total"), 4).alias("share"))


#: Pixels of one bitmap, as Spark's bitmap aggregates have them: 128 rows of 256.
BITMAP_ROWS, BITMAP_COLS = 7, 8


def bitmaps(cells: DataFrame, keys: tuple[str, ...], pixel: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """(keys, map_row_, map_col_, bits_): which pixels are there, 4 KB for 32,768 of them. Each task combines its pixels, so
    bitmaps are shuffled and no pixels."""
    row, col = (F.col(p).cast("long") for p in pixel)
    at = F.shiftleft(row.bitwiseAND((1 << BITMAP_ROWS) - 1), BITMAP_COLS).bitwiseOR(col.bitwiseAND((1 << BITMAP_COLS) - 1))
    placed = cells.select(*keys, F.shiftright(row, BITMAP_ROWS).alias("map_row_"), F.shiftright(col, BITMAP_COLS).alias("map_col_"), at.alias("at_"))
    return placed.groupBy(*keys, "map_row_", "map_col_").agg(F.bitmap_construct_agg("at_").alias("bits_"))


def coverage(cells: DataFrame, layer: str = "rok", pixel: tuple[str, ...] = ("row", "col"), value: str = "z") -> DataFrame:
    """Pixels of each layer over pixels with data in any of them, from one bitmap per layer and block."""
    maps = bitmaps(cells.where(F.col(value).isNotNull()), (layer,), pixel)
    each = maps.groupBy(layer).agg(F.sum(F.bitmap_count("bits_")).alias("n"))
    united = maps.groupBy("map_row_", "map_col_").agg(F.bitmap_or_agg("bits_").alias("any_"))
    total = united.agg(F.sum(F.bitmap_count("any_")).alias("total"))  # one row
    return each.join(F.broadcast(total)).select(layer, F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(0.0).alias("coverage"))


def covering_prefix(ranked: DataFrame, wanted: DataFrame, rank: str = "rank", pixel: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """(n_sheets, complete): the shortest prefix of sheets, newest first, that covers all wanted pixels.

    A pixel is covered by the least rank that has it; the answer is the greatest of these, or all sheets.
    """
    first = ranked.groupBy(*pixel).agg(F.min(rank).alias("first_"))
    per = wanted.select(*pixel).distinct().join(first, list(pixel), "left").agg(F.max("first_").alias("last_"), F.bool_and(F.col("first_").isNotNull()).alias("complete"))
    every = ranked.agg(F.max(rank).alias("all_"))
    return per.join(F.broadcast(every)).select(F.when(F.col("complete"), F.col("last_")).otherwise(F.col("all_")).cast("long").alias("n_sheets"), "complete")


def block_count(cells: DataFrame) -> DataFrame:
    """A19."""
    return cells.agg(F.count_distinct("by", "bx").alias("blocks"))


def time_axis(year: Column, position: str = "middle", unit: str = "seconds") -> tuple[Column, Column, Column]:
    """(time, start, end) of a year: 1 July or 1 January; bounds end at 31 Dec 23:59:59, or in days at the next 1 Jan."""
    first = F.unix_date(F.make_date(year, F.lit(1), F.lit(1))).cast("long")
    at = F.unix_date(F.make_date(year, F.lit(7 if position == "middle" else 1), F.lit(1))).cast("long")
    after = F.unix_date(F.make_date(year + 1, F.lit(1), F.lit(1))).cast("long")
    if unit == "days":
        return at, first, after
    return at * 86400, first * 86400, after * 86400 - 1
