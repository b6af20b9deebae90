"""Mosaic queries over the driver's tables: lineitem stands in for sheet pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.operators import mosaic


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as sheet pixels: (rok, col, row, z, res_src, akt_data, plik, line_no, price)."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.year("l_shipdate").alias("rok"), (F.col("l_partkey") % 64).cast("int").alias("col"), (F.col("l_suppkey") % 64).cast("int").alias("row"),
        F.col("l_quantity").alias("z"), F.col("l_tax").alias("res_src"), F.col("l_shipdate").alias("akt_data"), F.col("l_orderkey").alias("plik"),
        F.col("l_linenumber").alias("line_no"), F.col("l_extendedprice").alias("price"),
    )


PIXELS_SQL = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS rok, CAST(l_partkey % 64 AS INTEGER) AS col, CAST(l_suppkey % 64 AS INTEGER) AS row, l_quantity AS z,
       l_tax AS res_src, l_shipdate AS akt_data, l_orderkey AS plik, l_linenumber AS line_no, l_extendedprice AS price
FROM lineitem
"""


def mosaic_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in ("akt_data", "plik", "line_no", "price", "res_src")]
    return mosaic.first_wins(pixels(spark, sf_dir), ["rok", "col", "row"], order, "z", ("res_src",))


QUERIES = {"mosaic_first_wins": mosaic_first_wins}
ORACLE_SQL = {
    "mosaic_first_wins": f"""
WITH pixels AS ({PIXELS_SQL}), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rok, col, row ORDER BY akt_data DESC, plik DESC, line_no DESC, price DESC, res_src DESC) AS n FROM pixels
)
SELECT rok, col, row, z, res_src FROM ranked WHERE n = 1
""",
}
