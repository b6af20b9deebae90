"""Queries of the engine by name, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataspark.plans import mosaic_queries, terrain_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**mosaic_queries.QUERIES, **terrain_queries.QUERIES}
ORACLE_SQL: dict[str, str] = {**mosaic_queries.ORACLE_SQL, **terrain_queries.ORACLE_SQL}
