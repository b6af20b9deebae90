"""Shared helpers: tables and checkpoints in the shared folder, connected components, column names, bounded Arrow slices."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as every contract of this package states them; Java, RE2 and Python read the class alike.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes that one numpy slice of an Arrow batch holds at most, unless a single document is longer.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_folder() -> str:
    """For tests on one machine without the setting; it goes with the process."""
    where = tempfile.mkdtemp(prefix="strataspark-")
    atexit.register(shutil.rmtree, where, ignore_errors=True)
    return where


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a session on one machine may leave it unset; on a cluster that raises."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return where or _own_folder()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stage_folder(spark: SparkSession) -> str:
    """The name of a new folder for written tables in the shared folder."""
    return f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder. Its size is known to the planner; see ``dropped``."""
    folder = stage_folder(df.sparkSession)
    df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out._written_at = folder
    return out


def removed(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for df in tables:
        removed(df.sparkSession, df._written_at)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) of consecutive rows that stay under SLICE_BYTES; null is empty."""
    start, size, held = 0, 0, []
    for i, value in enumerate(texts.cast(pa.binary())):
        text = value.as_py() or b""
        if held and size + len(text) > SLICE_BYTES:
            yield start, held
            start, size, held = i, 0, []
        held.append(text)
        size += len(text) + 1
    if held:
        yield start, held


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a long, b long)``; component is the smallest node reached.

    Alternates the large-star and small-star steps until every component is a star around its least node, which takes
    a number of rounds that grows with the logarithm of the longest path. Every step is a partial aggregate (minimum
    per node), written, and an equi-join of written tables, so a node with very many neighbours is combined before the
    shuffle and split by AQE in the join. Edges stay distributed. Nulls and self-loops are ignored.
    """
    edges = written(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars_only(edges):
        # Large star: each larger neighbour of a node is tied to the least node of the neighbourhood.
        both = edges.union(edges.select("b", "a"))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = written(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # Small star: a node and its smaller neighbours are tied to the least of them.
        low = written(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, edges = edges, written(small.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        dropped(before, least, large, low)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def _stars_only(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or both a smaller and a larger one."""
    inner = edges.select("a", F.lit(0).alias("above"), F.lit(1).alias("below")).union(edges.select("b", F.lit(1), F.lit(0)))
    sides = inner.groupBy("a").agg(F.max("above").alias("above"), F.sum("below").alias("below"))
    return not sides.where("below + above > 1 and below > 0").limit(1).count()
