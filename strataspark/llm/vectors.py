"""What the two vector searches share: distinct vectors with their smallest ids, query chunks, ranked answers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataspark.llm.common import checkpointed

#: Bytes of queries broadcast at once, whatever their width. More queries are searched chunk by chunk.
CHUNK_BYTES = 24_000_000
#: Candidates scored at once in a task, times the queries of a sub-chunk.
TILE, QUERY_TILE = 2048, 1024


def distinct_vectors(rows: DataFrame, vector: Column, vec_id: str, is_query: Column, most: int) -> DataFrame:
    """(vkey, vec, ids, is_query): one row per distinct vector with its ``most`` smallest ids, ascending.

    No more ids of one vector can be in an answer of ``most`` rows. The limit per vector is applied in each task
    before the shuffle, so a vector that very many rows share does not weigh on one task.
    """
    named = rows.select(F.col(vec_id).cast("long").alias("id"), vector.alias("vec"), is_query.alias("is_query"))
    named = named.where("id is not null and vec is not null").dropDuplicates(["id", "vec"])
    first = named.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("n") <= most)
    asked = named.where("is_query").select("vec").distinct().withColumn("asked", F.lit(True))
    grouped = first.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return grouped.join(asked, "vec", "left").select(F.xxhash64("vec").alias("vkey"), "vec", "ids", F.coalesce("asked", F.lit(False)).alias("is_query"))


def query_chunks(queries: DataFrame, dims: int):
    """Pandas frames of about ``CHUNK_BYTES`` of queries (8 bytes a component), dealt by hash."""
    size = max(1, CHUNK_BYTES // (8 * max(1, dims)))
    chunks = -(-queries.count() // size)
    for i in range(chunks):
        yield queries.where(F.pmod(F.xxhash64("vkey", F.lit(5)), F.lit(chunks)) == i).orderBy("vkey").toPandas()


def trimmed(query: np.ndarray, score: np.ndarray, first_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` entries of each query: score descending, then first_id ascending."""
    order = np.lexsort((first_id, -score, query))
    q = query[order]
    start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k]


def searched(base: DataFrame, search: Callable, schema: str) -> DataFrame:
    """Run ``search`` over the index's partitions and keep what it found."""
    return checkpointed(base.mapInPandas(search, schema))


def hits_frame(qkey: np.ndarray, ids: list, score: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"qkey": qkey, "ids": ids, "score": score})


def answers(hits: DataFrame, queries: DataFrame, k: int, repeated: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score) from ``hits``(qkey, ids, score), found for distinct query vectors.

    ``queries``: (query_id, qkey) of every query row. ``repeated``: one pair may be among the hits several times, with
    one score. The best k+1 rows of a vector hold the best k of any of its queries, which leaves out its own id.
    """
    candidate = hits.select("qkey", F.explode("ids").alias("vec_id"), "score")
    if repeated:
        candidate = candidate.groupBy("qkey", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("qkey").orderBy(F.col("score").desc(), "vec_id")
    top = candidate.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    own = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = queries.join(top, "qkey").where("vec_id <> query_id").withColumn("rank", F.row_number().over(own))
    return found.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
