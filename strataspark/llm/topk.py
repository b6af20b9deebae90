"""Operator 5, exact top-k by integer inner product: a three-phase uniform threshold.

The dimensions are cut into ``LISTS`` lists, so that a candidate's score is the sum of its partial scores. Phase 1: each
task gathers, per query and list, the entries with the best partial scores, resolves them and reports the best k
scores; the k-th best of all of them is a safe lower bound of the answer. Phase 2: bound / LISTS is broadcast as the
uniform cutoff; a candidate that reaches the bound has at least one partial score at the cutoff or above, so entries
above it are sufficient. Phase 3: the remaining partial scores of exactly these candidates are resolved, and scores
below the bound fall away.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataspark.llm import vectors
from strataspark.llm.common import checkpointed, table

LISTS, SCALE = 4, 64


def _parts(dims: int, lists: int) -> list[slice]:
    edge = np.linspace(0, dims, min(lists, dims) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def _kind(largest: int, dims: int):
    """The narrowest type in which every sum of products is exact."""
    bound = dims * largest * largest
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


def top_scores(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", is_query=None, k: int = 20, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score long): the k highest integer scores of each query, ties to the smaller id.

    Components become floor(64 * x). Takes no part: null ids; vectors that are null, empty, hold null or non-finite
    components, or whose length is not the most frequent one (the greater of equals). A zero vector takes part.
    Repeated rows count once. Scores beyond 64 bits are not supported.
    """
    wide = F.transform(F.col(embedding), lambda x: x.cast("double"))
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & (F.size(embedding) > 0)
    usable = rows.where(good).select(vec_id, embedding)
    sizes = usable.groupBy(F.size(embedding).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    asked = is_query if is_query is not None else F.col(vec_id) % 20 == 0
    usable = usable.where(F.size(embedding) == (sizes.d if sizes else 0))
    whole = F.transform(wide, lambda x: F.floor(x * SCALE))
    base = checkpointed(vectors.distinct_vectors(usable, whole, vec_id, asked, k + 1))
    spark, schema = rows.sparkSession, "query_id long, rank int, vec_id long, score long"
    if not sizes or base.isEmpty():
        return spark.createDataFrame([], schema)
    largest = int(base.select(F.max(F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x))))).head()[0])
    kind, parts = _kind(largest, int(sizes.d)), _parts(int(sizes.d), lists)
    hits = None
    for chunk in vectors.query_chunks(base.where("is_query").select("vkey", "vec"), int(sizes.d)):
        if len(chunk):
            found = _chunk(spark, base, chunk, kind, parts, k + 1)
            hits = found if hits is None else hits.union(found)
    if hits is None:
        return spark.createDataFrame([], schema)
    queries = usable.where(asked).select(F.col(vec_id).cast("long").alias("query_id"), F.xxhash64(whole).alias("qkey")).where("query_id is not null").distinct()
    return vectors.answers(hits, queries, k)


def _tiles(parts: Iterator[pd.DataFrame], kind):
    for part in parts:
        for at in range(0, len(part), vectors.TILE):
            tile = part.iloc[at : at + vectors.TILE]
            yield tile, np.array(tile.vec.to_list(), np.int64).astype(kind)


def _chunk(spark: SparkSession, base: DataFrame, chunk: pd.DataFrame, kind, parts: list[slice], k: int) -> DataFrame:
    asked = spark.sparkContext.broadcast((chunk.vkey.to_numpy(), np.array(chunk.vec.to_list(), np.int64).astype(kind)))

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Phase 1: the best k scores per query among the entries that lead a local list."""
        keys, q_all = asked.value
        best = np.zeros((len(keys), 0), np.int64)
        for _, x in _tiles(frames, kind):
            rows = []
            for lo in range(0, len(keys), vectors.QUERY_TILE):
                q = q_all[lo : lo + vectors.QUERY_TILE]
                partial = [q[:, p] @ x[:, p].T for p in parts]
                total = sum(partial[1:], partial[0])
                if len(x) > k:
                    lead = np.zeros(total.shape, bool)
                    for p in partial:
                        np.put_along_axis(lead, np.argpartition(-p, k - 1, axis=1)[:, :k], True, axis=1)
                    total = np.where(lead, total, np.iinfo(np.int64).min // 2)
                    total = -np.partition(-total, k - 1, axis=1)[:, :k]
                rows.append(total.astype(np.int64))
            best = np.hstack([best, np.vstack(rows)])
            if best.shape[1] > k:
                best = -np.partition(-best, k - 1, axis=1)[:, :k]
        if best.shape[1]:
            yield pd.DataFrame({"qkey": np.repeat(keys, best.shape[1]), "score": best.ravel()})

    lead = base.select("vec").mapInPandas(gather, "qkey long, score long")
    order = Window.partitionBy("qkey").orderBy(F.col("score").desc())
    bound = lead.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).groupBy("qkey").agg(F.min("score").alias("bound"), F.count("*").alias("n"))
    # A query with fewer than k candidates in all has no bound.
    safe = bound.select("qkey", F.when(F.col("n") == k, F.col("bound")).otherwise(F.lit(np.iinfo(np.int64).min // 2)).alias("bound")).toPandas()
    floors = safe.set_index("qkey").bound.reindex(chunk.vkey).to_numpy().astype(np.int64)
    cutoffs = spark.sparkContext.broadcast(floors)

    def collect(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Phases 2 and 3: entries at the cutoff or above in some list, resolved, at the bound or above."""
        keys, q_all = asked.value
        for tile, x in _tiles(frames, kind):
            ids = tile.ids.to_list()
            first = np.array([i[0] for i in ids])
            for lo in range(0, len(keys), vectors.QUERY_TILE):
                q, floor = q_all[lo : lo + vectors.QUERY_TILE], cutoffs.value[lo : lo + vectors.QUERY_TILE]
                cut = (-(-floor // len(parts)))[:, None]
                partial = [q[:, p] @ x[:, p].T for p in parts]
                enough = partial[0] >= cut
                for p in partial[1:]:
                    enough |= p >= cut
                i, j = np.nonzero(enough)
                total = sum((p[i, j].astype(np.int64) for p in partial), np.zeros(len(i), np.int64))
                high = total >= floor[i]
                i, j, total = i[high], j[high], total[high]
                keep = vectors.trimmed(i, total, first[j], k)
                if len(keep):
                    yield vectors.hits_frame(keys[i[keep] + lo], [ids[c] for c in j[keep]], total[keep])

    return vectors.searched(base.select("vec", "ids"), collect, "qkey long, ids array<long>, score long")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(table(spark, sf_dir, "embeddings"))


SQL = """
WITH usable AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
