"""Operator 12, centroid clustering: Lloyd's rounds over integer vectors, with Hamerly's bounds.

Every vector keeps its centroid, an upper bound of its distance to that and a lower bound of its distance to any other.
After centroids move, the upper bound grows by its own centroid's drift and the lower one shrinks by the largest drift
of the others. A vector whose upper bound stays under the lower bound, or under half its centroid's distance to the next
centroid, cannot have changed; otherwise the upper bound is made exact, and if that does not settle it, the vector gets a
full scan of integer distances. Bounds are rounded outward and compared strictly, so ties always get the scan, where the
smaller number wins: results are those of plain rounds.

State is a written table per round, replaced by the next; sums of a round are added up in tasks, then by centroid and
dimension, exactly. The driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm.common import dropped, table, written

CENTROIDS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
#: Largest component in size; up to 64 of them a squared distance fits a long.
LARGEST = 1 << 27
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12

_STATE = "vec_id long, vec array<int>, cluster int, upper double, lower double"
_SCHEMA = pa.schema([("vec_id", pa.int64()), ("vec", pa.list_(pa.int32())), ("cluster", pa.int32()), ("upper", pa.float64()), ("lower", pa.float64())])


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to a centroid, or to one centroid each."""
    d = x - centroid
    return np.einsum("ij,ij->i", d, d)


@dataclass(frozen=True)
class Moved:
    """Centroids as they are, with what Hamerly's bounds need of them."""

    centroids: np.ndarray
    drift: np.ndarray

    @classmethod
    def to(cls, centroids: np.ndarray, before: np.ndarray | None = None) -> Moved:
        return cls(centroids, np.zeros(len(centroids)) if before is None else np.sqrt(squared(centroids, before).astype(float)) * _UP)

    @property
    def others(self) -> np.ndarray:
        """The largest drift of any other centroid, for each."""
        if len(self.drift) < 2:
            return np.zeros(len(self.drift))
        first, second = np.argsort(-self.drift, kind="stable")[:2]
        return np.where(np.arange(len(self.drift)) == first, self.drift[second], self.drift[first])

    @property
    def half_gap(self) -> np.ndarray:
        """Half the distance to the next centroid, for each."""
        gaps = np.stack([np.sqrt(squared(self.centroids, c).astype(float)) for c in self.centroids])
        np.fill_diagonal(gaps, np.inf)
        return gaps.min(1) / 2 * _DOWN


def scanned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest, upper, lower) by exact distances to all centroids."""
    every = np.stack([squared(x, c) for c in centroids])
    nearest = every.argmin(0)
    least = every[nearest, np.arange(len(x))]
    if len(centroids) == 1:
        return nearest, np.sqrt(least.astype(float)) * _UP, np.full(len(x), np.inf)
    every[nearest, np.arange(len(x))] = np.iinfo(np.int64).max
    return nearest, np.sqrt(least.astype(float)) * _UP, np.sqrt(every.min(0).astype(float)) * _DOWN


def bounded(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, moved: Moved) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, upper, lower, number of full scans) after the centroids moved."""
    upper = (upper + moved.drift[cluster]) * _UP
    lower = lower - moved.others[cluster]
    lower = np.where(lower > 0, lower * _DOWN, 0.0)
    enough = np.maximum(lower, moved.half_gap[cluster])
    open_ = np.flatnonzero(~(upper < enough))
    upper[open_] = np.sqrt(squared(x[open_], moved.centroids[cluster[open_]]).astype(float)) * _UP
    open_ = open_[~(upper[open_] < enough[open_])]
    cluster = cluster.copy()
    if len(open_):
        cluster[open_], upper[open_], lower[open_] = scanned(x[open_], moved.centroids)
    return cluster, upper, lower, len(open_)


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _assigned(batches: Iterator[pa.RecordBatch], moved: Moved, first: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column("vec"), moved.centroids.shape[1])
        if first:
            cluster, upper, lower = scanned(x, moved.centroids)
        else:
            cluster, upper, lower, _ = bounded(x, *(batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "upper", "lower")), moved)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vec"), pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower)], schema=_SCHEMA)


def _sums(batches: Iterator[pa.RecordBatch], k: int, dims: int) -> Iterator[pa.RecordBatch]:
    """One task's sums of components and counts, by centroid."""
    total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        x, cluster = _matrix(batch.column("vec"), dims), batch.column("cluster").to_numpy()
        for c in np.unique(cluster).tolist():
            some = x[cluster == c]
            total[c] += some.sum(0)
            n[c] += len(some)
    have = np.flatnonzero(n)
    cells = [np.repeat(have, dims), np.tile(np.arange(dims), len(have)), total[have].ravel(), np.repeat(n[have], dims)]
    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cells], names=["cluster", "dim", "total", "n"])


def _updated(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floors of the means; a centroid without vectors stays."""
    k, dims = centroids.shape
    sums = state.select("vec", "cluster").mapInArrow(lambda parts: _sums(parts, k, dims), "cluster long, dim long, total long, n long")
    whole = sums.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in whole.collect():  # one row per centroid and dimension
        out[r.cluster, r.dim] = int(r.total) // r.n
    return out


def kept_vectors(rows: DataFrame, vec_id: str, embedding: str, dims: int) -> DataFrame:
    """(vec_id, vec): vectors of ``dims`` components, none null or non-finite, as integers floor(64 * x)."""
    wide = F.transform(F.col(embedding), lambda x: x.cast("double"))
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = lambda x: F.when(F.abs(x) <= LARGEST // SCALE, F.floor(x * SCALE).cast("int")).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST // SCALE}: distances would not fit a long")).cast("int"))
    return rows.where(F.col(embedding).isNotNull() & (F.size(embedding) == dims)).where(good).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(wide, whole).alias("vec"))


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = DIMS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, vec, cluster, upper, lower) for every kept row, the centroids) after ``rounds`` rounds and a last assignment.

    Takes no part: vectors that are null, of another length, or hold null or non-finite components. Every other row is
    a vector of its own, repeated rows and null ids too; a null id cannot be a start, as its hash is null. Starts are the
    k vectors with the smallest sha256 of ``1:<vec_id>``, rows of one id by their components; fewer vectors, fewer
    centroids. Components beyond ``LARGEST`` / 64 raise. No vectors, no rows.
    """
    spark = rows.sparkSession
    base = written(kept_vectors(rows, vec_id, embedding, dims))
    drawn = base.where("vec_id is not null").withColumn("drawn", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    starts = np.array([r.vec for r in drawn.orderBy("drawn", "vec").limit(k).collect()], np.int64).reshape(-1, dims)
    if not len(starts):
        return spark.createDataFrame([], _STATE), starts
    state, moved = base, Moved.to(starts)
    for done in range(rounds + 1):
        told, first = spark.sparkContext.broadcast(moved), done == 0
        before, state = state, written(state.mapInArrow(lambda parts, t=told, f=first: _assigned(parts, t.value, f), _STATE))
        dropped(before)
        if done < rounds:
            moved = Moved.to(_updated(state, moved.centroids), moved.centroids)
    return state, moved.centroids


def measured(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of the rows of ``cluster``."""
    told = state.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf("long")
    def distance(vec: pa.Array, own: pa.Array) -> pa.Array:
        held = told.value
        return pa.array(squared(_matrix(vec, held.shape[1]), held[own.to_numpy(zero_copy_only=False)]) if len(vec) else np.zeros(0, np.int64))

    far = state.select("vec_id", "cluster", distance("vec", "cluster").alias("distance"))
    names = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    sums = far.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # one row per centroid
    known = sums.join(F.broadcast(state.sparkSession.createDataFrame(names, "cluster int, centroid_sha256 string")), "cluster")
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))  # one row
    return far.join(F.broadcast(known.join(F.broadcast(total))), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(*cluster(table(spark, sf_dir, "embeddings")))


def _rounds_sql(rounds: int) -> str:
    parts = []
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, v, c, d FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS n FROM (
      SELECT k.rid, k.vec_id, k.v, c.c, list_sum([(k.v[i] - c.v[i]) * (k.v[i] - c.v[i]) for i in range(1, {DIMS + 1})]) AS d FROM kept k, c{i} c)
  ) WHERE n = 1
)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY c, j),
c{i + 1} AS MATERIALIZED (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{i} GROUP BY c
  UNION ALL SELECT c, v FROM c{i} WHERE c NOT IN (SELECT c FROM s{i})
)""")
    return ", ".join(parts)


SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(64 * x::DOUBLE) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {DIMS} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), c0 AS MATERIALIZED (
  SELECT c - 1 AS c, v FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) AS c, v FROM kept WHERE vec_id IS NOT NULL) WHERE c <= {CENTROIDS}
), {_rounds_sql(ROUNDS)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (c)
"""
