"""Operator 1, approximate nearest neighbours by inner product: a forest of random-projection trees.

Trees are grown on a bounded sample; every row is indexed by the leaf it falls into in each tree. A query goes down all
trees at once through one shared priority queue, ordered by the smallest margin on the way, and collects leaves until
they hold a share of all vectors that gave ``TARGET_RECALL`` on the sample. Rows and queries meet by an equi-join on
the leaf, so only the vectors of visited leaves are scored; a leaf with many rows or visitors is dealt into blocks.
Candidates are reranked exactly.

Inner products become nearness by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm (0 for queries).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm import vectors
from strataspark.llm.common import checkpointed, dropped, table, written

#: Rows that trees are grown on, at most; trees; leaves of a tree, about; recall wanted on the sample (at 20 nearest).
SAMPLE_ROWS, TREES, TREE_LEAVES, TARGET_RECALL = 20_000, 4, 64, 0.96
CALIBRATION_QUERIES = 200
#: Vectors and queries of a block of a leaf, about; queries scored at once.
BLOCK_ROWS, BLOCK_QUERIES, QUERY_TILE = 10_000, 10_000, 512


class Forest:
    """Trees as flat arrays; leaves are numbered over all trees."""

    def __init__(self, sample: np.ndarray, norm: float, trees: int = TREES, leaf_rows: int | None = None, seed: int = 11):
        leaf_rows = leaf_rows or max(20, len(sample) // TREE_LEAVES)
        self.norm, self.trees, self.leaves = norm, [], 0
        full = self.extended(sample)
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            nodes: list = []
            self._grow(full, np.arange(len(full)), rng, nodes, leaf_rows)
            self.trees.append(nodes)
        self.leaf_share = self._shares(full)

    def extended(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.norm**2 - (x.astype(np.float64) ** 2).sum(1)))
        return np.hstack([x, rest[:, None].astype(x.dtype)])

    def _grow(self, x, rows, rng, nodes, leaf_rows) -> int:
        me = len(nodes)
        if len(rows) > leaf_rows:
            for _ in range(3):
                a, b = x[rng.choice(rows, 2, replace=False)]
                w = a - b
                size = np.linalg.norm(w)
                if size > 1e-9:
                    w = w / size
                    p = x[rows] @ w
                    cut = np.median(p)
                    low = p <= cut
                    if 0 < low.sum() < len(rows):
                        nodes.append(None)
                        left = self._grow(x, rows[low], rng, nodes, leaf_rows)
                        right = self._grow(x, rows[~low], rng, nodes, leaf_rows)
                        nodes[me] = (w, cut, left, right)
                        return me
        nodes.append(self.leaves)
        self.leaves += 1
        return me

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf numbers, one column per tree, of extended vectors."""
        out = np.empty((len(x), len(self.trees)), np.int32)
        for t, nodes in enumerate(self.trees):
            todo = [(0, np.arange(len(x)))]
            while todo:
                at, rows = todo.pop()
                if isinstance(nodes[at], int):
                    out[rows, t] = nodes[at]
                elif len(rows):
                    w, cut, left, right = nodes[at]
                    low = x[rows] @ w <= cut
                    todo += [(left, rows[low]), (right, rows[~low])]
        return out

    def _shares(self, x) -> np.ndarray:
        leaf = self.leaf_of(x)
        return np.bincount(leaf.ravel(), minlength=self.leaves) / max(1, len(x))

    def order(self, q: np.ndarray) -> Iterator[int]:
        """Leaves for one extended query, nearest first: one priority queue over all trees."""
        queue = [(-np.inf, t, 0) for t in range(len(self.trees))]
        while queue:
            margin, t, at = heapq.heappop(queue)
            node = self.trees[t][at]
            if isinstance(node, int):
                yield node
                continue
            w, cut, left, right = node
            m = float(q @ w) - cut
            heapq.heappush(queue, (max(margin, m), t, left))
            heapq.heappush(queue, (max(margin, -m), t, right))

    def visited(self, queries: np.ndarray, share: float) -> np.ndarray:
        """Per query, which leaves are searched: until they hold ``share`` of the sample, with repeats over trees."""
        zero = np.zeros((len(queries), 1), queries.dtype)
        out = np.zeros((len(queries), self.leaves), bool)
        for i, q in enumerate(np.hstack([queries, zero])):
            held = 0.0
            for leaf in self.order(q):
                out[i, leaf] = True
                held += self.leaf_share[leaf]
                if held >= share:
                    break
        return out

    def calibrated(self, sample: np.ndarray, k: int, target: float) -> float:
        """The least share, on a grid, at which sample queries find ``target`` of their true k nearest in the sample."""
        rng = np.random.default_rng(3)
        asked = sample[rng.choice(len(sample), min(len(sample), CALIBRATION_QUERIES), replace=False)]
        score = asked.astype(np.float64) @ sample.T.astype(np.float64)
        k = min(k + 1, len(sample))
        true = np.argpartition(-score, k - 1, axis=1)[:, :k]
        leaf = self.leaf_of(self.extended(sample))
        for share in (0.1, 0.2, 0.4, 0.7, 1.0, 1.4, 1.8, 2.4, 3.0, 4.0):
            seen = self.visited(asked, share)
            hit = np.zeros(true.shape, bool)
            for t in range(len(self.trees)):
                hit |= np.take_along_axis(seen, leaf[:, t][true], axis=1)
            if hit.mean() >= target:
                return share
        return float(len(self.trees))


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, summed in the order of the components."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * x[:, d]
    return total


def nearest(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", is_query=None, k: int = 20, target_recall: float = TARGET_RECALL, trees: int = TREES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by inner product, ties to the smaller id.

    Takes no part: null ids; vectors that are null, empty, zero, hold null or non-finite components, or whose length
    is not the most frequent one (the greater of equals). Repeated rows count once; equal vectors under several ids
    are indexed once and expanded in the answers. Fewer candidates than k give fewer rows, no queries none.
    """
    wide = F.transform(F.col(embedding), lambda x: x.cast("double"))
    good = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(wide, lambda x: x != 0)
    usable = rows.where(good).select(vec_id, embedding)
    sizes = usable.groupBy(F.size(embedding).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    asked = is_query if is_query is not None else F.col(vec_id) % 20 == 0
    usable = usable.where(F.size(embedding) == (sizes.d if sizes else 0))
    base = checkpointed(vectors.distinct_vectors(usable, F.transform(F.col(embedding), lambda x: x.cast("double")), vec_id, asked, k + 1))
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes or base.isEmpty():
        return rows.sparkSession.createDataFrame([], schema)
    spark, dims = rows.sparkSession, int(sizes.d)
    norm = float(base.select(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).head()[0]) ** 0.5
    drawn = base.select("vec").orderBy(F.xxhash64("vkey", F.lit(7)), "vec").limit(SAMPLE_ROWS).toPandas()
    sample = np.array(drawn.vec.to_list(), np.float64).reshape(-1, dims)
    forest = Forest(sample, norm, trees)
    share = forest.calibrated(sample, k, target_recall)
    told = spark.sparkContext.broadcast(forest)

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = told.value.leaf_of(told.value.extended(_matrix(batch.column(1), dims)))
            yield batch.append_column("leaves", pa.array(leaf.tolist(), pa.list_(pa.int32())))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = told.value.visited(_matrix(batch.column(1), dims), share)
            yield batch.append_column("leaves", pa.array([np.flatnonzero(s).tolist() for s in seen], pa.list_(pa.int32())))

    schema_in = "vkey long, vec array<double>"
    index = written(base.select("vkey", "vec", "ids").mapInArrow(located, f"{schema_in}, ids array<long>, leaves array<int>"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    visits = written(base.where("is_query").select("vkey", "vec").repartition(tasks, "vkey").mapInArrow(routed, f"{schema_in}, leaves array<int>"))

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        """(leaf, number of blocks): one row per leaf of the forest, whose size is bounded."""
        return df.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    dealt = F.broadcast(blocks(index, BLOCK_ROWS, "parts").join(blocks(visits, BLOCK_QUERIES, "qparts"), "leaf"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n, seed: F.pmod(F.xxhash64("vkey", F.lit(seed)), F.col(n)).cast("int")
    stored = index.select("vkey", "vec", "ids", F.explode("leaves").alias("leaf")).join(dealt, "leaf").select("leaf", own("parts", 3).alias("part"), every("qparts").alias("qpart"), "vec", "ids")
    asking = visits.select("vkey", "vec", F.explode("leaves").alias("leaf")).join(dealt, "leaf").select("leaf", every("parts").alias("part"), own("qparts", 5).alias("qpart"), "vkey", "vec")
    block = ["leaf", "part", "qpart"]
    found = stored.groupBy(*block).cogroup(asking.groupBy(*block)).applyInArrow(lambda x, q: _scored(x, q, dims, k + 1), "qkey long, ids array<long>, score double")
    hits = written(found)
    dropped(index, visits)
    queries = usable.where(asked).select(F.col(vec_id).cast("long").alias("query_id"), F.xxhash64(wide).alias("qkey")).where("query_id is not null").distinct()
    return vectors.answers(hits, queries, k, repeated=True)


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


_HITS = pa.schema([("qkey", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])


def _scored(stored: pa.Table, asking: pa.Table, dims: int, k: int) -> pa.Table:
    """The best ``k`` vectors of a block of a leaf for each query that visits it."""
    if not stored.num_rows or not asking.num_rows:
        return _HITS.empty_table()
    x, q_all = _matrix(stored.column("vec"), dims), _matrix(asking.column("vec"), dims)
    ids, keys = stored.column("ids").combine_chunks(), asking.column("vkey").to_numpy()
    first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets.to_numpy()[0]]
    out = []
    for lo in range(0, len(keys), QUERY_TILE):
        q = q_all[lo : lo + QUERY_TILE]
        score = q @ x.T
        if len(x) > k:
            floor = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
            i, j = np.nonzero(score >= floor - 1e-9 * (1 + np.abs(floor)))
        else:
            i, j = (a.ravel() for a in np.indices(score.shape))
        exact = _exact(q[i], x[j])
        keep = vectors.trimmed(i, exact, first[j], k)
        out.append((keys[i[keep] + lo], j[keep], exact[keep]))
    key, at, exact = (np.concatenate([o[c] for o in out]) for c in range(3))
    return pa.Table.from_arrays([pa.array(key), ids.take(pa.array(at)), pa.array(exact)], schema=_HITS)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
