import hashlib
import math

import numpy as np
import pytest

from strataspark.llm import clusters


def plain(rows, k, rounds, dims):
    """Rounds by definition, in Python integers. (row number, cluster, distance), centroids."""
    kept = [(n, i, [math.floor(64 * x) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for _, i, v in kept if i is not None)[:k]
    centroids = [list(v) for _, v in starts]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda: [min((far(v, c), j) for j, c in enumerate(centroids)) for _, _, v in kept]
    for _ in range(rounds):
        own = nearest()
        for j in range(len(centroids)):
            some = [v for (_, _, v), (_, c) in zip(kept, own, strict=True) if c == j]
            if some:
                centroids[j] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    return [(i, c, d) for (_, i, _), (d, c) in zip(kept, nearest(), strict=True)], centroids


@pytest.mark.parametrize(("k", "rounds", "dims", "spread"), [(16, 3, 64, 1.0), (5, 6, 3, 0.02), (1, 2, 3, 1.0), (50, 3, 4, 0.3)])
def test_same_as_plain_rounds(spark, k, rounds, dims, spread):
    rng = np.random.default_rng(k)
    centre = rng.normal(size=(4, dims))
    rows = [(i, [float(np.float32(x)) for x in centre[i % 4] + spread * rng.normal(size=dims)]) for i in range(300)]
    rows += rows[:40] + [(7, rows[3][1])] + [(400 + i, rows[1][1]) for i in range(60)]  # repeated rows, one vector under many ids
    rows += [(900, None), (901, []), (902, [1.0] * (dims + 1)), (903, [math.nan] * dims), (904, [math.inf] + [0.0] * (dims - 1)), (905, [None] + [0.0] * (dims - 1)), (None, [0.5] * dims), (906, [0.0] * dims)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, Cluster string").repartition(5)
    state, centroids = clusters.cluster(df, k=k, rounds=rounds, dims=dims)
    want, told = plain(rows, k, rounds, dims)
    got = clusters.measured(state, centroids).collect()
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert centroids.tolist() == told
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == sorted(want, key=key)
    inertia = {c: sum(d for _, o, d in want if o == c) for c in range(k)}
    assert all(r.cluster_inertia == inertia[r.cluster] and r.inertia == sum(inertia.values()) for r in got)
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, told[r.cluster])).encode()).hexdigest() for r in got)


def test_bounds_save_scans_and_never_err():
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(3000, 8)) * 20 + rng.integers(0, 6, (3000, 1)) * 400).astype(np.int64)
    centroids = x[:6].copy()
    nearest, upper, lower = clusters.scanned(x, centroids)
    scans = []
    for _ in range(5):
        moved = np.stack([x[nearest == c].sum(0) // (nearest == c).sum() if (nearest == c).any() else centroids[c] for c in range(6)])
        nearest, upper, lower, n = clusters.bounded(x, nearest, upper, lower, clusters.Moved.to(moved, centroids))
        centroids = moved
        every = np.stack([clusters.squared(x, c) for c in centroids])
        assert (nearest == every.argmin(0)).all() and (upper**2 >= every.min(0)).all()
        every[nearest, np.arange(len(x))] = np.iinfo(np.int64).max
        assert (lower**2 <= every.min(0)).all()
        scans.append(n)
    assert scans[-1] < 600


def test_edges(spark):
    schema = "vec_id long, embedding array<double>"
    state, centroids = clusters.cluster(spark.createDataFrame([], schema))
    assert clusters.measured(state, centroids).collect() == [] and clusters.measured(state, centroids).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    edge = float(clusters.LARGEST // 64)
    state, centroids = clusters.cluster(spark.createDataFrame([(1, [edge] * 64), (2, [-edge] * 64)], schema), k=1)
    assert {r.distance for r in clusters.measured(state, centroids).collect()} == {64 * clusters.LARGEST**2}
    with pytest.raises(Exception, match="would not fit a long"):
        clusters.cluster(spark.createDataFrame([(1, [1e30] * 64)], schema))
