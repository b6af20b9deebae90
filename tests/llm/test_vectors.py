import math

import numpy as np
import pytest

from strataspark.llm import ann, topk


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)], "x") for i in range(600)]
    rows = [(i, rows[1][1] if i % 3 == 0 else v, t) for i, v, t in rows]
    rows += [(700, None, "x"), (720, [], "x"), (740, [0.0] * 8, "x"), (760, [math.nan] + [1.0] * 7, "x"), (780, [None] + [1.0] * 7, "x"), (800, [math.inf] + [0.0] * 7, "x"), (820, [1.0] * 3, "x"), (None, [1.0] * 8, "x")]
    rows += [rows[40], rows[41]]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, Score string").repartition(5)


def usable(rows, zero):
    seen = {(i, tuple(v)) for i, v, _ in rows if i is not None and v is not None and len(v) == 8 and None not in v and all(map(math.isfinite, v)) and (zero or any(v))}
    return sorted(seen)


def brute(rows, score, k=20):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            best = sorted(((-score(v, w), c) for c, w in rows if c != q))[:k]
            out |= {(q, n + 1): (c, -s) for n, (s, c) in enumerate(best)}
    return out


def test_top_scores_are_exact(vectors):
    rows, df = vectors
    want = brute(usable(rows, True), lambda a, b: sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b, strict=True)))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_scores(df).collect()}
    assert got == want


@pytest.mark.parametrize("scale", [1e5, 1e8])
def test_wide_components(spark, scale):
    rows = [(i, [i * scale, -scale, 0.015625], "") for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, t string")
    want = brute([(i, v) for i, v, _ in rows], lambda a, b: sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b, strict=True)))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_scores(df).collect()}
    assert all(got[key] == want[key] for key in want if abs(want[key][1]) < 2**62)


def test_nearest_finds_nine_in_ten(vectors):
    rows, df = vectors
    good = usable(rows, False)
    by_id = dict(good)
    want = brute(good, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    got = ann.nearest(df).collect()
    assert len(got) == len(want)
    found = {(r.query_id, r.vec_id) for r in got}
    assert np.mean([(q, c) in found for (q, _), (c, _) in want.items()]) >= 0.9
    for r in got:
        assert r.score == pytest.approx(sum(x * y for x, y in zip(by_id[r.query_id], by_id[r.vec_id], strict=True)), abs=1e-12)
    for q in {r.query_id for r in got}:
        mine = sorted((r["rank"], -r.score, r.vec_id) for r in got if r.query_id == q)
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine) and [m[0] for m in mine] == list(range(1, 21))


def test_few_and_none(vectors, spark):
    _, df = vectors
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id, r.score) for r in ann.nearest(few).collect()] == [(0, 1, 2.0)]
    assert [(r.query_id, r.vec_id, r.score) for r in topk.top_scores(few).collect()] == [(0, 1, 64 * 128)]
    for empty in (df.limit(0), few.where("vec_id = 1")):
        assert ann.nearest(empty).count() == topk.top_scores(empty).count() == 0
