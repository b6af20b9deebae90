import random

import pytest
from pyspark.sql import functions as F

from strataspark.llm import mixing


def brute_targets(sizes, weights, cap=3.0):
    target, free, left = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s}, sum(sizes)
    while free:
        trial = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if trial[i] > cap * sizes[i]}
        if not over:
            for i in free:
                target[i] = trial[i]
            return target
        for i in over:
            target[i] = cap * sizes[i]
            left -= target[i]
        free -= over
    return target


def test_water_filling():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.choice([0, 5, 100, 10_000]) for _ in range(rng.randint(1, 9))]
        weights = [i % 3 + 1.0 for i in range(len(sizes))]
        got = mixing.water_filled(sizes, weights)
        assert got == pytest.approx(brute_targets(sizes, weights))
        assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * s * (1 + 1e-12) for t, s in zip(got, sizes, strict=True))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["b", "a", None, "é", "c"]) if i % 3 else "a") for i in range(900)]
    rows += [(900, None, "a"), (901, "\x0b x\x1cy \t", "z"), (None, "p q", "b"), (5, "r", "b"), (5, "r", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)


def test_mix_is_near_its_targets_and_repeats(docs):
    got = mixing.mix(docs).collect()
    assert len(got) == 905 and sum(r.doc_id is None for r in got) == 1
    per = {}
    for r in got:
        per.setdefault(r.mix_source, []).append(r)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    names = sorted((s for s in per if s is not None), key=str.encode) + [None]
    assert per["z"][0].size == 1  # 0x1C is no separator
    sizes = [sum(r.size for r in per[s]) for s in names]
    want = brute_targets(sizes, [i % 3 + 1.0 for i in range(len(names))])
    for s, size, target in zip(names, sizes, want, strict=True):
        assert per[s][0].source_size == size and per[s][0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in per[s]) - target) <= 31
    again = mixing.mix(docs.repartition(3, "text")).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_reduction_tree_keeps_words_and_expectation(spark):
    rows = spark.range(4000).selectExpr("id as key", "id % 2 as turn", "0 as source_no", "1 + id % 50 as size", "0.3D as p")
    words = rows.selectExpr("sum(size * p)").head()[0]
    taken = [mixing.rounded_copies(rows, seed, bucket_rows=100, fan_in=4).selectExpr("count(*)", "sum(size * p)", "sum(if(key < 400, p, 0))").head() for seed in (1, 2, 3)]
    for n, got, some in taken:
        assert n == 4000 and abs(got - words) <= 25 and 60 <= some <= 180


def test_empty(docs):
    assert mixing.mix(docs.limit(0)).count() == 0


def test_null_ids_and_repeated_rows_spread_over_buckets(spark, monkeypatch):
    rows = [(None, f"n{i} " * (1 + i % 7), "a") for i in range(3_000)] + [(7, "same words here", "a")] * 2_500 + [(i, "x " * (i % 40), "b") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"copies": F.lit("c"), "Tag": F.lit(1)})
    seen = []
    pivot = mixing.rounded_copies

    def watched(start, seed):
        buckets = -(-start.count() // 200)
        seen.append(start.groupBy(F.pmod(F.xxhash64("key", "turn", F.lit(seed + 1)), F.lit(buckets)).alias("b")).count().agg(F.max("count")).head()[0])
        return pivot(start, seed, bucket_rows=200)

    monkeypatch.setattr(mixing, "rounded_copies", watched)
    got = mixing.mix(docs).collect()
    assert seen[0] < 300 and len(got) == len(rows)
    assert sum(r.doc_id is None for r in got) == 3_000 and sum(r.doc_id == 7 and r.size == 3 for r in got) >= 2_500
    for s in "ab":
        mine = [r for r in got if r.mix_source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 20 and mine[0].source_size == sum(r.size for r in mine)


def test_a_very_long_text_is_counted_whole(spark):
    docs = spark.createDataFrame([(1, "w " * 700_000, "a"), (2, "v", "a")], "doc_id long, text string, source string")
    assert {r.doc_id: (r.size, r.source_size) for r in mixing.mix(docs).collect()} == {1: (700_000, 700_001), 2: (1, 700_001)}
