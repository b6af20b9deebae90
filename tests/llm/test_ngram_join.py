import ast
import random

import numpy as np
import pyarrow as pa
import pytest

from strataspark.llm import ngram_join


def gram_sets(rows, n):
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    out = []
    for i, t in rows:
        w = (t or "").encode().translate(low).split()
        out.append((i, {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()))
    return out


def brute(rows, n, num, den):
    sets = gram_sets(rows, n)
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(sets)
    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            if i is not None and j is not None and x and y and den * len(x & y) >= num * len(x | y):
                links[a] += 1
                links[b] += 1
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return sorted(repr((i, len(x), None if i is None else root(i), None if i is None else links[k])) for k, (i, x) in enumerate(sets))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "É".lower(), "X"]
    bases = [rng.choices(vocabulary, k=rng.choice([2, 4, 9, 20, 45, 90])) for _ in range(25)]
    rows = []
    for i in range(170):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            k = rng.randrange(len(w))
            w[k : k + rng.choice([0, 1])] = rng.choices(vocabulary, k=rng.choice([0, 1, 2]))
            w = w or ["w1"]
        rows.append((i, rng.choice([" ", "\n"]).join(x.upper() if rng.random() < 0.1 and x.isascii() else x for x in w)))
    return rows + [(500, None), (501, ""), (502, " \t"), (None, rows[0][1]), (503, "solo")]


@pytest.mark.parametrize(("n", "num", "task_grams"), [(3, 90, 10**6), (5, 80, 10**6), (2, 70, 150)])
def test_equals_brute_force(spark, n, num, task_grams):
    rows = corpus(n)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, Component_id string").repartition(5)
    got = ngram_join.jaccard_join(docs, n=n, similarity=(num, 100), task_grams=task_grams).collect()
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id, r.n_links)) for r in got) == brute(rows, n, num, 100)
    plain = ngram_join.jaccard_join(docs, n=n, similarity=(num, 100), task_grams=task_grams, count_links=False)
    assert plain.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(repr, map(tuple, plain.collect()))) == sorted(repr(tuple(r)[:3]) for r in got)


def test_prefixes_lose_no_pair():
    rng = np.random.default_rng(1)
    for num in (60, 80, 90):
        for size in (*range(1, 40), 150, 400, 1200):
            for _ in range(6):
                x = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                drop = rng.integers(0, 1 + int(size * (100 - num) / 100))
                add = rng.integers(0, 1 + int(size * (100 - num) / num))
                y = np.unique(np.concatenate([rng.permutation(x)[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
                both = np.intersect1d(x, y)
                sets = {int(g): 2 + int(g) % 5 for g in both}
                if len(y) and 100 * len(both) >= num * (len(x) + len(y) - len(both)):
                    prefixes = [ngram_join.prefix_of(z, np.array([sets.get(int(g), 1) for g in z]), num, 100) for z in (x, y)]
                    assert len(np.intersect1d(*prefixes))


def test_a_line_that_all_documents_share_makes_no_candidates(spark):
    rng = random.Random(3)
    line = " ".join(f"line{i}" for i in range(20))
    rows = [(i, " ".join([*rng.choices([f"w{k}" for k in range(5_000)], k=60), line])) for i in range(300)]
    rows += [(1_000 + i, f"{t} more") for i, t in rows[:40]]
    assert ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).count() == 300
    sets = [g for _, g in ngram_join._texts_sets(pa.array([t for _, t in rows]), 5)]
    flat, counts = np.unique(np.concatenate(sets), return_counts=True)
    held = dict(zip(flat.tolist(), counts.tolist(), strict=True))
    assert not any(len(ngram_join.prefix_of(g, np.array([held[x] for x in g.tolist()]), 80, 100)) for g in sets[40:300])


def test_large_groups_long_texts_and_several_texts_of_one_id(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(base if i % 3 else [*base[: i % 40], f"x{i}", *base[i % 40 :]])) for i in range(200)]
    rows += [(300, " ".join(base[:20])), (300, " ".join(f"c{i}" for i in range(30))), (301, " ".join(f"c{i}" for i in range(30)))]
    long = [f"l{rng.randrange(9_000)}" for _ in range(60_000)]
    rows += [(400, " ".join(long)), (401, " ".join([*long, "end"])), (402, "same " * 50_000), (403, "same " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(repr((r.doc_id, r.component_id)) for r in ngram_join.jaccard_join(docs, n=3, similarity=(85, 100), task_grams=2_000).collect())
    assert got == sorted(repr((i, c)) for i, _, c, _ in map(ast.literal_eval, brute(rows, 3, 85, 100)))


def test_one_of_each_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(3, text), (1, text), (2, text + " more"), (9, "other"), (None, text), (4, None)], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in ngram_join.one_of_each(docs).collect()) == ["1", "4", "9", "None"]
    assert ngram_join.jaccard_join(docs.limit(0)).count() == 0
