import random

import numpy as np
import pytest

from strataspark.llm import substring_dedup, words


def brute(rows, window):
    least = {}
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("hot", [2_000, 1])
def test_equals_brute_force(spark, hot):
    rng = random.Random(hot)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "x\x1cy"]
    passage = rng.choices(vocabulary, k=30)
    rows = []
    for i in range(80):
        w = rng.choices(vocabulary, k=rng.choice([0, 3, 11, 12, 40, 120]))
        if i % 3 == 0:
            cut = rng.randint(0, 12)
            w[rng.randint(0, len(w)) : 0] = passage[cut : rng.randint(cut, 30)]
        rows.append((i, (rng.choice([" ", "\n", " \t"])).join(w), i))
    rows += [(100, " ".join(["same"] * 300), 1), (101, " ".join(["same"] * 40), 1), (102, rows[7][1], 1), (103, None, 1), (None, rows[3][1], 1), (104, "", 1)]
    rows += [rows[6], (6, " ".join(passage), 1), (-5, " ".join(passage[:20]), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_words long").repartition(5)
    got = substring_dedup.dedup_substrings(docs, window=12, gram=3, hot_runs=hot).collect()
    assert sorted(repr((r.doc_id, r.n_words_, r.n_removed, r.kept_text)) for r in got) == brute(rows, 12)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.dedup_substrings(docs).count() == 0


def test_equal_windows_of_a_hot_minimiser_are_combined_before_the_shuffle(spark, monkeypatch):
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(14)]
    rows = [(i, " ".join(rng.choices("abcdefgh", k=5) + passage + rng.choices("abcdefgh", k=5))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plans = []
    hot = substring_dedup._hot

    def watched(placed):
        found = hot(placed)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(substring_dedup, "_hot", watched)
    found = substring_dedup.dedup_substrings(docs, window=12, gram=3, hot_runs=1)
    assert "partial_min(doc" in plans[0] and any("keys=[bucket#" in x and "packed#" in x and "partial_min(doc" in x for x in plans[0].splitlines())
    assert sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_text)) for r in found.collect()) == brute(rows, 12)


def test_very_long_and_periodic_texts(spark):
    rng = random.Random(4)
    long = [f"w{rng.randrange(300)}" for _ in range(60_000)]
    rows = [(1, " ".join(long[100:160])), (2, " ".join(long)), (3, "same " * 60_000), (4, "same " * 70), (5, "a b " * 5_000), (6, "b a " * 40)]
    got = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_text)) for r in got) == brute(rows, 50)


def test_long_runs_that_share_a_minimiser_travel_window_by_window(spark, monkeypatch):
    """Long texts with a line that returns: one super-k-mer each, few in all, but more windows than a bucket may hold."""
    rng = random.Random(7)
    hashes, _ = words.word_hashes([" ".join(f"l{k}" for k in range(400_000)).encode()])
    k = int(np.argmin(words.gram_hashes(hashes, 3)))  # less than the hash of any other gram below
    line = f" l{k} l{k + 1} l{k + 2} "
    texts = [" ".join(f"u{rng.randrange(2_000)}" for _ in range(10)) for _ in range(400)]
    rows = [(i, line.join(rng.sample(texts, 115) + texts[:5])) for i in range(40)]
    sent = []
    hot = substring_dedup._hot
    monkeypatch.setattr(substring_dedup, "_hot", lambda placed: sent.append(placed.selectExpr("sum(size(at))").head()[0]) or hot(placed))
    found = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), window=30, gram=3).collect()
    assert sent[0] and sent[0] > substring_dedup.HOT_WINDOWS
    assert sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_text)) for r in found) == brute(rows, 30)
