import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from strataspark.llm import quality

PLAIN = ["".join(p) for p in [(a, b, c) for a in ("ta", "ri", "mo", "sel") for b in ("n", "ck", "v") for c in ("e", "on", "is", "a")]]


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = rng.choices(PLAIN, k=rng.randint(1, 400))
        bad = rng.random() < 0.2
        if bad:
            w = [rng.choice(w)] * 80 if rng.random() < 0.3 else [x.upper() + "!!" for x in w] if rng.random() < 0.5 else [x + rng.choice(["***", "$$$", "###"]) for x in w]
        rows.append((i, " ".join(w), int(not bad)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(1, 1500)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, Score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 0), (99_999, 1)], "doc_id long, quality int")
    return rows, docs, labels, quality.fit(docs, labels)


def test_held_out_accuracy(fitted):
    rows, docs, _, model = fitted
    got = {r.doc_id: r for r in quality.score(docs, model).withColumn("held", quality.held_out(F.col("doc_id"))).collect()}
    assert {i: r.held for i, r in got.items()} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows}
    held = [(got[i].predicted, y, t) for i, t, y in rows if got[i].held]
    assert np.mean([p for p, y, _ in held if y]) > 0.98
    assert np.mean([p for p, y, t in held if not y and len(t) > 60]) < 0.15
    assert all(0 <= r.score_ <= 1 for r in got.values())


def test_held_out_labels_never_count(spark, fitted):
    rows, docs, labels, model = fitted
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.fit(docs, other)
    assert again.dictionaries == model.dictionaries and np.array_equal(again.weight, model.weight)


def test_scores_are_those_of_a_plain_loop(fitted):
    rows, docs, _, model = fitted

    def sizes(text, held):
        total = 0
        for k in range(0, len(text), quality.PART_BYTES):
            told = zstandard.ZstdCompressionDict(held, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            told.precompute_compress(level=quality.LEVEL)
            total += len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=told, write_content_size=False).compress(text[k : k + quality.PART_BYTES]))
        return total

    got = {r.doc_id: r["score_"] for r in quality.score(docs, model).collect()}
    for i, t, _ in rows[:40]:
        text = t.encode()
        good, bad = (sizes(text, d) for d in model.dictionaries)
        x = (np.array([(bad - good) / (len(text) + 32), good / (len(text) + 32)]) - model.middle) / model.spread
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(x @ model.weight[:2] + model.weight[2]))), rel=1e-9)


def test_edges(spark, fitted):
    _, docs, labels, model = fitted
    odd = [(1, None), (2, ""), (3, " \n"), (None, "tane rion"), (7, "tane " * 400_000), (8, "é" * 5000), (8, "é" * 5000)]
    got = quality.score(spark.createDataFrame(odd, "doc_id long, text string"), model)
    rows = got.collect()
    assert got.columns == ["doc_id", "text", "score", "predicted"] and len(rows) == 7 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert rows[0].score == rows[1].score and rows[5].score == rows[6].score
    assert quality.score(docs.limit(0), model).count() == 0
    for some, share in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        assert {r[0] for r in quality.score(docs, quality.fit(docs, some)).select("score_").distinct().collect()} == {share}
    twice = labels.union(labels.withColumn("quality", F.lit(1)))  # an id is good only if all its labels say so
    assert quality.fit(docs, twice).dictionaries == model.dictionaries


def test_the_sample_is_bounded(fitted):
    _, docs, labels, _ = fitted
    model = quality.fit(docs, labels, sample_docs=100)
    assert sum(d.count(b"\n") + 1 for d in model.dictionaries) <= 100
    assert len(quality.dictionary([b"x" * 512] * 2000)) <= quality.DICTIONARY_BYTES
