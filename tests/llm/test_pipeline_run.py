import ast
import random

import numpy as np
from pyspark.sql import functions as F
from tests.llm.test_ngram_join import brute as ngram_brute
from tests.llm.test_substring_dedup import brute as window_brute
from tokenizers import Tokenizer

import corpus_pipeline
from strataspark.llm import mixing, packing, toxicity


def folder(spark, path, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, times string, mixed_row long, Kept_text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    shared = rng.choices(words, k=60)
    rows = []
    for i in range(60):
        w = rng.choices(words, k=rng.randrange(30, 90))
        if i % 6 == 0:
            w[rng.randrange(len(w)) : 0] = shared
        if i % 4 == 1:
            w += rng.choices(["scum", "idiot", "moron"], k=6)
        rows.append((i, " ".join(w), int(i % 4 == 1)))
    rows += [(100 + i, rows[i][1] + " tail", 0) for i in range(0, 20, 5)]
    return rows


def test_run_equals_plain_stages(spark, tmp_path):
    rows = corpus()
    docs = [(i, t, "en", f"s{i % 3}" if i is not None else None, len(t or ""), "a", 1, "k") for i, t, _ in rows]
    docs += [docs[3], docs[3], (None, "alone in the dark", "en", None, 3, None, None, None), (None, None, None, None, None, None, None, None), (200, "", "", "s1", 0, "", 0, ""), (201, None, "", "s1", 0, "", 0, "")]
    sf = folder(spark, tmp_path, docs, [(i, 1, y) for i, _, y in rows if i % 7] + [(None, 1, 1), (5, 1, None)])
    got = corpus_pipeline.run(spark, sf).collect()

    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    kept = [d for d in docs if model.severity(d[1])[1] < toxicity.CUT]
    assert 10 < len(kept) < len(docs)
    heads = [ast.literal_eval(x) for x in ngram_brute([(d[0], d[1]) for d in kept], 5, 80, 100)]
    gone = {i for i, _, c, _ in heads if i is not None and c < i}
    kept = [d for d in kept if d[0] not in gone]
    cut = {}
    for i, _, removed, text in map(ast.literal_eval, window_brute([(d[0], d[1]) for d in kept], 50)):
        cut[i, removed, text] = cut.get((i, removed, text), 0) + 1
    texts = {}
    for d in kept:
        words = (d[1] or "").encode().split()
        match = next(k for k in cut if k[0] == d[0] and (k[2] == b" ".join(words).decode() if k[1] == 0 else len(k[2].encode().split()) == len(words) - k[1]))
        if match[1] == 0 or match[2]:
            texts.setdefault((d[0], d[3]), []).append(d[1] if match[1] == 0 else match[2])
    names = sorted({s for _, s in texts if s is not None}) + ([None] if any(s is None for _, s in texts) else [])
    size = {s: sum(len((t or "").split()) for (_, x), some in texts.items() if x == s for t in some) for s in names}
    target = dict(zip(names, mixing.water_filled([size[s] for s in names], [i % 3 + 1.0 for i in range(len(names))]), strict=True))

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.encode_special_tokens = True
    ids = {k: {tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID]): len((t or "").split()) for t in some} for k, some in texts.items()}
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    place = {}
    for r in got:
        place.setdefault(r.sequence_id, []).append((r.offset, r.length, np.frombuffer(r.ids, "<u4").tolist()))
    assert all(sum(n for _, n, _ in p) <= 1024 for p in place.values())
    whole = [tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in got if r.length == r.doc_tokens]
    known = {i: (k, n) for k, some in ids.items() for i, n in some.items()}
    assert all(w in known for w in whole) and len(whole) > 0.5 * len(got)
    if len(whole) == len(got):
        for s in names:
            assert abs(sum(known[w][1] for w in whole if known[w][0][1] == s) - target[s]) <= 90


def test_run_on_an_empty_table(spark, tmp_path):
    sf = folder(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_mix_stage_takes_repeated_rows_as_the_mix_does(spark):
    rows = [(i, "two words", "x", "a", 9) for i in range(20) for _ in range(50)] + [(1_000 + i, "w " * (1 + i % 9), "x", "b", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    taken = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    want = {r.mix_source: r.n for r in mixing.mix(docs, tag=F.xxhash64(*docs.columns)).groupBy("mix_source").agg(F.sum("taken").alias("n")).collect()}
    target = {r.mix_source: r.target for r in mixing.mix(docs).select("mix_source", "target").distinct().collect()}
    assert taken == want and all(abs(taken[s] - target[s]) <= 9 for s in target)
