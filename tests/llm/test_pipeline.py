import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strataspark.llm import mixing, ngram_join, packing, substring_dedup, toxicity


def test_stages_keep_columns_and_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, sf).cache()
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    want = {r.doc_id for r in docs.collect() if model.severity(r.text)[1] < toxicity.CUT}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == want
    single = corpus_pipeline.one_of_near_copies(spark, clean, sf).cache()
    heads = {r.component_id for r in ngram_join.jaccard_join(clean).collect()}
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == heads
    cut = corpus_pipeline.cut_repeats(spark, single, sf).cache()
    kept = {r.doc_id: r.kept_text for r in substring_dedup.dedup_substrings(single).collect() if r.n_removed == 0 or r.kept_text}
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text.encode().split() for r in cut.collect()} == {i: t.encode().split() for i, t in kept.items()}
    mixed = corpus_pipeline.mix_sources(spark, cut, sf)
    copies = {r.doc_id: r.copies for r in mixing.mix(cut, tag=F.xxhash64(*cut.columns)).collect() if r.copies}
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies


def test_packed_sequences_hold_the_ids_of_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = corpus_pipeline.pack_sequences(spark, docs, sf).collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    pieces = {}
    for r in sorted(rows, key=lambda r: r.start):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + bytes(r.ids)
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.encode_special_tokens = True
    want = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, packing.END_ID] for r in docs.collect()}
    assert {i: np.frombuffer(b, "<u4").tolist() for i, b in pieces.items()} == want
