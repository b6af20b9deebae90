"""Corpus pipeline: five stages over ``documents``, each writing what it keeps for the next.

A stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm import mixing, ngram_join, packing, substring_dedup, toxicity
from strataspark.llm.common import fresh_name, removed, stage_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model finds clean."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.score(docs.select(*docs.columns), model)
    return judged.where(~F.col(judged.columns[-1])).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group whose five-word shingles are 0.8 similar or more."""
    return ngram_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without 50-word windows that a document with a smaller id has; documents left without words go."""
    found = substring_dedup.dedup_substrings(docs)
    kept, _, removed = found.columns[-3:]
    text = F.when(F.col(removed) > 0, F.col(kept)).otherwise(F.col("text"))
    left = found.where((F.col(removed) == 0) | (F.col(kept) != ""))
    return left.withColumns({"text": text, "n_chars": F.when(F.col(removed) > 0, F.length(kept).cast("long")).otherwise(F.col("n_chars"))}).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it. Rows that are equal in every column are taken together."""
    whole = F.xxhash64(*docs.columns)
    key = fresh_name(docs, "mixed_row")
    times = mixing.mix(docs, tag=whole).where("copies > 0").groupBy(F.col("tag").alias(key)).agg(F.sum("copies").cast("int").alias("times"))
    once = docs.withColumn(key, whole).dropDuplicates([key])
    taken = once.join(times.withColumnRenamed("times", fresh_name(docs, "times")), key)
    again = F.explode(F.sequence(F.lit(1), F.col(taken.columns[-1]))).alias(fresh_name(docs, "again"))
    return taken.select(*docs.columns, again).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids, piece by piece with their ids."""
    return packing.pack(docs, packing.tokenizer_path(), derived={"ids_crc32": F.crc32("ids").cast("long")})


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_near_copies),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained and drawn stages have no SQL; tests hold the pipeline against plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet in the shared folder and read again.

    A null or blank text has no words: it is neither toxic nor like another, and the mix, which takes words, takes none
    of it. Rows of a null id are told apart by their other columns. Columns beside those of documents stay until packing,
    whatever their names. An empty table passes through all stages. A stage's table is deleted once the next is written.
    """
    folder = stage_folder(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        where = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(where)
        if before:
            removed(spark, before)
        docs, before = spark.read.parquet(where), where
    return docs
