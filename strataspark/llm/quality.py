"""Operator 11, quality classifier: how much better a dictionary of good text compresses a document than one of bad text.

Two zstandard dictionaries hold raw pieces of text, of good and of bad labelled documents. A text is compressed in parts
of ``PART_BYTES`` with either; parts keep the dictionaries in reach however long a text is. Its difference is the sum of
(bad - good) sizes over its length, its density the good size over its length. A logistic curve over both, fitted on
labelled documents that gave no piece to a dictionary, turns them into the probability of label 1. The density tells
text that repeats itself, which either dictionary compresses alike.

At most ``SAMPLE_DOCS`` labelled rows are used, drawn by hash; half of them, by hash again, give pieces of at most
``PIECE_BYTES`` from their middles, up to ``DICTIONARY_BYTES`` a class, the others calibrate. Pieces and two sizes of
each calibrating document come to the driver, whole texts do not. Scoring reads whole texts where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm.common import dropped, fresh_name, slices, table, written

SAMPLE_DOCS, CUT = 12_000, 0.3
DICTIONARY_BYTES, PIECE_BYTES, PART_BYTES, LEVEL = 1 << 18, 512, 2048, 6
#: Bytes added to every length, so that a few bytes of a short text say little.
FIXED_BYTES = 32
#: One in so many ids, by crc32, is held out of all fitting.
FOLDS = 5


class CompressionModel:
    """Dictionaries of both classes (good first) and the calibration. Without both classes every text scores ``share``."""

    def __init__(self, dictionaries: tuple[bytes, bytes] | None = None, share: float = 0.5):
        self.dictionaries, self.share = dictionaries, share
        self.weight: np.ndarray | None = None
        self._compressors = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_compressors": None}

    @property
    def compressors(self) -> list[zstandard.ZstdCompressor]:
        if self._compressors is None:
            self._compressors = []
            for held in self.dictionaries:
                told = zstandard.ZstdCompressionDict(held, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                told.precompute_compress(level=LEVEL)
                self._compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=told, write_content_size=False, write_checksum=False, write_dict_id=False))
        return self._compressors

    def features(self, texts: list[bytes]) -> np.ndarray:
        """(normalised difference, density) of each text."""
        good, bad = (c.compress for c in self.compressors)
        out = np.zeros((len(texts), 2))
        for i, text in enumerate(texts):
            parts = [text[k : k + PART_BYTES] for k in range(0, len(text), PART_BYTES)]
            fine, poor = sum(len(good(p)) for p in parts), sum(len(bad(p)) for p in parts)
            out[i] = ((poor - fine) / (len(text) + FIXED_BYTES), fine / (len(text) + FIXED_BYTES))
        return out

    def calibrate(self, features: np.ndarray, label: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> CompressionModel:
        """Newton's method on the logistic likelihood; the ridge keeps separable classes finite."""
        if not len(label):
            return self
        self.middle, self.spread = features.mean(0), features.std(0) + 1e-9
        x, w = self._rows(features), np.zeros(features.shape[1] + 1)
        for _ in range(rounds):
            p = _sigmoid(x @ w)
            slope = x.T @ (p - label) + ridge * w
            w = w - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), slope)
        self.weight = w
        return self

    def _rows(self, features: np.ndarray) -> np.ndarray:
        return np.column_stack(((features - self.middle) / self.spread, np.ones(len(features))))

    def judge(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1 of each text."""
        if self.weight is None:
            return np.full(len(texts), self.share)
        return _sigmoid(self._rows(self.features(texts)) @ self.weight)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Whether an id takes no part in fitting; a null id, which no label can name, does not count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def piece(text: bytes) -> bytes:
    """The middle of a text, of ``PIECE_BYTES`` at most."""
    start = max(0, (len(text) - PIECE_BYTES) // 2)
    return text[start : start + PIECE_BYTES]


def dictionary(pieces: list[bytes]) -> bytes:
    """The first pieces that fit, one a line."""
    room = np.cumsum([len(p) + 1 for p in pieces])
    return b"\n".join(pieces[: int(np.searchsorted(room, DICTIONARY_BYTES, "right"))])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [piece(t) for _, texts in slices(batch.column(2)) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["drawn", "good", "piece"])


def _features(batches: Iterator[pa.RecordBatch], model: CompressionModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.concatenate([np.zeros((0, 2)), *(model.features(texts) for _, texts in slices(batch.column(2)))])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found[:, 0]), pa.array(found[:, 1])], names=["drawn", "good", "difference", "density"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_docs: int = SAMPLE_DOCS) -> CompressionModel:
    """From the rows of ``labels``(doc_id, ``label`` 0/1) whose documents are there and are not ``held_out``.

    Null ids and labels take no part; an id that is labelled twice is good if all its labels say so; of rows of ``docs``
    with one id the least text counts, null as empty. Without rows of both classes in either half, every text scores the
    share of good rows (0.5 without any).
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.min(label) > 0).alias("good"))
    drawn = known.withColumn("drawn", F.xxhash64("doc_id", F.lit(11))).orderBy("drawn", "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")  # bounded by sample_docs
    sample = written(texts.groupBy("doc_id", "drawn", "good").agg(F.min("text").alias("text")))
    half = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(2))
    told = sample.where(half == 0).select("drawn", "good", "text").mapInArrow(_pieces, "drawn long, good boolean, piece binary").where("length(piece) > 0")
    pieces = sorted((r.drawn, bytes(r.piece), r.good) for r in told.collect())  # at most sample_docs pieces
    sides = [[p for _, p, good in pieces if good == side] for side in (True, False)]
    share = sample.agg(F.avg(F.col("good").cast("double"))).head()[0]
    model = CompressionModel(tuple(map(dictionary, sides)), 0.5 if share is None else share)
    if all(sides):
        rest = sample.where(half == 1).select("drawn", "good", "text").mapInArrow(lambda parts: _features(parts, model), "drawn long, good boolean, difference double, density double")
        rows = rest.toPandas().sort_values(["drawn", "difference", "density"])  # at most sample_docs rows of four numbers
        good = rows.good.to_numpy(bool)
        if good.any() and not good.all():
            model.calibrate(rows[["difference", "density"]].to_numpy(float), good.astype(float))
    dropped(sample)
    return model


def score(docs: DataFrame, model: CompressionModel, text: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with (score double, predicted int); clashing names get an underscore. Only the text counts: null and empty
    texts score as no bytes at all, repeated rows alike; a text of any length is scored whole."""
    names = [fresh_name(docs, n) for n in ("score", "predicted")]
    told = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def judged(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(told.value.judge(part) for _, part in slices(texts))]))

    out = docs.withColumn(names[0], judged(F.col(text).cast("string")))
    return out.withColumn(names[1], (F.col(names[0]) >= cut).cast("int"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model).select("doc_id", "held_out", "score", "predicted")
