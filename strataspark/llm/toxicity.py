"""Operator 6, toxicity: cumulative-link ordinal regression over sparse text features, trained in numpy.

P(grade <= k | x) = sigmoid(theta_k - w.x) with ordered thresholds theta and one weight vector w for all of them.
Labels say toxic or not. A toxic document's grade, 1 to 3, is derived: it counts how many distinct words of it are tied
to toxicity in the labelled rows (3 and 6 are the steps). The output is the expected severity and whether
P(grade >= 1) reaches ``CUT``.

Features: log(1 + count) of words (A-Z lower-cased, outer non-letters stripped, named by 64-bit hashes) that tell the
classes apart, weighted up to twice in short texts, where one such word says more.
The classifier is fitted on at most ``SAMPLE_DOCS`` labelled rows, drawn by hash. Their words' document frequencies are
a distributed aggregate; only the ``MAX_FEATURES`` words that tell most and the sample's counts of these words come to
the driver, no text does. Scoring reads whole texts, a bounded slice of a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm import words
from strataspark.llm.common import dropped, fresh_name, slices, table, written

SAMPLE_DOCS, MAX_FEATURES, MIN_Z, CUT = 12_000, 2_000, 4.0, 0.3
GRADES = 4
#: Words of a text at which the extra weight of short texts is halved; documents that a feature occurs in, at least.
SHORT_WORDS, LEAST_DOCS = 100, 3


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, times) of each text's distinct words, sorted, and the number of words of each text."""
    hashes, first = words.word_hashes(texts, lower=True, letters=True)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])))) if len(owner) else np.zeros(0, np.int64)
    return owner[new], hashes[new], np.diff(np.append(new, len(owner))), np.diff(first)


def short_weight(length):
    """From 2 for a text of a few words down to 1 for a long one."""
    return 1 + SHORT_WORDS / (SHORT_WORDS + length)


def z_score(bad, clean, all_bad, all_clean, sqrt=np.sqrt, least=np.maximum):
    """Of the difference of a word's document frequencies in the two classes; for arrays, or for columns."""
    p = (bad + clean) / (all_bad + all_clean)
    return (bad / all_bad - clean / all_clean) / sqrt(least(p * (1 - p), 1e-9) * (1 / all_bad + 1 / all_clean))


class OrdinalModel:
    """Weights by word hash (sorted), and thresholds."""

    def __init__(self):
        self.keys, self.weight = np.zeros(0, np.uint64), np.zeros(0)
        self.theta = np.array([1.0, 2.0, 3.0])

    def fit(self, texts: list[str | None], toxic: list[int]) -> OrdinalModel:
        """The same as the distributed ``fit``, for texts at hand."""
        y = np.array(toxic, bool)
        row, key, times, length = bags([(t or "").encode() for t in texts])
        if y.all() or not y.any():
            return self
        known, at = np.unique(key, return_inverse=True)
        bad, clean = (np.bincount(at[y[row] == side], minlength=len(known)) for side in (True, False))
        z = z_score(bad, clean, int(y.sum()), int((~y).sum()))
        strong = np.flatnonzero((bad + clean >= LEAST_DOCS) & (np.abs(z) >= MIN_Z))
        strong = np.sort(strong[np.lexsort((known[strong], -np.abs(z[strong])))][:MAX_FEATURES])
        place = np.full(len(known), -1)
        place[strong] = np.arange(len(strong))
        used = place[at] >= 0
        return self.train(known[strong], z[strong], row[used], place[at[used]], times[used], length, y)

    def train(self, keys: np.ndarray, z: np.ndarray, row: np.ndarray, col: np.ndarray, times: np.ndarray, length: np.ndarray, y: np.ndarray, rounds: int = 600, rate: float = 0.05, ridge: float = 1e-4) -> OrdinalModel:
        """Full-batch Adam on the likelihood of the grades of sparse rows (row, col, times)."""
        if not len(keys):
            return self
        value = np.log1p(times) * short_weight(length)[row]
        tied = np.bincount(row[z[col] > 0], minlength=len(y))
        grade = np.where(y, np.clip(1 + (tied >= 3) + (tied >= 6), 1, GRADES - 1), 0)
        w, b = np.zeros(len(keys)), np.array([1.0, 0.5, 0.5])  # first threshold, logs of the gaps to the next
        moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
        for step in range(1, rounds + 1):
            theta = np.cumsum(np.concatenate((b[:1], np.exp(b[1:]))))
            s = np.bincount(row, value * w[col], minlength=len(y))
            edge = np.concatenate(([-np.inf], theta, [np.inf]))
            hi, lo = _sigmoid(edge[grade + 1] - s), _sigmoid(edge[grade] - s)
            p = np.maximum(hi - lo, 1e-12)
            dhi, dlo = hi * (1 - hi) / p / len(y), lo * (1 - lo) / p / len(y)
            ds = dhi - dlo  # of the negative log-likelihood with respect to s
            gw = np.bincount(col, value * ds[row], minlength=len(keys)) + ridge * w
            gt = np.array([-dhi[grade == k].sum() + dlo[grade == k + 1].sum() for k in range(GRADES - 1)])
            gb = np.array([gt.sum(), *(gt[k:].sum() * np.exp(b[k]) for k in range(1, GRADES - 1))])
            for x, g, m, v in ((w, gw, moments[0], moments[1]), (b, gb, moments[2], moments[3])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.theta = np.cumsum(np.concatenate((b[:1], np.exp(b[1:]))))
        self.keys, self.weight = keys, w
        return self

    def judge(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(expected grade, probability of grade 1 or more) of each text."""
        hashes, first = words.word_hashes(texts, lower=True, letters=True)
        length, n = np.diff(first), len(self.keys)
        s = np.zeros(len(texts))
        if n and len(hashes):
            at = np.minimum(np.searchsorted(self.keys, hashes), n - 1)
            known = self.keys[at] == hashes
            cell, times = np.unique(np.repeat(np.arange(len(texts)), length)[known] * n + at[known], return_counts=True)
            s = np.bincount(cell // n, self.weight[cell % n] * np.log1p(times), minlength=len(texts)) * short_weight(length)
        above = _sigmoid(s[:, None] - self.theta)
        return above.sum(1), above[:, 0]

    def severity(self, text: str | None) -> tuple[float, float]:
        grade, p = self.judge([(text or "").encode()])
        return float(grade[0]), float(p[0])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (toxic, text) to (word, documents of either class)."""
    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        for first, texts in slices(batch.column(1)):
            row, key, _, _ = bags(texts)
            known, at = np.unique(key, return_inverse=True)
            side = y[first + row]
            bad, clean = (np.bincount(at[side == s], minlength=len(known)) for s in (True, False))
            yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(bad.astype(np.int64)), pa.array(clean.astype(np.int64))], names=["word", "bad", "clean"])


_ROWS = pa.schema([("doc_id", pa.int64()), ("toxic", pa.bool_()), ("length", pa.int64()), ("cols", pa.binary()), ("times", pa.binary())])


def _sparse(batches: Iterator[pa.RecordBatch], keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, toxic, text) to the counts of the chosen words."""
    for batch in batches:
        for first, texts in slices(batch.column(2)):
            row, key, times, length = bags(texts)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            used = keys[at] == key
            row, at, times = row[used], at[used].astype("<i4"), times[used].astype("<i4")
            edge = np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
            packed = ([x[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)] for x in (at, times))
            ids, toxic = (batch.column(k).slice(first, len(texts)) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), toxic.cast(pa.bool_()), pa.array(length, pa.int64()), *(pa.array(x, pa.binary()) for x in packed)], schema=_ROWS)


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> OrdinalModel:
    """From the rows of ``labels``(doc_id, toxic) whose documents are there. Null ids and labels take no part, an id that
    is labelled twice is toxic if either says so, and of rows of ``docs`` with one id the least text counts, so the
    sample holds ``sample_docs`` texts at most. Without rows of both classes every text scores alike."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = known.orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id").limit(sample_docs)
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    sample = written(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    sides = {bool(r.toxic): r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sides) < 2:
        return OrdinalModel()
    counts = sample.select("toxic", "text").mapInArrow(_frequencies, "word long, bad long, clean long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean"))
    z = z_score(F.col("bad"), F.col("clean"), sides[True], sides[False], F.sqrt, lambda a, b: F.greatest(a, F.lit(b)))
    told = counts.where(F.col("bad") + F.col("clean") >= LEAST_DOCS).withColumn("z", z).where(F.abs("z") >= MIN_Z)
    chosen = told.orderBy(F.abs("z").desc(), "word").limit(MAX_FEATURES).select("word", "z").toPandas()
    keys = chosen.word.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, z = keys[order], chosen.z.to_numpy(float)[order]
    if not len(keys):
        return OrdinalModel()
    rows = sample.select("doc_id", "toxic", "text").mapInArrow(lambda parts: _sparse(parts, keys), "doc_id long, toxic boolean, length long, cols binary, times binary").orderBy("doc_id").toPandas()
    dropped(sample)
    cols, times = (np.frombuffer(b"".join(rows[c]), "<i4") for c in ("cols", "times"))
    row = np.repeat(np.arange(len(rows)), [len(c) // 4 for c in rows.cols])
    return OrdinalModel().train(keys, z, row, cols, times, rows.length.to_numpy(np.int64), rows.toxic.to_numpy(bool))


def score(docs: DataFrame, model: OrdinalModel, text: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with (severity double, p_toxic double, toxic boolean); clashing names get an underscore. Null and blank
    texts score as no words at all, repeated rows alike; a text of any length is scored whole."""
    names = [fresh_name(docs, n) for n in ("severity", "p_toxic", "toxic")]
    told = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<severity:double,p:double>")
    def judged(texts: pa.Array) -> pa.Array:
        found = [told.value.judge(part) for _, part in slices(texts)]
        grade, p = (np.concatenate([np.zeros(0), *(f[k] for f in found)]) for k in (0, 1))
        return pa.StructArray.from_arrays([pa.array(grade), pa.array(p)], names=["severity", "p"])

    found = fresh_name(docs, "judged")
    out = docs.withColumn(found, judged(F.col(text).cast("string")))
    return out.select(*docs.columns, F.col(f"{found}.severity").alias(names[0]), F.col(f"{found}.p").alias(names[1]), (F.col(f"{found}.p") >= cut).alias(names[2]))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", "severity", "p_toxic", "toxic")
