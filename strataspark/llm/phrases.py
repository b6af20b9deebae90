"""Operator 13, phrase collocation mining over vertical positional inverted lists.

The corpus is cut into slices of one language, of ``SLICE_BYTES`` of text or one document. A slice's list of a phrase
holds the positions at which it begins; words are numbered through the slice, with a gap between pieces and documents, so
neighbours are neighbours within a piece. The lists of frequent words are the first level. A level is extended by merging
its sorted positions: a phrase at p and the phrase of the same length at p + 1, which adds the adjacent word, make the
list of the longer phrase, whose length is its number of occurrences in the slice. No document lies in two slices, so a
phrase's frequency is the sum of its lists' lengths.

A slice's lists of one level are one row. Lists that cannot be frequent are left out: slices send hashes and lengths of
what they hold, bucket by bucket (``tally``), and are told sums that are never too small; the frequencies themselves are
added up by the phrase's text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataspark.llm import tally, words
from strataspark.llm.common import dropped, table, written

LEAST, MOST_WORDS, COVERED, TOP = 10, 3, 50, 2000
#: Bytes of text in a slice, unless a single document is longer.
SLICE_BYTES = 4 << 20

LISTS = "slice long, lang string, phrases binary, lengths binary, positions binary"
_LISTS = pa.schema([("slice", pa.int64()), ("lang", pa.string()), ("phrases", pa.binary()), ("lengths", pa.binary()), ("positions", pa.binary())])
COUNTS = "lang string, phrase string, n long"
_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 1: between words, 2: between pieces as well.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 32]] = 1
_CLASS[[10, 11, 12, 13, *b".,;:!?"]] = 2


def postings(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, lengths of their lists, positions word by word) of some texts of one language."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _CLASS[buf]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    if not len(begin):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int32)
    piece = np.searchsorted(np.flatnonzero(kind == 2), begin)
    position = np.arange(len(begin)) + np.concatenate(([0], np.cumsum(piece[1:] != piece[:-1])))
    offsets = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int64)
    each = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[buf[inside]])]).dictionary_encode()
    code = each.indices.to_numpy()
    return each.dictionary.to_pylist(), np.bincount(code, minlength=len(each.dictionary)), position[np.argsort(code, kind="stable")].astype("<i4")


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Rows (lang, text): texts of one language, as many as make a slice of all languages together."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            held.setdefault(lang, []).append(text.as_py())
            size += len(held[lang][-1]) + 1
            if size >= SLICE_BYTES:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


@dataclass
class Lists:
    """A slice's lists of one level."""

    slice: int
    lang: str
    phrases: list[bytes]
    lengths: np.ndarray
    positions: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Lists:
        phrases = row["phrases"].split(b"\n") if row["phrases"] else []
        return cls(row["slice"], row["lang"], phrases, np.frombuffer(row["lengths"], "<i8"), np.frombuffer(row["positions"], "<i4"))

    def packed(self) -> pa.RecordBatch:
        row = (self.slice, self.lang, b"\n".join(self.phrases), self.lengths.astype("<i8").tobytes(), self.positions.astype("<i4").tobytes())
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _LISTS.types, strict=True)], schema=_LISTS)

    def counts(self) -> pa.RecordBatch:
        lang = pa.repeat(pa.scalar(self.lang, pa.string()), len(self.phrases))
        return pa.RecordBatch.from_arrays([lang, pa.array(self.phrases, pa.binary()).cast(pa.string()), pa.array(self.lengths, pa.int64())], schema=_COUNTS)

    @property
    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the language, and of each phrase; a space counts as a zero byte here."""
        named = words.word_hashes([b"\n".join([self.lang.encode().translate(_NAMED) or b"-", *self.phrases]).replace(b" ", b"\0")])[0]
        return named[:1], named[1:]

    @property
    def keys(self) -> np.ndarray:
        """A 64-bit hash of each phrase and the language."""
        lang, phrase = self.hashes
        return words.mix(phrase * words.constant(1) + lang * words.constant(3))

    def chosen(self, good: np.ndarray) -> Lists:
        return Lists(self.slice, self.lang, [p for p, g in zip(self.phrases, good.tolist(), strict=True) if g], self.lengths[good], self.positions[np.repeat(good, self.lengths)])


class Extension:
    """The lists of one word more that a slice's lists make, by merging their positions."""

    def __init__(self, lists: Lists):
        self.lists, many = lists, max(1, len(lists.phrases))
        order = np.argsort(lists.positions)
        position, code = lists.positions[order], np.repeat(np.arange(len(lists.phrases)), lists.lengths)[order]
        at = np.flatnonzero(position[1:] == position[:-1] + 1)
        pair = code[at] * many + code[at + 1]
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, np.int64)
        self.first, self.second = np.divmod(pair[start], many)
        self.lengths, self.positions = np.diff(np.append(start, len(pair))), position[at][order]

    @property
    def keys(self) -> np.ndarray:
        lang, phrase = self.lists.hashes
        return words.mix(phrase[self.first] * words.constant(1) + phrase[self.second] * words.constant(2) + lang * words.constant(3))

    def chosen(self, good: np.ndarray) -> Lists:
        held = self.lists.phrases
        last = [p[p.rfind(b" ") :] if b" " in p else b" " + p for p in held]
        longer = [held[a] + last[b] for a, b in zip(self.first[good].tolist(), self.second[good].tolist(), strict=True)]
        return Lists(self.lists.slice, self.lists.lang, longer, self.lengths[good], self.positions[np.repeat(good, self.lengths)])


#: Bytes that end a word are other bytes in a language's name, where it is hashed.
_NAMED = bytes(b + 128 if b in (9, 10, 11, 12, 13, 32) else b for b in range(256))


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to a slice's lists of all words."""
    for k, (lang, texts) in enumerate(_by_language(batches)):
        found = postings(texts)
        if found[0]:
            yield Lists((TaskContext.get().partitionId() << 32) + k, lang, *found).packed()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield Lists.of(row).counts()


def _grown(row: dict, size: int) -> Lists | Extension:
    """What has a list in level ``size``: the words themselves, or what the level before extends to."""
    return Lists.of(row) if size == 1 else Extension(Lists.of(row))


def _sent(batches: Iterator[pa.RecordBatch], size: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = _grown(row, size)
            keys, at = np.unique(found.keys, return_inverse=True)
            yield from tally.sent(row["slice"], keys, np.bincount(at, found.lengths, minlength=len(keys)).astype(np.int64), buckets).to_batches()


def _told(part: pa.Table, answers: pa.Table, size: int, least: int, buckets: int) -> Lists:
    """A slice's lists in level ``size`` that may be frequent."""
    found = _grown(part.to_pylist()[0], size)
    keys, at = np.unique(found.keys, return_inverse=True)
    return found.chosen(tally.told(answers, keys, buckets)[at] >= least)


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of every phrase of 1 to ``most_words`` words with f >= ``least``, (lang, n) of all words).

    A null language is ``und``, a null text empty. A text of any length is read whole; repeated rows count each time.
    """
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")).where("text is not null")
    lists = written(source.mapInArrow(_word_lists, LISTS))
    totals = written(lists.groupBy("lang").agg((F.sum(F.length("positions")) / 4).cast("long").alias("n")))
    buckets = max(1, -(-(totals.agg(F.sum("n")).head()[0] or 0) // tally.SLICE_KEYS))
    levels = []

    def told(size: int, out: Callable[[Lists], pa.RecordBatch]):
        return lambda part, answers: pa.Table.from_batches([out(_told(part, answers, size, least, buckets))])

    for size in range(1, most_words + 1):
        keys = lists.mapInArrow(lambda parts, k=size: _sent(parts, k, buckets), tally.SENT)
        both = lists.groupBy("slice").cogroup(keys.groupBy("bucket").applyInArrow(tally.answered, tally.ANSWER).groupBy("slice"))
        if size < most_words:
            before, lists = lists, written(both.applyInArrow(told(size, Lists.packed), LISTS))
            dropped(before)
            counts = lists.mapInArrow(_counts, COUNTS)
        else:  # nothing extends the last level
            counts = both.applyInArrow(told(size, Lists.counts), COUNTS)
        levels.append(written(counts.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least).select("lang", F.lit(size).alias("words"), "phrase", "f")))
    dropped(lists)
    every = levels[0]
    for level in levels[1:]:
        every = every.union(level)
    return every, totals


def _part(words_of, first, count):
    return F.array_join(F.slice(words_of, first, count), " ")


def collocations(counts: DataFrame, totals: DataFrame, covered: int = COVERED, top: int | None = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) from ``phrase_counts``: candidates by the score of their weakest cut.

    A candidate whose words lie inside a longer one that is at least ``covered`` hundredths as frequent is dropped.
    ``top``: the first so many of each language (None: all). Products are decimals of 38 digits: exact for frequencies
    below 10^15.
    """
    split = F.split("phrase", " ", -1)
    candidate = counts.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda w: F.transform(F.sequence(F.lit(1), F.col("words") - w + 1), lambda s: _part(split, s, w))))
    inner = candidate.where("words > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer_"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("longer_").alias("longer_"))
    left = candidate.join(longest, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer_") < covered * F.col("a"), F.lit(True))).drop("longer_")
    cut = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumns({"head_": _part(split, F.lit(1), F.col("k")), "tail_": _part(split, F.col("k") + 1, F.col("words"))})
    known = counts.select("lang", "phrase", "f")
    for side, name in (("head_", "l"), ("tail_", "r")):
        cut = cut.join(known.withColumnsRenamed({"phrase": side, "f": name}), ["lang", side])
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    scored = cut.withColumns({"over_": F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")), "under_": wide("l") * wide("r")}).withColumn("score", F.expr("over_ div under_"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut_"))
    found = weakest.select("lang", "phrase", "a", "cut_.l", "cut_.r", "cut_.score").join(totals, "lang")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:  # first inside shares of a language, so that no task ranks more than about sqrt(rows * top) rows
        found = written(found)
        shares = max(1, int((found.count() / top) ** 0.5))
        share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
        found = found.withColumn("n_", F.row_number().over(share)).where(F.col("n_") <= top).drop("n_")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (ranked if top is None else ranked.where(F.col("rank") <= top)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(*phrase_counts(table(spark, sf_dir, "documents")))


SQL = rf"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT d, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS j FROM (SELECT d, lang, string_split_regex(t, '[.,;:!?\x0A-\x0D]') AS p FROM texts)
), w AS (
  SELECT d, lang, j, unnest(x) AS w1, generate_subscripts(x, 1) AS i FROM (SELECT d, lang, j, regexp_extract_all(piece, '[^\x20\x09]+') AS x FROM pieces)
), runs AS (
  SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY d, j ORDER BY i)
), f AS MATERIALIZED (
  SELECT lang, 1 AS words, w1 AS phrase, count(*) AS f FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang
), c AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS s FROM f WHERE words > 1 AND f >= {LEAST}
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(s[1:2], ' ') AS phrase, a FROM c WHERE words = 3 UNION ALL SELECT lang, array_to_string(s[2:3], ' '), a FROM c WHERE words = 3) GROUP BY ALL
), cuts AS (
  SELECT c.*, 1 AS k, s[1] AS h, array_to_string(s[2:], ' ') AS t FROM c UNION ALL SELECT c.*, 2, array_to_string(s[1:2], ' '), s[3] FROM c WHERE words = 3
), scored AS (
  SELECT cuts.*, h.f AS l, t.f AS r, 1000000::HUGEINT * cuts.a * cuts.a // (h.f::HUGEINT * t.f) AS score
  FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = cuts.h JOIN f t ON t.lang = cuts.lang AND t.phrase = cuts.t
), weakest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS x FROM scored) WHERE x = 1
), ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank, w.phrase, w.a, w.l, w.r, totals.n, CAST(w.score AS BIGINT) AS score
  FROM weakest w JOIN totals USING (lang) LEFT JOIN longer b ON b.lang = w.lang AND b.phrase = w.phrase
  WHERE b.a IS NULL OR 100 * b.a < {COVERED} * w.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}
"""
