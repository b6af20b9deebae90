"""Operator 4, substring dedup: windows of 50 words that also start in a document with a smaller id are removed.

Super-k-mer partitioning. The minimiser of a window is the least hash among its ``GRAM``-word grams, so equal windows
have equal minimisers. Consecutive windows of a document that share one form a super-k-mer. Rounds:

1. super-k-mers as (minimiser, run hash, doc, place) are written once; only those of minimisers that two documents
   share go on, and are combined to the least document of each distinct one;
2. that document cuts it out of its text, and it travels as one packed string to its minimiser's bucket, where sorting
   the windows (as strings) gives the least document of each;
3. every document looks its super-k-mers up and removes the words of windows that a smaller document has.

A minimiser that occurs more than ``HOT_RUNS`` times, or whose super-k-mers have more than ``HOT_WINDOWS`` windows (as
of long texts with a line that returns), is hot: its windows travel one by one, keyed by their own hash and
text. Each task combines equal ones to their least document before the shuffle, different ones spread, and the places
(minimiser, run, offset) are joined to the outcome, so no task holds a bucket of one window's places. A row is
identified by its id and its text's hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm import words
from strataspark.llm.common import dropped, fresh_name, slices, table, written

WINDOW, GRAM, HOT_RUNS, HOT_WINDOWS = 50, 6, 200, 50_000
#: Rows of packed strings that a task gathers before it sends them.
SENT_ROWS = 5_000

_RUNS = pa.schema([("mini", pa.int64()), ("run", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("start", pa.int32()), ("count", pa.int32())])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _runs(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, run hash, first window, windows) of one text's super-k-mers."""
    if len(hashes) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    mini = words.sliding_min(words.gram_hashes(hashes, gram), window - gram + 1)
    start = np.flatnonzero(np.concatenate(([True], mini[1:] != mini[:-1])))
    count = np.diff(np.append(start, len(mini)))
    run = words.run_of(words.run_hash(hashes), start, start + count + window - 1)
    return _signed(mini[start]), _signed(run), start, count


def _all_runs(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc, tag, text) to super-k-mers."""
    for batch in batches:
        doc, tag = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        for first_row, texts in slices(batch.column(2)):
            hashes, first = words.word_hashes(texts)
            found = [_runs(hashes[first[i] : first[i + 1]], window, gram) for i in range(len(texts))]
            sizes = [len(f[0]) for f in found]
            rows = np.repeat(np.arange(first_row, first_row + len(texts)), sizes)
            if len(rows):
                mini, run, start, count = (np.concatenate([f[c] for f in found]) for c in range(4))
                yield pa.RecordBatch.from_arrays([pa.array(mini), pa.array(run), pa.array(doc[rows].astype(np.int64)), pa.array(tag[rows].astype(np.int64)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], schema=_RUNS)


_PACKED = pa.schema([("hot", pa.bool_()), ("bucket", pa.int64()), ("mini", pa.int64()), ("run", pa.int64()), ("at", pa.list_(pa.int32())), ("doc", pa.int64()), ("packed", pa.binary())])


def _cut(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc, text, wanted runs, whether each is hot) to packed strings; a hot run's windows one by one."""
    for batch in batches:
        out: list[tuple] = []
        for doc, text, wanted, hot in zip(*(batch.column(i) for i in range(4)), strict=True):
            raw, doc = (text.as_py() or "").encode(), doc.as_py()
            hashes, _ = words.word_hashes([raw])
            tokens = raw.split()
            is_hot = dict(zip(wanted.as_py(), hot.as_py(), strict=True))
            done = set()
            prefix = words.run_hash(hashes)
            for mini, run, start, count in zip(*(x.tolist() for x in _runs(hashes, window, gram)), strict=True):
                if run not in is_hot or (mini, run) in done:
                    continue
                done.add((mini, run))
                if is_hot[run]:
                    for lo in range(0, count, SENT_ROWS):
                        at = np.arange(start + lo, start + min(lo + SENT_ROWS, count))
                        same: dict[tuple, list[int]] = {}  # equal windows of one run, as of a periodic text, travel once
                        for k, bucket in enumerate(_signed(words.run_of(prefix, at, at + window)).tolist(), lo):
                            same.setdefault((bucket, b" ".join(tokens[start + k : start + k + window])), []).append(k)
                        out += [(True, bucket, mini, run, places, doc, text) for (bucket, text), places in same.items()]
                        if len(out) > SENT_ROWS:
                            yield _rows(out, _PACKED)
                            out = []
                else:
                    out.append((False, mini, mini, run, None, doc, b" ".join(tokens[start : start + count + window - 1])))
                if len(out) > SENT_ROWS:
                    yield _rows(out, _PACKED)
                    out = []
        if out:
            yield _rows(out, _PACKED)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


_FOUND = pa.schema([("mini", pa.int64()), ("run", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("least", pa.int64())])


def _intervals(mini: int, run: int, some: list[tuple[int, int]]) -> list[tuple]:
    """(place, least document) of a run's windows to stretches of one least document."""
    some.sort()
    found = []
    lo = hi = some[0][0]
    low = some[0][1]
    for at, value in some[1:]:
        if value == low and at == hi + 1:
            hi = at
            continue
        found.append((mini, run, lo, hi, low))
        lo, hi, low = at, at, value
    return [*found, (mini, run, lo, hi, low)]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (mini, run, list of (least document, places)) to intervals."""
    for batch in batches:
        out = []
        for mini, run, told in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            out += _intervals(mini, run, [(k, x["least"]) for x in told for k in x["at"]])
        yield _rows(out, _FOUND)


def _count(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Packed strings sorted by bucket: the least document of each window, as runs of equal least documents."""

    def settle(held: list[tuple]) -> list[tuple]:
        placed, known = [], {}  # equal windows, as of a periodic text, share one string
        for n, (_, _, _, doc, packed) in enumerate(held):
            tokens = packed.split(b" ")
            for k in range(len(tokens) - window + 1):
                text = b" ".join(tokens[k : k + window])
                placed.append((known.setdefault(text, text), doc, n, k))
        del known
        placed.sort()
        least: list[list[tuple[int, int]]] = [[] for _ in held]
        text, low = None, 0
        for value, doc, n, at in placed:
            if value != text:
                text, low = value, doc
            least[n].append((at, low))
        return [row for (_, mini, run, *_), some in zip(held, least, strict=True) for row in _intervals(mini, run, some)]

    bucket, held, out = None, [], []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if row[0] != bucket and held:
                out += settle(held)
                held = []
                if len(out) > 20_000:
                    yield _rows(out, _FOUND)
                    out = []
            bucket = row[0]
            held.append(row)
    if held:
        out += settle(held)
    if out:
        yield _rows(out, _FOUND)


def _hot(placed: DataFrame) -> DataFrame:
    """Windows that travel one by one: the least document of each, by a partial aggregate, told to all its runs."""
    least = placed.groupBy("bucket", "packed").agg(F.min("doc").alias("least"))
    told = placed.join(least.hint("shuffle_merge"), ["bucket", "packed"]).groupBy("mini", "run").agg(F.collect_list(F.struct("least", "at")).alias("told"))
    return told.mapInArrow(_stretches, "mini long, run long, lo int, hi int, least long")


def _removed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Replace the columns (text, lo list, hi list) at the end by (kept text, n_words, n_removed)."""
    for batch in batches:
        n = batch.num_columns
        for at, texts in slices(batch.column(n - 3)):
            part = batch.slice(at, len(texts))
            kept, total, gone = [], [], []
            for text, lo, hi in zip(texts, part.column(n - 2), part.column(n - 1), strict=True):
                tokens = text.split()
                starts = lo.as_py()
                total.append(len(tokens))
                if starts:
                    edge = np.zeros(len(tokens) + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, hi.as_py(), -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    tokens = [t for t, s in zip(tokens, stay.tolist(), strict=True) if s]
                gone.append(total[-1] - len(tokens))
                kept.append(b" ".join(tokens).decode())
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n - 3)), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], schema=schema)


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, hot_runs: int = HOT_RUNS, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """``docs`` with (kept_text, n_words, n_removed): the words left, joined by single spaces, and their counts.

    Each row is judged on the input. Null text has no words. A null id is neither smaller nor greater than another:
    its row loses nothing and takes nothing away; rows of one id take nothing from each other, repeated rows are
    judged alike. A text of any length is read whole by one task, its windows a bucket at a time. Clashing column names
    get an underscore; an empty table gives no rows.
    """
    names = {n: fresh_name(docs, n) for n in ("doc_key", "tag_key", "kept_text", "n_words", "n_removed")}
    key, tag = names["doc_key"], names["tag_key"]
    source = docs.withColumns({key: F.col(doc_id).cast("long"), tag: F.xxhash64(text)})
    slim = source.select(F.col(key).alias("doc"), F.col(tag).alias("tag"), F.col(text).cast("string").alias("text"))
    runs = written(slim.where("doc is not null").mapInArrow(lambda parts: _all_runs(parts, window, gram), "mini long, run long, doc long, tag long, start int, count int"))
    load = (F.count("*") > hot_runs) | (F.sum("count") > hot_windows)
    shared = runs.groupBy("mini").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), load.alias("hot")).where("least < most").select("mini", "hot")
    known = written(runs.drop("count").join(shared.hint("shuffle_merge"), "mini"))
    dropped(runs)
    distinct = known.groupBy("mini", "run", "hot").agg(F.min("doc").alias("low"))
    wanted = distinct.groupBy(F.col("low").alias("doc")).agg(F.collect_list(F.struct("run", "hot")).alias("wanted"))
    asked = slim.join(wanted, "doc").select("doc", "text", F.col("wanted.run").alias("wanted"), F.col("wanted.hot").alias("hot"))
    cut = written(asked.mapInArrow(lambda parts: _cut(parts, window, gram), "hot boolean, bucket long, mini long, run long, at array<int>, doc long, packed binary"))

    # A bucket that is not hot holds HOT_RUNS strings and HOT_WINDOWS windows at most.
    dealt = cut.where("not hot").drop("hot", "at").repartition("bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(lambda parts: _count(parts, window), "mini long, run long, lo int, hi int, least long").union(_hot(cut.where("hot")))
    cover = written(
        known.join(found.hint("shuffle_merge"), ["mini", "run"])
        .where("least < doc")
        .select("doc", "tag", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + F.lit(window)).alias("hi"))
        .groupBy("doc", "tag")
        .agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    )
    dropped(known, cut)
    joined = source.join(cover.withColumnsRenamed({"doc": key, "tag": tag}), [key, tag], "left")
    columns = [F.col(c) for c in docs.columns]
    ready = joined.select(*columns, F.col(text).cast("string").alias("text_in"), "lo", "hi")
    fields = docs.select(*columns).schema
    for n, kind in (("kept_text", "string"), ("n_words", "long"), ("n_removed", "long")):
        fields = fields.add(names[n], kind)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)
    return ready.mapInArrow(lambda parts: _removed(parts, arrow), fields)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dedup_substrings(docs)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents)
), windows AS (
  SELECT doc_id, k, word, count(*) OVER frame AS size, md5(string_agg(word, ' ') OVER frame) AS sequence
  FROM words WINDOW frame AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), least AS (SELECT sequence, min(doc_id) AS first_doc FROM windows WHERE size = 50 GROUP BY 1
), starts AS (
  SELECT doc_id, k, word, CASE WHEN size = 50 AND first_doc < doc_id THEN 1 ELSE 0 END AS repeats FROM windows LEFT JOIN least USING (sequence)
), judged AS (
  SELECT doc_id, k, word, max(repeats) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM starts
), told AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (gone = 0) AS kept FROM judged GROUP BY 1
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN told USING (doc_id)
"""
