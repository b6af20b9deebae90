"""Operator 2, packing: bounded-space online packing of token sequences.

Each task keeps ``OPEN_WINDOWS`` windows of 1024 tokens open. A piece goes into the window it fits best. When it fits
in none, the fullest window is topped up with the piece's head and emitted, and the rest is placed again; what a task
still has open at its end is merged until one window is not full. These leftovers of ``MERGE_TASKS`` tasks at a time
are merged once more, and what then remains is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm.common import SLICE_BYTES, checkpointed, table

WINDOW, OPEN_WINDOWS, MERGE_TASKS, END_ID = 1024, 32, 256, 0
#: Entries of a worker's word cache, about 100 MB, before a new generation begins; two are kept.
CACHE_WORDS = 400_000

_encoders: dict[str, Encoder] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable ones stand for themselves, others follow from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Words(dict):
    """Ids by word; a new word is learnt as it is asked for."""

    def __init__(self, learn):
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        return self.learn(word)


class Encoder:
    """Ids of byte-level BPE texts, word by word through a cache.

    The pre-tokenizer always cuts before a space that stands between two non-space characters, so such pieces have
    ids of their own, whatever surrounds them. Texts in which a space is followed by white space or the end are
    encoded whole. It also cuts between letters, other signs and a single line break, so a new piece of such runs that
    starts with a letter is put together from theirs. Others wait for the end of the slice, are encoded together and told
    apart by the byte lengths of their tokens.
    """

    _odd = re.compile("  | [\t\n\v\f\r\x1c-\x1f\x85\xa0  -     　]| $")

    #: Runs of letters, of ASCII signs but the apostrophe (which may start a contraction), and a line break.
    _runs = re.compile(r"[^\W\d_]+|[!-&(-/:-@\[-`{-~]+|\n")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self.letters, self.tokenize = byte_letters(), self.tokenizer.model.tokenize
        self.space = self.letters[32]
        self.cache = _Words(self._learnt)
        self.late: list[str] = []  # new words for the library
        self.older: dict[str, bytes] = {}  # the generation before; words still in use move on
        self.bare: dict[str, bytes] = {}  # runs with no space before them
        self.packs = [struct.Struct(f"<{n}I").pack for n in range(64)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _run(self, run: str, space: str = "") -> bytes:
        """Ids of one piece of the pre-tokenizer, which the model can take as it is; ``space``: the letter of one before it."""
        shown = run if run.isascii() and run != "\n" else run.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenize(space + shown)]
        return self.packs[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}I", *ids)

    def _joined(self, word: str) -> bytes | None:
        """Ids of a piece that starts with a letter and consists of runs; else None."""
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            runs = [word[:-1], word[-1]]
        else:
            runs = self._runs.findall(word)
            if len(runs) < 2 or not runs[0].isalpha() or runs[-1] == "\n" or "\n\n" in word or "".join(runs) != word:
                return None
            if not word.isascii() and not all(r.isalpha() for r in runs if not r.isascii()):
                return None
        out, bare = [self.cache[runs[0]]], self.bare
        for run in runs[1:]:
            ids = bare.get(run)
            if ids is None:
                if len(bare) >= CACHE_WORDS:
                    bare.clear()
                ids = bare[run] = self._run(run)
            out.append(ids)
        return b"".join(out)

    def _learnt(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._run(word, self.space) if word.isalpha() else self._joined(word)
            if ids is None:
                self.late.append(word)
                return b""
        self.cache[word] = ids
        return ids

    def _learn(self, words: list[str]) -> None:
        """By the library."""
        for k in range(0, len(words), 20_000):
            some = words[k : k + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(self.bytes_of[ids])
            want = np.cumsum([len(w.encode()) + 1 for w in some])
            cut = np.searchsorted(ends, want)
            if len(ids) and (cut < len(ends)).all() and (ends[cut] == want).all():
                raw, at = ids.tobytes(), [0, *((cut + 1) * 4).tolist()]
                self.cache.update((w, raw[at[i] : at[i + 1]]) for i, w in enumerate(some))
            else:
                self.cache.update(zip(some, self._whole([" " + w for w in some]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        parts = [None if self._odd.search(t) else t.split(" ") for t in texts]
        whole = iter(self._whole([t if p is None else p.pop(0) for t, p in zip(texts, parts, strict=True)]))
        if len(self.cache) > CACHE_WORDS:
            self.older, self.cache = self.cache, _Words(self._learnt)
        ids, late, out, again = self.cache.__getitem__, self.late, [], []
        for n, p in enumerate(parts):
            known = len(late)
            head = next(whole)
            out.append(head + b"".join(map(ids, p)) if p else head)
            if len(late) > known:
                again.append((n, head))
        if late:
            self._learn(list(set(late)))
            late.clear()
            for n, head in again:
                out[n] = head + b"".join(map(ids, parts[n]))
        return out


class Packer:
    """Open windows of one task. A piece is (doc_id, start, ids as bytes, tokens of its document)."""

    def __init__(self, window: int, most: int, emit):
        self.window, self.most, self.emit = window, most, emit
        self.open: list[tuple[list, int]] = []  # pieces, room left

    @staticmethod
    def cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
        doc, start, ids, total = piece
        return (doc, start, ids[: 4 * n], total), (doc, start + n, ids[4 * n :], total)

    @staticmethod
    def own(piece: tuple) -> tuple:
        return (*piece[:2], bytes(piece[2]), piece[3])

    def add(self, piece: tuple) -> None:
        """A long piece is cut through a view, so its rest is not copied for every window; open windows own their bytes."""
        piece = (*piece[:2], memoryview(piece[2]), piece[3])
        while True:
            length = len(piece[2]) // 4
            if length > self.window:
                head, piece = self.cut(piece, self.window)
                self.emit([head])
                continue
            fit = min((i for i, (_, room) in enumerate(self.open) if room >= length), key=lambda i: self.open[i][1], default=None)
            if fit is not None:
                held, room = self.open[fit]
                held.append(self.own(piece))
                self.open[fit] = (held, room - length)
                if room == length:
                    self.emit(self.open.pop(fit)[0])
                return
            if len(self.open) < self.most:
                if length == self.window:
                    self.emit([piece])
                else:
                    self.open.append(([self.own(piece)], self.window - length))
                return
            fullest = min(range(len(self.open)), key=lambda i: self.open[i][1])
            held, room = self.open.pop(fullest)
            head, piece = self.cut(piece, room)
            self.emit([*held, head])

    def merge(self) -> list:
        """Fill the fullest windows from the emptiest; the pieces of the one that stays open."""
        rest = sorted(self.open, key=lambda w: w[1])
        self.open = []
        while len(rest) > 1:
            held, room = rest.pop(0)
            while room and rest:
                source, free = rest.pop()
                piece = source.pop()
                length = len(piece[2]) // 4
                if length > room:
                    piece, tail = self.cut(piece, room)
                    source.append(tail)
                    length = room
                held.append(piece)
                room -= length
                if source:
                    rest.append((source, free + length))
            if room:
                rest.append((held, room))
            else:
                self.emit(held)
        return rest[0][0] if rest else []

    def halve(self, pieces: list) -> None:
        """Emit pieces as sequences whose lengths are powers of two."""
        left = sum(len(p[2]) // 4 for p in pieces)
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            held = []
            while room:
                piece = pieces.pop(0)
                if len(piece[2]) // 4 > room:
                    piece, tail = self.cut(piece, room)
                    pieces.insert(0, tail)
                held.append(piece)
                room -= len(piece[2]) // 4
            self.emit(held)


_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, task long, open boolean"
_TYPES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("task", pa.int64()), ("open", pa.bool_())])


class _Output:
    """Collects emitted sequences as rows; ``odd`` tells the second round's sequence ids from the first's."""

    def __init__(self, task: int, odd: int):
        self.task, self.odd, self.count = task, odd, 0
        self.rows: list[tuple] = []

    def emit(self, pieces: list, is_open: bool = False) -> None:
        number, at = (self.task << 32) + 2 * self.count + self.odd, 0
        self.count += 1
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids) // 4, bytes(ids), total, number, at, self.task, is_open))
            at += len(ids) // 4

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(_TYPES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES.types, strict=True)], schema=_TYPES)


def _tokenised(batches: Iterator[pa.RecordBatch], path: str, window: int, most: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoders.setdefault(path, None) or Encoder(path)
    _encoders[path] = encoder
    out = _Output(TaskContext.get().partitionId(), 0)
    packer, end = Packer(window, most, out.emit), np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            docs, texts, size = [], [], 0
            while at < batch.num_rows and (not texts or size < SLICE_BYTES):
                texts.append(batch.column(1)[at].as_py() or "")
                docs.append(batch.column(0)[at].as_py())
                size += len(texts[-1])
                at += 1
            for doc, ids in zip(docs, encoder.encode(texts), strict=True):
                ids += end
                packer.add((doc, 0, ids, len(ids) // 4))
            yield out.batch()
    out.emit(packer.merge(), is_open=True)
    yield out.batch()


def _merged(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Leftovers sorted by (grp, task, offset): merged per grp."""
    group, packer, out, task = None, None, None, None

    def finish():
        packer.halve(packer.merge())
        return out.batch()

    for batch in batches:
        for doc, start, ids, total, of_task, grp in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if grp != group:
                if packer:
                    yield finish()
                group, task, out = grp, None, _Output(grp, 1)
                packer = Packer(window, 0, out.emit)
            if of_task != task:
                packer.open.append(([], window))
                task = of_task
            held, room = packer.open[-1]
            held.append((doc, start, ids, total))
            packer.open[-1] = (held, room - len(ids) // 4)
    if packer:
        yield finish()


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", derived: dict[str, Column] | None = None, keep_ids: bool = True, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """Pieces of packed sequences: (doc_id, start, length, ids binary, doc_tokens, sequence_id, offset, *derived).

    Null texts are empty and so are one end id; rows with equal or null doc_id are documents of their own. A text of any
    length is encoded whole and cut in time proportional to it; other columns are ignored, whatever their names. An empty
    table gives no pieces. Padding is zero: every sequence has ``window`` (a power of two) tokens or another power of two. ``derived`` are columns over
    a piece's own columns (ids: little-endian unsigned 32-bit). With ``keep_ids`` false only the leftovers' ids are
    written between the rounds and ``ids`` is not returned. sequence_id is unique, not dense.
    """
    derived = derived or {}
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    first = source.mapInArrow(lambda parts: _tokenised(parts, tokenizer, window, open_windows), _SCHEMA)
    kept = F.col("ids") if keep_ids else F.when(F.col("open"), F.col("ids"))
    level = checkpointed(first.withColumns(derived).withColumn("ids", kept))
    group = F.floor(F.col("task") / F.lit(MERGE_TASKS)).cast("long")
    left = level.where("open").select("doc_id", "start", "ids", "doc_tokens", "task", group.alias("grp"), "offset")
    dealt = left.repartition("grp").sortWithinPartitions("grp", "task", "offset").select("doc_id", "start", "ids", "doc_tokens", "task", "grp")
    second = dealt.mapInArrow(lambda parts: _merged(parts, window), _SCHEMA).withColumns(derived)
    columns = ["doc_id", "start", "length", *(["ids"] if keep_ids else []), "doc_tokens", "sequence_id", "offset", *derived]
    return level.where("not open").select(*columns).union(second.select(*columns))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), tokenizer_path(), derived={"ids_crc32": F.crc32("ids").cast("long")}, keep_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
