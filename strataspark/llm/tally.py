"""Counts of 64-bit keys over a whole corpus, told back to the slices of documents that hold them.

A slice sends each of its distinct keys once, packed by bucket of the hash range; a bucket adds up what all slices sent
and answers each of them in its own order. Keys travel with as many low bytes as keep chance collisions inside a bucket
rare; two keys that collide share one count, so a count is a function of its key and never too small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Keys of the corpus for each slice of documents and each bucket of the hash range, about.
SLICE_KEYS = 1_000_000
#: Low bytes of a key that travel. With the bucket's number they make 20 bits more than the corpus's keys need.
KEY_BYTES = -(-(SLICE_KEYS.bit_length() + 20) // 8)

SENT = "slice long, bucket long, keys binary, counts binary"
ANSWER = "slice long, bucket long, counts binary"
_SENT = pa.schema([("slice", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("slice", pa.int64()), ("bucket", pa.int64()), ("counts", pa.binary())])


def pack(counts: np.ndarray) -> bytes:
    """A byte for each count; those from 255 follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def unpack(raw: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", offset=n)
    return counts


def runs(keys: np.ndarray, buckets: int) -> tuple[list[int], list[int]]:
    """The buckets that sorted keys fall into, and where each of them starts, with the end. Buckets without keys cost nothing."""
    own = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    start = np.flatnonzero(np.concatenate((np.ones(min(1, len(own)), bool), own[1:] != own[:-1])))
    return own[start].tolist(), [*start.tolist(), len(keys)]


def sent(name: int | None, keys: np.ndarray, counts: np.ndarray | None, buckets: int) -> pa.Table:
    """A slice's sorted distinct keys by bucket; no counts: only asking, no name: only telling."""
    own, edge = runs(keys, buckets)
    raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    rows = [(name, k, raw[a:b].tobytes(), None if counts is None else pack(counts[a:b])) for k, a, b in zip(own, edge, edge[1:], strict=False)]
    return pa.Table.from_arrays([pa.array([r[c] for r in rows], _SENT.types[c]) for c in range(4)], schema=_SENT)


def answered(part: pa.Table) -> pa.Table:
    """A bucket's keys added up over all slices; each slice that asks gets the sums of its own, in its order."""
    keys, counts = part.column("keys").to_pylist(), part.column("counts").to_pylist()
    ends = np.cumsum([0, *(len(k) // KEY_BYTES for k in keys)]).tolist()
    wide = np.zeros((ends[-1], 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY_BYTES)
    _, at = np.unique(wide.view("<u8").ravel(), return_inverse=True)
    n = np.concatenate([np.zeros(b - a, np.int64) if c is None else unpack(c, b - a) for a, b, c in zip(ends, ends[1:], counts, strict=False)])
    total = np.bincount(at, n).astype(np.int64)
    rows = [(s, b, pack(total[at[i:j]])) for s, b, i, j in zip(part.column("slice").to_pylist(), part.column("bucket").to_pylist(), ends, ends[1:], strict=False) if s is not None]
    return pa.Table.from_arrays([pa.array([r[c] for r in rows], _ANSWER.types[c]) for c in range(3)], schema=_ANSWER)


def told(answers: pa.Table, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The corpus counts of a slice's sorted distinct keys."""
    (own, edge), said = runs(keys, buckets), dict(zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist(), strict=True))
    return np.concatenate([np.zeros(0, np.int64), *(unpack(said[k], b - a) for k, a, b in zip(own, edge, edge[1:], strict=False))])
