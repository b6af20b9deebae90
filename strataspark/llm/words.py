"""Vectorised word and n-gram hashes over UTF-8 texts (numpy), with the word definition of every contract.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D. Hashes are 64-bit polynomials over the bytes,
finished by a bijective mixer. They serve as keys; where a contract asks for exact equality, strings are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64: a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constant(i: int) -> np.uint64:
    """An odd multiplier for place ``i``."""
    return mix(np.array([(i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF], np.uint64))[0] | np.uint64(1)


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            run = np.full(size, np.uint64(base), np.uint64)
            run[0] = 1
            _powers[k] = np.cumprod(run, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _letters_only(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds without outer bytes that are no letter (bytes from 128 on count as letters); words without any go."""
    low = buf | 32
    letter = (buf >= 128) | (low >= 97) & (low <= 122)
    at = np.arange(len(buf))
    following = np.minimum.accumulate(np.where(letter, at, len(buf))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(letter, at, -1))
    begin, end = following[begin], before[end - 1] + 1
    some = begin < end
    return begin[some], end[some]


def word_hashes(texts: list[bytes], lower: bool = False, letters: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the places where each text's words start (one more than texts).

    ``lower``: A-Z count as a-z. ``letters``: outer bytes that are no letter are left out, and words of none.
    """
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    if letters and len(begin):
        begin, end = _letters_only(buf, begin, end)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.concatenate(([0], np.searchsorted(begin, text_ends)))
    if not len(begin):
        return np.zeros(0, np.uint64), first
    up, down = _pow(len(buf))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(((_LOWER[buf] if lower else buf).astype(np.uint64) + np.uint64(1)) * up)))
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64)), first


#: Bytes that ``lowered`` hashes at once, unless a single text is longer, so that they stay in a core's cache.
CACHED_BYTES = 1 << 16


def lowered(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The bytes of some texts at a time, where each word begins and ends there, and their ``word_hashes`` with ``lower``."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text) + 1
        if k + 1 < len(texts) and size + len(texts[k + 1]) < CACHED_BYTES:
            continue
        some, start, size = texts[start : k + 1], k + 1, 0
        buf = np.frombuffer(b"\n".join(some) + b"\n", np.uint8)
        space = np.ones(len(buf) + 1, bool)
        space[1:] = (buf == 32) | (buf - np.uint8(9) < 5)
        edge = np.flatnonzero(space[1:] != space[:-1])
        begin, end = edge[0::2], edge[1::2]
        first = np.concatenate(([0], np.searchsorted(begin, np.cumsum([len(t) + 1 for t in some]))))
        up, down = _pow(len(buf))
        value = (buf | (buf - np.uint8(65) < 26).view(np.uint8) << 5).astype(np.uint64)
        value += np.uint64(1)
        value *= up
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(value, out=total[1:])
        yield buf, begin, end, mix((total.take(end) - total.take(begin)) * down.take(begin) + (end - begin).astype(np.uint64)), first


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (none where there are fewer)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, constant(1000 + n), np.uint64)
    for j in range(n):
        total += words[j : j + count] * constant(j)
    return mix(total)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def run_hash(words: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences, divided by a power, name any run of words: see ``run_of``."""
    up, _ = _pow(len(words) + 1)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5)) * up[: len(words)])))


def run_of(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of words[start:end], equal for equal runs wherever they stand."""
    _, down = _pow(len(prefix) + 1)
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * constant(77))
