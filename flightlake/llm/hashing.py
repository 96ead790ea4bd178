"""Vectorised word hashing over Arrow text buffers (numpy, no Python object per word).

A word's hash is a polynomial over its bytes, read off a running sum: with
``H[i] = sum(T[b_j] * P**j, j < i)`` modulo 2**64, the word at ``[s, e)`` has
``(H[e] - H[s]) * P**-s``. P is odd, hence invertible. ``T`` holds a random
64-bit value per byte and the result goes through a finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240607)
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(members: bytes) -> np.ndarray:
    """A 256-entry flag table of the given bytes."""
    flags = np.zeros(256, bool)
    flags[np.frombuffer(members, np.uint8)] = True
    return flags


SPACE = byte_class(b" \t\n\x0b\x0c\r")
#: ASCII that is neither letter nor digit
SEPARATOR = ~byte_class(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW, _INV = _powers(BLOCK + 1, BASE), _powers(BLOCK + 1, _INVERSE)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser, in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _block_words(data: np.ndarray, breaks: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one block. ``breaks`` flags separator bytes."""
    n = len(data)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], breaks, [True])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    power, inverse = (_POW, _INV) if n <= BLOCK else (_powers(n + 1, BASE), _powers(n + 1, _INVERSE))
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE[low] * power[:n], out=run[1:])
    return starts, ends, mix((run[ends] - run[starts]) * inverse[starts])


def words(data: np.ndarray, separators: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of a byte array, in blocks cut at separators."""
    parts, at = [], 0
    flags = separators[data]
    low = LOWER[data] if lower else data
    while at < len(data):
        end = min(at + BLOCK, len(data))
        if end < len(data):
            back = np.flatnonzero(flags[at:end])
            if len(back):
                end = at + int(back[-1]) + 1
            else:  # a word longer than a block
                ahead = np.flatnonzero(flags[end:])
                end = end + int(ahead[0]) + 1 if len(ahead) else len(data)
        s, e, h = _block_words(data[at:end], flags[at:end], low[at:end])
        parts.append((s + at, e + at, h))
        at = end
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def rows_of(column: pa.Array) -> Iterator[np.ndarray]:
    """Each row's bytes as a uint8 view on the Arrow buffer; null rows are empty."""
    if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield raw[0:0] if nulls[i] else raw[at[i]: at[i + 1]]


def groups_of_rows(rows: list[np.ndarray], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes together (a longer row stands alone)."""
    start, total = 0, 0
    for i, r in enumerate(rows):
        if total and total + len(r) > most:
            yield start, i
            start, total = i, 0
        total += len(r) + 1
    if start < len(rows):
        yield start, len(rows)


def words_of_rows(column: pa.Array, separators: np.ndarray, lower: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of rows: the first row's index, the joined bytes, and starts, ends and hashes
    of words with ``counts`` of words per row: ``(first, data, (starts, ends, hashes), counts)``."""
    return words_of_views(list(rows_of(column)), separators, lower)


def words_of_views(rows: list[np.ndarray], separators: np.ndarray, lower: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """:func:`words_of_rows` of rows that are given as bytes."""
    gap = np.array([32], np.uint8)
    for a, b in groups_of_rows(rows):
        pieces = [x for r in rows[a:b] for x in (r, gap)]
        data = np.concatenate(pieces)
        s, e, h = words(data, separators, lower)
        limits = np.cumsum([len(r) + 1 for r in rows[a:b]])
        counts = np.diff(np.searchsorted(s, np.concatenate(([0], limits))))
        yield a, data, (s, e, h), counts


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    k = min(size, len(hashes))
    m = len(hashes) - k + 1
    h = hashes[:m] + np.uint64(k)
    for i in range(1, k):
        h *= np.uint64(BASE)
        h += hashes[i: i + m]
    return mix(h)


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(h) < 2:
        return h
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))]
