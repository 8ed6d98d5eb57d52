"""Hashes of words and word n-grams, inside tasks.

Words are hashed straight from the bytes of an Arrow column: every byte has a
random 64-bit value (A-Z those of a-z), a running sum of values times powers of
an odd base gives each word's polynomial as a difference, and a multiplication
by the inverse power of its start makes it independent of its place.
"""

from __future__ import annotations

import numpy as np

from pagelake.llm.common import WORD_SPACE

PART = 1 << 20  # bytes hashed together
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0xD1342543DE82EF97  # 3 modulo 4 after subtracting 1 has one factor of two


def _tables() -> tuple[np.ndarray, np.ndarray]:
    value = np.random.default_rng(20_240_601).integers(1, 1 << 64, size=256, dtype=np.uint64)
    value[ord("A"):ord("Z") + 1] = value[ord("a"):ord("z") + 1]
    space = np.zeros(256, bool)
    space[[ord(c) for c in WORD_SPACE]] = True
    value[space] = 0
    return value, space


VALUE, SPACE = _tables()
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse up to ``n``, remembered."""
    if len(_POWERS[0]) <= n:
        inverse = pow(_BASE, -1, 1 << 64)
        size = max(n, PART) + 1
        for k, base in enumerate((_BASE, inverse)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _part(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of ``data``; a word also ends at ``cuts``."""
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:-1]
    first, last = np.flatnonzero(start), np.flatnonzero(end)
    power, inverse = _powers(len(data))
    sums = np.cumsum(VALUE[data] * power[:len(data)], dtype=np.uint64)
    before = np.where(first > 0, sums[first - 1], np.uint64(0))
    return first, mix((sums[last] - before) * inverse[first])


def byte_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts laid end to end, and the number of words of each;
    text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""
    base, stop = int(offsets[0]), int(offsets[-1])
    starts, hashes = [], []
    at = base
    while at < stop:
        end = min(at + PART, stop)
        if end < stop:  # cut at the last white space or text border, or take the whole word
            gap = np.flatnonzero(SPACE[data[at:end]])
            border = offsets[np.searchsorted(offsets, end, side="right") - 1]
            end = max(at + int(gap[-1]) + 1 if len(gap) else at, int(border))
            if end <= at:
                more = np.flatnonzero(SPACE[data[at + PART:stop]])
                end = at + PART + int(more[0]) if len(more) else stop
                after = offsets[np.searchsorted(offsets, at, side="right"):]
                end = min(end, int(after[0])) if len(after) else end
        inside = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end, side="right")] - at
        first, h = _part(data[at:end], inside)
        starts.append(first + at)
        hashes.append(h)
        at = end
    first = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    sizes = np.diff(np.searchsorted(first, offsets))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), sizes.astype(np.int64)


def column_words(column) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of an Arrow text column and the words of each row (null:
    none)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return byte_words(np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), offsets)


def word_hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return byte_words(data, np.asarray([0, len(data)]))[0]


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n``-gram that starts at each position."""
    out = h[:len(h) - n + 1] + np.uint64(n)
    for j in range(1, n):
        out = (out ^ (out >> np.uint64(29))) * _M1 + h[j:len(h) - n + 1 + j]
    return mix(out)


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_sets(column, n: int) -> list[np.ndarray]:
    """For each row of an Arrow text column the sorted distinct hashes of its
    ``n``-word shingles; a shorter text is one shingle, a text without words
    has none."""
    h, sizes = column_words(column)
    grams = gram_hashes(h, n) if len(h) >= n else h[:0]
    out, at = [], 0
    for k in sizes.tolist():
        out.append(distinct(grams[at:at + k - n + 1]) if k >= n else gram_hashes(h[at:at + k], k) if k else h[:0])
        at += k
    return out
