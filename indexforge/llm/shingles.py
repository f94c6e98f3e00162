"""Word shingles of whole texts as 64-bit hashes, vectorised over a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
_RNG = np.random.default_rng(20260)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_K = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of the first word of every text and of the end)."""
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] |= word[inner]
    last[inner - 1] |= word[inner - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    h, left = np.zeros(len(s), np.uint64), np.arange(len(s))
    at, n = s.copy(), e - s
    j = 0
    while len(left):
        h[left] = h[left] * _K + _BYTE[data[at]]
        j += 1
        more = n > j
        left, at, n = left[more], at[more] + 1, n[more]
    return mix(h + (e - s).astype(np.uint64)), np.searchsorted(s, offsets)


def _chain(w: list[np.ndarray]) -> np.ndarray:
    h = mix(w[0] + np.uint64(len(w)))
    for x in w[1:]:
        h = mix(h * _K + x)
    return h


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty."""
    a = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    buf = a.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a string column."""
    data, offsets = texts_of(column)
    if not len(data):
        return [np.zeros(0, np.uint64)] * len(column)
    w, at = _words(data, offsets)
    m = max(0, len(w) - WIDTH + 1)
    h = _chain([w[k:m + k] for k in range(WIDTH)])
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= WIDTH:
            out.append(np.unique(h[a:b - WIDTH + 1]))
        else:
            out.append(_chain([w[i:i + 1] for i in range(a, b)]) if b > a else np.zeros(0, np.uint64))
    return out
