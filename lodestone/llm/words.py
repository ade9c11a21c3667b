"""Words of whole Arrow batches as NumPy arrays: one pass over the bytes, no Python per word.

A word is a maximal run of bytes other than space and 0x09 to 0x0D; A-Z count as a-z. All functions take any number of
texts; null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20  # bytes of text worked on at a time; a longer text makes a chunk of its own
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all their bits (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salts(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _ODD)


_BYTE = salts(256, 1)[_LOWER]  # a number for each byte, the same for either case
_STRETCH = 1 << 14  # bytes hashed at a time
_INVERSE_ODD = np.uint64(pow(int(_ODD), -1, 1 << 64))
_POWERS, _INVERSE = (np.multiply.accumulate(np.full(_STRETCH + 1, x, dtype=np.uint64)) for x in (_ODD, _INVERSE_ODD))


def powers(n: int, of: np.uint64 = _ODD) -> np.ndarray:
    """At least ``n`` powers of an odd number."""
    return _POWERS if of == _ODD and n <= len(_POWERS) else np.multiply.accumulate(np.full(n, of, dtype=np.uint64))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and ``len(texts) + 1`` offsets into them."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about ``limit`` bytes together, as (first, end)."""
    _, offsets = flat(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, end
        at = end


@dataclass
class Words:
    """Words of ``n`` texts in order: first and end byte, text number, and first word of each text (``n + 1`` offsets)."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit number for each word, equal for equal words in any case of A-Z."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        out = np.empty(len(self.start), dtype=np.uint64)
        lo = 0
        while lo < len(out):
            # Stretches of words that stay in the cache, byte by byte; a long word makes a stretch of its own.
            at = self.start[lo]
            hi = max(lo + 1, int(np.searchsorted(self.end, at + _STRETCH, side="right")))
            start, end = self.start[lo:hi] - at, self.end[lo:hi] - at
            body = np.append(_BYTE[self.data[at : at + end[-1]]], _ODD)
            # Powers run on through the stretch; a word's are brought back to its first byte by the inverse.
            body *= powers(len(body))[: len(body)]
            edges = np.column_stack([start, end]).ravel()
            inverse = _INVERSE if len(body) <= _STRETCH + 1 else powers(len(body), _INVERSE_ODD)
            sums = np.add.reduceat(body, edges)[::2] * np.where(start > 0, inverse[start - 1], np.uint64(1))
            out[lo:hi] = mix(sums + (end - start).astype(np.uint64))
            lo = hi
        return out


def split(texts: pa.Array, space: np.ndarray = _SPACE) -> Words:
    """``space``: which of the 256 bytes part words."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(data, offsets, none, none, none, np.zeros(n + 1, dtype=np.int64))
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = space[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    inner = ~gap[1:-1]
    start = np.flatnonzero(inner & (gap[:-2] | edge[:-1]))
    end = np.flatnonzero(inner & (gap[2:] | edge[1:])) + 1
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(n), np.diff(first))
    return Words(data, offsets, start, end, text, first)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A number for each ``n`` words in a row (``len(hashes) - n + 1`` of them; texts are not kept apart)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for i, salt in enumerate(salts(n, 2) | np.uint64(1)):
        out += hashes[i : len(hashes) - n + 1 + i] * salt
    return mix(out)
