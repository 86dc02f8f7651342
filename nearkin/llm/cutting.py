"""Words of whole Arrow batches of text, cut at any set of separating bytes, as numpy arrays of places.

Separators are ASCII, so no character of UTF-8 is ever cut. A-Z are lowered first. No Python object is made per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from nearkin.llm.arrays import BASE, CHUNK_BYTES, STEP, mixed, text_bytes

_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A"): ord("Z") + 1] += 32
_byte_value = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


def byte_set(*members: int | range) -> np.ndarray:
    """A table that is true at these bytes."""
    table = np.zeros(256, bool)
    for m in members:
        table[list(m) if isinstance(m, range) else m] = True
    return table


@dataclass
class Spans:
    """Word i is data[start[i]:end[i]] (lowered); row r has words bound[r] to bound[r + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bound: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bound) - 1), np.diff(self.bound))


def cut(column: pa.Array, separators: np.ndarray) -> Spans:
    """The words of each row of a string column: runs of bytes that are no separators. Null counts as empty."""
    data, offsets = text_bytes(column)
    data = _lower[data]
    word = ~separators[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | fresh[1:-1]
    ends = word
    ends[:-1] &= ~word[1:] | fresh[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Spans(data, start, end, np.searchsorted(start, offsets))


def span_hashes(words: Spans) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, worked out in chunks of bounded size."""
    out = np.empty(len(words.start), np.uint64)
    first = 0
    while first < len(out):
        last = max(first + 1, int(np.searchsorted(words.end, words.start[first] + CHUNK_BYTES, "right")))
        start, length = words.start[first:last], words.end[first:last] - words.start[first:last]
        begin = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(begin, length)
        value = _byte_value[words.data[np.repeat(start, length) + place]]
        powers = np.multiply.accumulate(np.full(int(length.max()), STEP))
        out[first:last] = np.add.reduceat(value * powers[place], begin) + length.astype(np.uint64)
        first = last
    return mixed(out)
