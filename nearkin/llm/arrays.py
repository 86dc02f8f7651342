"""Words and hashes of whole Arrow batches of text as numpy arrays.

A word is a run of bytes other than 0x20 and 0x09-0x0D. No Python object is made per word.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A"): ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_byte_value = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


@dataclass
class Words:
    """All words of a batch: word i is data[start[i]:end[i]]; document d has words bound[d] to bound[d + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bound: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bound) - 1), np.diff(self.bound))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """Words of each row of a string column and a 64-bit hash of each word's bytes (A-Z lowered if asked)."""
    data, offsets = text_bytes(column)
    word = ~_space[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | fresh[1:-1]
    ends = word
    ends[:-1] &= ~word[1:] | fresh[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    del word, begins, ends, fresh
    out = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):  # in chunks, so that eight bytes per byte of text are never needed for all of it
        last = max(first + 1, int(np.searchsorted(end, start[first] + CHUNK_BYTES, "right")))
        lo, hi = start[first], end[last - 1]
        piece = data[lo:hi]
        value = _byte_value[_lower[piece]] if lower else _byte_value[piece]
        length = end[first:last] - start[first:last]
        powers = np.multiply.accumulate(np.full(int(length.max()), STEP))
        gap = np.empty(len(length), np.int64)
        gap[:-1] = start[first + 1: last] - start[first: last - 1]
        gap[-1] = hi - start[last - 1]
        place = np.arange(hi - lo) - np.repeat(start[first:last] - lo, gap)
        held = place < np.repeat(length, gap)
        value[~held] = 0
        value *= powers[np.minimum(place, len(powers) - 1)]
        out[first:last] = np.add.reduceat(value, start[first:last] - lo)
        first = last
    out += (end - start).astype(np.uint64)
    return Words(data, start, end, mixed(out), np.searchsorted(start, offsets))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive entries; the last n - 1 positions have none. Costs log n passes."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    done, width, power, span, factor = None, 0, hashes, 1, np.full(1, STEP)
    rest, total = n, len(hashes)
    while rest:
        if rest & 1:
            if done is None:
                done, width = power, span
            else:
                length = total - width - span + 1
                done = done[:length] * factor + power[width: width + length]
                width += span
        rest >>= 1
        if rest:
            length = total - 2 * span + 1
            power = power[:length] * factor + power[span: span + length]
            factor = factor * factor
            span *= 2
    return mixed(done[: total - n + 1].copy())


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every n consecutive values."""
    span, best = 1, values
    while span * 2 <= n:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    return np.minimum(best[: len(best) - (n - span)], best[n - span:]) if n > span else best


def slices(batch: pa.RecordBatch, text: int, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts (column number `text`) hold about max_bytes, one row at least."""
    if batch.num_rows == 0:
        return
    _, offsets = text_bytes(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def give_back() -> None:
    """Hands free memory back to the system. Workers are kept for later tasks and share a machine with their executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A function for mapInArrow that gives memory back when its task ends."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
