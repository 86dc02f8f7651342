"""Numpy helpers that work on one Arrow batch inside a task."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from nearkin.functions.hashing import md5_number_of

MERSENNE_31 = (1 << 31) - 1  # prime; also the minimum of an empty document
SHINGLE_BASE = 1_000_003  # multiplier that folds the words of a shingle into one number
TIE = 1e-9  # numbers closer than this, in proportion to what they are made of, count as equal
TIE_DIGITS = 9  # scores that agree to so many significant digits count as equal
UNROLLED = 2_000_000
CACHED_CELLS = 1 << 16  # of a matrix of doubles that several steps go over
DENSE_GAIN = 300  # a word goes into the matrix product if at least one in so many pairs shares it
DENSE_WORDS = 2_048
PIECE_ITEMS = 1 << 18  # list items that are worked on at a time


def pieces(batch: pa.RecordBatch, column: int | str, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose lists hold about PIECE_ITEMS items together, and so many rows at most; a longer list is a
    slice of its own. What a task holds beside its batch stays the same, however many rows Spark sends at once."""
    held = pc.fill_null(pc.list_value_length(batch.column(column)), 0)
    ends = np.cumsum(np.asarray(held, np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(int(np.searchsorted(ends, before + PIECE_ITEMS, "right")), at + 1)
        end = min(end, at + rows) if rows else end
        yield batch.slice(at, end - at)
        at = end


def matrix(column: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """Rows of an Arrow list column as a dense matrix; all rows must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) == 0:
        return np.zeros((0, 0), dtype)
    width, rest = divmod(len(flat), len(column))
    if rest or np.any(np.diff(np.asarray(column.offsets)) != width):
        raise ValueError("vectors of different length in one column")
    return flat.reshape(len(column), width).astype(dtype, copy=False)


def packed_column(values: np.ndarray) -> pa.Array:
    """The rows of a matrix of doubles as bytes; cheaper to pass through Spark than lists."""
    values = np.ascontiguousarray(values, np.float64)
    rows, width = values.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * (width * 8)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The matrix behind a column of `packed_column`."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(np.float64)
    return flat.reshape(len(column), -1)


def list_column(values: np.ndarray, arrow_type: pa.DataType) -> pa.ListArray:
    """The rows of a matrix as an Arrow list column."""
    rows, width = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), arrow_type))


# ---------------------------------------------------------------- MinHash

def minhash_constants(num_perm: int, seed: int = 1) -> tuple[list[int], list[int]]:
    """Factors and summands of the hash functions x -> (a*x + b) mod p.

    A longer list starts with the shorter one, so a signature of 512 numbers starts with the
    signature of 128.
    """
    a = [1 + md5_number_of(f"{seed}:a:{i}") % (MERSENNE_31 - 1) for i in range(num_perm)]
    b = [md5_number_of(f"{seed}:b:{i}") % MERSENNE_31 for i in range(num_perm)]
    return a, b


def word_numbers(words: pa.Array) -> np.ndarray:
    """The first 32 bits of md5(word) mod p; each distinct word of the batch is hashed once."""
    coded = words.dictionary_encode()
    numbers = np.fromiter(
        (int.from_bytes(hashlib.md5(w.encode("utf-8")).digest()[:4], "big") % MERSENNE_31
         for w in coded.dictionary.to_pylist()),
        np.uint64,
        len(coded.dictionary),
    )
    return numbers[coded.indices.to_numpy(zero_copy_only=False)]


def shingle_numbers(words: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """One number per shingle, and the row each shingle belongs to."""
    prime, base = np.uint64(MERSENNE_31), np.uint64(SHINGLE_BASE)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    length = lengths[row]
    # a full document has a shingle at every place with n words left, a short one at its start
    taken = np.flatnonzero(np.where(length >= n, place <= length - n, place == 0))
    row, length = row[taken], length[taken]
    folded = np.ones(len(taken), np.uint64)
    for step in range(n):
        inside = length > step
        at = taken[inside] + step
        folded[inside] = (folded[inside] * base + words[at]) % prime
    return folded, row


def minhash(numbers: np.ndarray, row: np.ndarray, rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Column i holds the smallest (a_i*x + b_i) mod p of each row; p itself for an empty row."""
    prime, shift = np.uint64(MERSENNE_31), np.uint64(31)
    short_prime, short_shift, one = np.uint32(MERSENNE_31), np.uint32(31), np.uint32(1)
    out = np.full((rows, len(a)), MERSENNE_31, np.int32)
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    # pieces of whole rows, small enough to stay in the processor cache
    piece = np.searchsorted(starts, np.arange(0, len(numbers), 1 << 14), "left")
    piece = np.unique(np.append(piece, len(starts)))
    for first, last in zip(piece[:-1], piece[1:]):
        begin = starts[first]
        end = starts[last] if last < len(starts) else len(numbers)
        x, cuts = numbers[begin:end], starts[first:last] - begin
        v, w = np.empty_like(x), np.empty_like(x)
        short, carry = np.empty(len(x), np.uint32), np.empty(len(x), np.uint32)
        least = np.empty((len(a), len(cuts)), np.uint32)
        for i in range(len(a)):
            np.multiply(x, a[i], out=v)
            v += b[i]
            # v mod 2^31-1 without a division: both halves together are less than twice the prime and fit 32 bits
            np.right_shift(v, shift, out=w)
            v &= prime
            np.add(v, w, out=short, casting="unsafe")
            np.add(short, one, out=carry)
            carry >>= short_shift
            short += carry
            short &= short_prime
            np.minimum.reduceat(short, cuts, out=least[i])
        out[row[starts[first:last]]] = least.T
    return out


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = signatures[:, : bands * rows].astype(np.uint64).reshape(len(signatures), bands, rows)
    key = np.full(parts.shape[:2], 0x9E3779B97F4A7C15, np.uint64)
    for at in range(rows):
        key = (key ^ parts[:, :, at]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return key


class BandIndex:
    """Bucket keys of queries (queries x bands), sorted band by band."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, axis=0, kind="stable")
        self.sorted = np.take_along_axis(keys, self.order, axis=0)

    def pairs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all queries and rows that share a bucket of some band, each pair once."""
        rows, found = len(keys), [np.zeros(0, np.int64)]
        for band in range(keys.shape[1]):
            own = self.sorted[:, band]
            first, last = (np.searchsorted(own, keys[:, band], side) for side in ("left", "right"))
            hit = np.flatnonzero(last > first)
            many = last[hit] - first[hit]
            place = np.repeat(first[hit] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            found.append(self.order[place, band] * rows + np.repeat(hit, many))
        return np.divmod(np.unique(np.concatenate(found)), max(rows, 1))


class PairJaccard:
    """Jaccard similarity of given pairs of word sets; queries are the sets given first."""

    def __init__(self, queries: pa.Array):
        self.sizes = np.diff(np.asarray(queries.offsets)).astype(np.int64)
        coded = queries.flatten().dictionary_encode()
        self.words = coded.dictionary
        self.stride = max(len(self.words), 1)
        holder = np.repeat(np.arange(len(queries)), self.sizes)
        self.held = np.sort(holder * self.stride + coded.indices.to_numpy(zero_copy_only=False))

    def __call__(self, query: np.ndarray, row: np.ndarray, corpus: pa.Array) -> np.ndarray:
        sizes = np.diff(np.asarray(corpus.offsets)).astype(np.int64)
        found = pc.fill_null(pc.index_in(corpus.flatten(), value_set=self.words), -1).to_numpy()
        begin = np.cumsum(sizes) - sizes
        shared = np.zeros(len(query))
        load = np.cumsum(sizes[row])
        cuts = np.searchsorted(load, np.arange(1, (load[-1] if len(load) else 0) // UNROLLED + 1) * UNROLLED)
        for piece in np.split(np.arange(len(query)), cuts):  # some millions of words at a time
            many = sizes[row[piece]]
            word = found[np.repeat(begin[row[piece]] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            owner = np.repeat(np.arange(len(piece)), many)[word >= 0]
            key = query[piece][owner] * self.stride + word[word >= 0]
            at = np.minimum(np.searchsorted(self.held, key), max(len(self.held) - 1, 0))
            hit = self.held[at] == key if len(self.held) else np.zeros(len(key), bool)
            shared[piece] = np.bincount(owner[hit], minlength=len(piece))
        union = self.sizes[query] + sizes[row] - shared
        return np.divide(shared, union, out=np.zeros(len(query)), where=union > 0)


# ---------------------------------------------------------------- vectors

def unit_rows(vectors: np.ndarray) -> np.ndarray:
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def hyperplanes(n_bits: int, dim: int, seed: int = 42) -> np.ndarray:
    """Standard normal plane normals, rounded to float32 like the stored vectors."""
    return np.random.RandomState(seed).randn(n_bits, dim).astype("float32").astype("float64")


def nearest_centre(block: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre; the lowest one within the tie width, which grows with the vectors."""
    return nearest_with_distance(block, centres)[0]


def nearest_with_distance(block: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre and the squared distance of the nearest one, through one matrix that is changed in place:
    of so many rows at a time that it stays in the processor cache."""
    lengths, sizes = np.einsum("ij,ij->i", block, block), np.einsum("ij,ij->i", centres, centres)
    turned, slack = -2.0 * centres.T, TIE * sizes
    code, least = np.zeros(len(block), np.int64), np.zeros(len(block))
    step = max(1, CACHED_CELLS // max(len(centres), 1))
    for at in range(0, len(block), step):
        apart = block[at: at + step] @ turned
        apart += sizes  # the squared distance without the row's own length
        least[at: at + step] = apart.min(axis=1)
        apart -= slack
        code[at: at + step] = np.argmax(apart <= (least[at: at + step] + TIE * lengths[at: at + step])[:, None], axis=1)
    return code, np.maximum(least + lengths, 0.0)


def sums_by_code(rows: np.ndarray, code: np.ndarray, codes: int) -> np.ndarray:
    """How many rows have each code, and the sum of these rows: an array (codes, 1 + width)."""
    out = np.zeros((codes, 1 + rows.shape[1]))
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.diff(code[order], prepend=-1))
    there = code[order][first]
    out[there, 0] = np.diff(np.append(first, len(order)))
    if len(there):
        out[there, 1:] = np.add.reduceat(rows[order], first, axis=0)
    return out


def uniform(number: np.ndarray, *salt: int) -> np.ndarray:
    """A number in [0, 1) for each 64-bit number, the same on any partitioning."""
    x = number.view(np.uint64).copy()
    for value in (0, *salt):
        x += np.uint64(0x9E3779B97F4A7C15 * (value + 1) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def nearest_codes(vectors: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
    """Codes of every row, one per sub-space; codebooks has the shape (m, ks, width)."""
    m, _, width = codebooks.shape
    if vectors.shape[1] != m * width:
        raise ValueError(f"vectors of length {vectors.shape[1]} do not fit {m} x {width} codebooks")
    codes = np.empty((len(vectors), m), np.int32)
    for part in range(m):
        codes[:, part] = nearest_centre(vectors[:, part * width:(part + 1) * width], codebooks[part])
    return codes


def distance_tables(queries: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
    """Squared distance of each query's sub-vectors to all centres, shape (queries, m, ks)."""
    m, ks, width = codebooks.shape
    parts = queries.reshape(len(queries), m, 1, width)
    return ((codebooks[None] - parts) ** 2).sum(axis=3)


# ---------------------------------------------------------------- scorers
# Built from the queries' Arrow column, called with a piece of the corpus' column: one row per
# query, one column per corpus row, higher is better. `digits` says when scores count as equal.

class CosineScorer:
    digits = TIE_DIGITS

    def __init__(self, queries: pa.Array):
        self.queries = unit_rows(matrix(queries))

    def __call__(self, corpus: pa.Array) -> np.ndarray:
        return self.queries @ unit_rows(matrix(corpus)).T


class InnerProductScorer:
    digits = TIE_DIGITS

    def __init__(self, queries: pa.Array):
        self.queries = matrix(queries)

    def __call__(self, corpus: pa.Array) -> np.ndarray:
        return self.queries @ matrix(corpus).T


class CodeDistanceScorer:
    """Negated distance between queries and coded rows, summed from the distance tables."""

    digits = TIE_DIGITS

    def __init__(self, queries: pa.Array, codebooks: np.ndarray):
        self.tables = np.ascontiguousarray(distance_tables(matrix(queries), codebooks).transpose(1, 0, 2))

    def __call__(self, corpus: pa.Array) -> np.ndarray:
        codes = matrix(corpus, np.int64)
        total = np.zeros((self.tables.shape[1], len(codes)))
        for part, table in enumerate(self.tables):
            total -= np.take(table, codes[:, part], axis=1)
        return total


class JaccardScorer:
    """Jaccard similarity of sets of words. Shared words are counted in two ways: those that many queries and many rows have
    by a matrix product of zeros and ones, all others through the lists of queries that hold a word."""

    digits = None  # a division of two counts is the same number everywhere

    def __init__(self, queries: pa.Array):
        self.sizes = np.diff(np.asarray(queries.offsets)).astype(np.int64)
        coded = queries.flatten().dictionary_encode()
        self.words = coded.dictionary
        word = coded.indices.to_numpy(zero_copy_only=False)
        holder = np.repeat(np.arange(len(queries)), self.sizes)
        self.holders = holder[np.argsort(word, kind="stable")]
        self.counts = np.bincount(word, minlength=len(self.words))
        self.begins = np.cumsum(self.counts) - self.counts

    def _by_product(self, row: np.ndarray, word: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Shared words among the frequent ones (queries x rows), and which words these are."""
        queries = len(self.sizes)
        meetings = self.counts * np.bincount(word, minlength=len(self.counts))
        frequent = np.flatnonzero(meetings * DENSE_GAIN >= max(queries * rows, 1))
        frequent = frequent[np.argsort(-meetings[frequent], kind="stable")[:DENSE_WORDS]]
        column = np.full(len(self.counts), -1)
        column[frequent] = np.arange(len(frequent))
        ours, theirs = (np.zeros((n, len(frequent)), np.float32) for n in (queries, rows))
        within = np.arange(self.counts[frequent].sum()) - np.repeat(np.cumsum(self.counts[frequent]) - self.counts[frequent], self.counts[frequent])
        held = np.repeat(self.begins[frequent], self.counts[frequent]) + within
        ours[self.holders[held], np.repeat(np.arange(len(frequent)), self.counts[frequent])] = 1
        hit = column[word] >= 0
        theirs[row[hit], column[word[hit]]] = 1
        return (ours @ theirs.T).astype(np.float64), column >= 0  # counts far below 2**24 are exact

    def __call__(self, corpus: pa.Array) -> np.ndarray:
        sizes = np.diff(np.asarray(corpus.offsets)).astype(np.int64)
        found = pc.index_in(corpus.flatten(), value_set=self.words)
        hit = found.is_valid().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)[hit]
        word = found.drop_null().to_numpy()
        shared, dense = self._by_product(row, word, len(sizes))
        shared = shared.ravel()
        row, word = row[~dense[word]], word[~dense[word]]
        lists = np.cumsum(self.counts[word]) if len(word) else np.zeros(0, np.int64)
        # list entries are unrolled some millions at a time
        cuts = np.searchsorted(lists, np.arange(1, lists[-1] // UNROLLED + 1) * UNROLLED) if len(lists) else []
        for piece in np.split(np.arange(len(word)), np.asarray(cuts, np.int64)):
            count = self.counts[word[piece]]
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            query = self.holders[np.repeat(self.begins[word[piece]], count) + within]
            shared += np.bincount(query * len(sizes) + np.repeat(row[piece], count), minlength=len(shared))
        shared = shared.reshape(len(self.sizes), len(sizes))
        union = (self.sizes[:, None] + sizes[None, :]) - shared
        return np.divide(shared, union, out=np.zeros_like(union), where=union > 0)


def significant(scores: np.ndarray, digits: int) -> np.ndarray:
    """Scores cut to so many significant digits, so that the order does not depend on their size."""
    size = np.abs(scores)
    sound = (size > 0) & np.isfinite(size)
    power = np.power(10.0, np.floor(np.log10(size, where=sound, out=np.zeros_like(size))))
    return np.where(sound, np.round(scores / power, digits - 1) * power, scores)


def first_k(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, digits: int | None) -> np.ndarray:
    """Places of the k best rows of every query, best first; equal scores go by id."""
    ranked = scores if digits is None else significant(scores, digits)
    order = np.lexsort((ids, -ranked, query))
    sorted_query = query[order]
    first = np.flatnonzero(np.diff(sorted_query, prepend=sorted_query[:1] - 1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[place < k]


def best_of(scores: np.ndarray, ids: np.ndarray, k: int, digits: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(query rows, corpus columns) of the k best scores of every row; -inf and what is not a number are left out."""
    scores = np.where(np.isnan(scores), -np.inf, scores)
    wanted = scores > -np.inf
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        wanted &= scores >= (least if digits is None else least - 10.0 ** (2 - digits) * np.where(np.isfinite(least), np.abs(least), 0))[:, None]
    query, column = np.nonzero(wanted)
    keep = first_k(query, ids[column], scores[query, column], k, digits)
    return query[keep], column[keep]
