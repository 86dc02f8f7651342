"""Interpolated modified Kneser-Ney n-gram models: counted in Spark, kept as sorted hash arrays, read by memory mapping.

Words become ids by their place in the sorted array of word hashes. From the highest order down, tasks send the distinct
grams of their text with counts to the shard of the gram's context; a shard adds them up and writes its sorted hashes and counts, its contexts'
totals, and sends each gram without its first word to the next lower order, where counts are numbers of distinct
left neighbours (those of grams that begin with a start mark stay numbers of occurrences, as nothing can stand in front). Contexts of frequent words
are spread over all shards and their totals are added up by a second shuffle (`wide`); all others are whole where they are. Of these the ones with a total
of one are not stored: a context is itself a gram of the next lower order, so one that is found there and has no totals has this total. The files lie
in the shared folder, which workers must see as files; they are written under another name and renamed, so a repeated task leaves the same files.

P_j(w | c) = max(count - D(count), 0) / total(c) + gamma(c) * P_{j-1}(w | shorter c), where the discounts D for counts 1, 2
and 3 or more come from the counts of counts of order j, and gamma(c) is what they take from c. P_0 is 1 / (V + 1), V the
number of distinct training tokens; a context that was not seen passes its probability down. A text is preceded by
order - 1 start marks and followed by an end, which is a token.

Null texts count as empty: one token, the end. Null ids are in training. Rows that repeat are counted and scored each time.
With no training text every token has probability 1. Of extra columns those named in `keep` stay; added ones get underscores in front
where a name is taken.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.llm.arrays import STEP, mixed, slices, tidy, words_of
from nearkin.llm.postings import by_shard, packed, packed_schema, shard_count
from nearkin.llm.quality import unused
from nearkin.plans.scale import scratch_folder, shuffles_freed, written

#: Fixed value: stands for the end of a text among the word hashes.
END = np.uint64(0x51ED270B0A2F1C37)
OPEN_FILES = 1 << 14
INDEXED = 1 << 18  # from so many keys on their first 16 bits are bounds in an array, and six bytes of each key are left
FLUSH_TOKENS = 1_000_000


def model_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder, as a path of the file system."""
    place = urlparse(scratch_folder(spark))
    if place.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped models need a shared folder that is a file system, not {place.scheme}")
    path = os.path.join(place.path, f"nearkin-lm-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def small(values: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds all of them."""
    return values.astype(np.min_scalar_type(int(values.max()))) if len(values) else values.astype(np.uint8)


def save_counts(folder: str, name: str, values: np.ndarray) -> None:
    """Counts in a byte each; those of 255 or more apart, with their places."""
    more = np.flatnonzero(values >= 255)
    save(folder, name, np.minimum(values, 255).astype(np.uint8))
    if len(more):
        save(folder, f"{name}-at", more.astype(np.uint32))
        save(folder, f"{name}-more", small(values[more]))


def save_keys(folder: str, name: str, keys: np.ndarray) -> None:
    """Sorted keys; many of them without the 16 bits that their places tell."""
    if len(keys) < INDEXED:
        return save(folder, f"{name}-key", keys)
    save(folder, f"{name}-middle", (keys >> np.uint64(16)).astype(np.uint32))
    save(folder, f"{name}-last", keys.astype(np.uint16))
    save(folder, f"{name}-first", np.searchsorted(keys >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64)).astype(np.uint32))


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Writes an array so that it is there whole or not at all."""
    other = os.path.join(folder, f"{name}.{uuid.uuid4().hex}.part")
    with open(other, "wb") as out:
        np.save(out, values)
    os.replace(other, os.path.join(folder, f"{name}.npy"))


class Arrays:
    """The arrays of a model, mapped when first used."""

    def __init__(self, folder: str):
        self.folder, self.maps, self.frequent = folder, OrderedDict(), None

    def array(self, name: str) -> np.ndarray | None:
        if name not in self.maps:
            path = os.path.join(self.folder, f"{name}.npy")
            self.maps[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
            if len(self.maps) > OPEN_FILES:
                self.maps.popitem(last=False)
        self.maps.move_to_end(name)
        return self.maps[name]

    def find(self, table: str, shard: np.ndarray, key: np.ndarray, values: tuple[str, ...]) -> list[np.ndarray]:
        """Values of each key, 0 where there is none; the place for the table's own position in its shard is -1."""
        out = [np.zeros(len(key), np.float64) for _ in values]
        few = len(shard) == 0 or shard.max() < 1 << 16
        order = np.argsort(shard.astype(np.uint16) if few else shard, kind="stable")
        cut = np.flatnonzero(np.diff(shard[order])) + 1
        for part in np.split(order, cut) if len(order) else []:
            number = int(shard[part[0]])
            part = part[np.argsort(key[part])]
            at, hit = self.places(f"{table}-{number}", key[part])
            if not hit.any():
                continue
            part, at = part[hit], at[hit]
            for to, value in zip(out, values):
                to[part] = at if value == "place" else self.counts(f"{table}-{number}-{value}", at)
        return out

    def places(self, name: str, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted keys are in a table, and whether they are."""
        keys = self.array(f"{name}-key")
        if keys is not None and len(keys):
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return at, keys[at] == key
        first = self.array(f"{name}-first") if keys is None else None
        if first is None:
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        middle, last = self.array(f"{name}-middle"), self.array(f"{name}-last")
        lead, own = (key >> np.uint64(48)).astype(np.int64), (key >> np.uint64(16)).astype(np.uint32)
        low, end = first[lead].astype(np.int64), first[lead + 1].astype(np.int64)
        high, most = end, len(last) - 1
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            at = (low + high) >> 1
            less = (low < high) & (middle[np.minimum(at, most)] < own)
            low, high = np.where(less, at + 1, low), np.where(less, high, at)
        tail = key.astype(np.uint16)
        while True:  # past keys that differ in their last bits only
            at = np.minimum(low, most)
            same = (low < end) & (middle[at] == own)
            less = same & (last[at] < tail)
            if not less.any():
                return low, same & (last[at] == tail)
            low = low + less

    def counts(self, name: str, at: np.ndarray) -> np.ndarray:
        found = self.array(name)[at].astype(np.uint64)
        more = np.flatnonzero(found == 255)
        if len(more):
            found[more] = self.array(f"{name}-more")[np.searchsorted(self.array(f"{name}-at"), at[more])]
        return found


@lru_cache(maxsize=1)
def arrays_of(folder: str) -> Arrays:
    return Arrays(folder)


def range_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the leading bits of a hash, so that the shards in order are one sorted array."""
    return ((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def gram_hash(ids: list[np.ndarray]) -> np.ndarray:
    key = np.full(len(ids[0]), STEP)
    for column in ids:
        key = mixed(key * STEP + column.astype(np.uint64) + np.uint64(1))
    return key


def distinct(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each and the sums of their counts."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    sums = np.add.reduceat(counts[order].astype(np.uint64), first) if len(key) else counts.astype(np.uint64)
    return key[first], order[first], sums


def packed_grams(shard: np.ndarray, ids: list[np.ndarray], counts: np.ndarray, width: int) -> pa.RecordBatch:
    """One row for each shard: the grams by their first word, of which the differences are sent, ids in `width` bytes, then their counts and
    their number."""
    order = np.argsort((shard.astype(np.uint64) << np.uint64(40)) | ids[0].astype(np.uint64))
    shard, ids, counts = shard[order], [c[order] for c in ids], counts[order]
    start = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])[: len(shard)])
    steps = np.diff(ids[0], prepend=ids[0].dtype.type(0))
    steps[start] = ids[0][start]
    short = [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]) for c in (steps, *ids[1:])]
    batch = packed(shard, [*short, counts.astype(np.uint32)])
    numbers = np.diff(np.append(start, len(shard)))
    return batch.append_column(f"c{len(ids) + 1}", pa.array([n.tobytes() for n in numbers], pa.binary()))


def unpacked_grams(parts: list[bytes], j: int, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ids and counts of the joined rows of `packed_grams`."""
    kind = np.dtype("<u4") if width <= 4 else np.dtype("<u8")
    steps, *ids = (_widened(np.frombuffer(p, np.uint8).reshape(-1, width), kind) for p in parts[:j])
    numbers = np.frombuffer(parts[j + 1], np.int64)
    upto = np.cumsum(steps, dtype=np.uint64)
    start = np.cumsum(numbers) - numbers
    upto -= np.repeat(np.where(start > 0, upto[start - 1], 0).astype(np.uint64), numbers)
    return [upto.astype(kind), *ids], np.frombuffer(parts[j], np.uint32)


def _widened(short: np.ndarray, kind: np.dtype) -> np.ndarray:
    out = np.zeros((len(short), kind.itemsize), np.uint8)
    out[:, : short.shape[1]] = short
    return out.view(kind)[:, 0]


class Vocabulary:
    """Word hashes to ids and counts; ids run through the shards in order. Then come the start mark and the unknown word."""

    def __init__(self, folder: str, offsets: np.ndarray, tokens: int):
        self.arrays, self.offsets, self.size = arrays_of(folder), offsets, int(offsets[-1])
        if self.arrays.frequent is None:
            self.arrays.frequent = self._frequent(tokens)

    def _frequent(self, tokens: int) -> np.ndarray:
        """Ids of words so frequent that one shard would get too much (some for each shard at most), and the start mark."""
        shards, found = len(self.offsets) - 1, []
        for number in np.flatnonzero(np.diff(self.offsets)):
            name = f"word-{number}-count"
            at = self.arrays.array(f"{name}-at") if tokens >= 255 * 4 * shards else np.arange(self.offsets[number + 1] - self.offsets[number])
            if at is not None and len(at):
                at = at.astype(np.int64)
                found.append(at[self.arrays.counts(name, at) * 4.0 * shards > tokens] + self.offsets[number])
        return np.concatenate([*found, [self.size] * (tokens > 0)]).astype(np.int64)

    def wide(self, context: list[np.ndarray]) -> np.ndarray:
        """Contexts of frequent words alone."""
        out = np.ones(len(context[0]), bool)
        for ids in context:
            at = np.minimum(np.searchsorted(self.arrays.frequent, ids), len(self.arrays.frequent) - 1)
            out &= self.arrays.frequent[at] == ids
        return out

    def ids(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shard = range_of(key, len(self.offsets) - 1)
        place, count = self.arrays.find("word", shard, key, ("place", "count"))
        ids = np.where(count > 0, place + self.offsets[shard.astype(np.int64)], self.size + 1)
        return ids.astype(np.uint32 if self.size < 2**32 - 2 else np.uint64), count

    def route(self, ids: list[np.ndarray], context: np.ndarray | None = None) -> np.ndarray:
        """The shard of a gram: that of its context, but any shard by the whole gram where the context is wide."""
        if len(ids) == 1:
            key = gram_hash(ids)
        else:
            key = gram_hash(ids[:-1]) if context is None else context.copy()
            wide = np.flatnonzero(self.wide(ids[:-1]))
            key[wide] = gram_hash([c[wide] for c in ids])
        return key % np.uint64(len(self.offsets) - 1)


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a batch, each text followed by END, and the bounds of the texts."""
    words = words_of(column, lower=True)
    bound = words.bound + np.arange(len(words.bound))
    out = np.full(bound[-1], END)
    inside = np.ones(len(out), bool)
    inside[bound[1:] - 1] = False
    out[inside] = words.hash
    return out, bound


def before(values: np.ndarray, bound: np.ndarray, steps: int, mark) -> np.ndarray:
    """For each token the value `steps` tokens earlier, or the mark in front of the text."""
    out = np.full(len(values), mark, values.dtype)
    out[steps:] = values[: len(values) - steps]
    place = np.arange(len(values)) - np.repeat(bound[:-1], np.diff(bound))
    out[place < steps] = mark
    return out


class Model:
    """What a task needs to know of a trained model; the arrays stay in files."""

    def __init__(self, folder: str, order: int, shards: int, offsets: np.ndarray, tokens: int, counts_of_counts: dict):
        self.folder, self.order, self.shards, self.offsets, self.tokens = folder, order, shards, offsets, tokens
        self.discounts = {j: discounts(n) for j, n in counts_of_counts.items()}
        self.width = (int(offsets[-1]) + 1).bit_length() + 7 >> 3  # bytes of an id
        self.base_total, self.base_kinds = counts_of_counts.get(1, {}).get("total", 0), counts_of_counts.get(1, {})

    def grams(self, column: pa.Array):
        """Bounds, ids by steps back (0 to order - 1), and the distinct words of the texts: ids, training counts, the way back to the tokens."""
        vocabulary = Vocabulary(self.folder, self.offsets, self.tokens)
        hashes, bound = token_hashes(column)
        distinct, inverse = np.unique(hashes, return_inverse=True)
        words, count = vocabulary.ids(distinct)
        ids, mark = words[inverse], vocabulary.size
        back = [before(ids, bound, s, mark) for s in range(self.order)]
        return vocabulary, bound, back, (words, count, inverse)

    def log_probabilities(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of the texts; log10 probability and training count of each token."""
        vocabulary, bound, back, (words, frequency, inverse) = self.grams(column)
        size = vocabulary.size
        if size == 0:
            return bound, np.zeros(len(back[0])), frequency[inverse]
        arrays, shards = vocabulary.arrays, np.uint64(self.shards)
        p = np.full(len(back[0]), 1.0 / (size + 1))
        for j in range(1, self.order + 1):
            ids = back[:j][::-1]
            context = gram_hash(ids[:-1]) if j > 1 else None
            asked = ids if j > 1 else [words]  # single words once each
            (count,) = arrays.find(f"gram{j}", vocabulary.route(asked, context), gram_hash(asked), ("count",))
            count = count if j > 1 else count[inverse]
            d = self.discounts[j]
            kept = np.maximum(count - d[np.minimum(count, 3).astype(int)], 0)
            if j == 1:
                total, kinds = float(self.base_total), [float(self.base_kinds[f"k{i}"]) for i in (1, 2, 3)]
                taken = sum(d[i] * k for i, k in zip((1, 2, 3), kinds))
                p = kept / total + taken / total * p
            else:
                order = np.argsort(context)
                new = np.append(True, np.diff(context[order]) != 0)
                first, at = order[new], np.empty(len(order), np.int64)
                at[order] = np.cumsum(new) - 1
                own = context[first]
                total = np.where(was_met, 1.0, 0.0)[first]
                kinds = [total.copy(), np.zeros(len(own)), np.zeros(len(own))]
                wide = vocabulary.wide([c[first] for c in ids[:-1]])
                for table, some in (("wide", np.flatnonzero(wide)), ("context", np.flatnonzero(~wide))):
                    found = arrays.find(f"{table}{j}", own[some] % shards, own[some], ("total", "k1", "k2", "k3"))
                    stored = found[0] > 0
                    for to, values in zip((total, *kinds), found):
                        to[some[stored]] = values[stored]
                taken = sum(d[i] * k for i, k in zip((1, 2, 3), kinds))
                seen = total > 0
                total[~seen], taken[~seen] = 1.0, 1.0
                p = kept / total[at] + (taken / total)[at] * p
            was_met = before(count > 0, bound, 1, False)  # the words in front, as a gram of this order
        return bound, np.log10(p), frequency[inverse]


def discounts(n: dict) -> np.ndarray:
    """D for counts 0 to 3: those of modified Kneser-Ney from the counts of counts n1 to n4, or fixed ones where these
    are too few to give numbers between 0 and the count."""
    n1, n2, n3, n4 = (float(n.get(f"n{i}", 0) or 0) for i in (1, 2, 3, 4))
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
        if all(0 < x < i for i, x in zip((1, 2, 3), d[1:])):
            return d
    return np.array([0, 0.5, 1.0, 1.5])


def add_words(folder: str, shards: int):
    """A shard of word counts, added up and written; gives its size and its number of tokens."""
    def handle(shard: int, parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        key, _, count = distinct(np.frombuffer(parts[0], np.uint64), np.frombuffer(parts[1], np.uint32))
        save_keys(folder, f"word-{shard}", key)
        save_counts(folder, f"word-{shard}-count", count)
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(key)], pa.int64()),
                                          pa.array([int(count.sum())], pa.int64())], names=["shard", "words", "tokens"])

    return handle, "shard int, words bigint, tokens bigint"


def word_counts(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush():
            key, _, count = distinct(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            return packed(range_of(key, shards), [key, count.astype(np.uint32)])

        for batch in batches:
            for piece in slices(batch, 0):
                key, count = np.unique(token_hashes(piece.column(0))[0], return_counts=True)
                held.append((key, count))
                total += len(key)
                if total > FLUSH_TOKENS:
                    yield flush()
                    held, total = [], 0
        if held:
            yield flush()

    return run


def gram_counts(model: Model):
    """Distinct grams of the highest order with counts, to their shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush():
            ids = [np.concatenate(x) for x in zip(*held)]
            _, at, count = distinct(gram_hash(ids), np.ones(len(ids[0]), np.uint8))
            ids = [c[at] for c in ids]
            return packed_grams(vocabulary.route(ids), ids, count, model.width)

        for batch in batches:
            for piece in slices(batch, 0):
                vocabulary, _, back, _ = model.grams(piece.column(0))
                held.append(back[::-1])
                total += len(back[0])
                if total > FLUSH_TOKENS:
                    yield flush()
                    held, total = [], 0
        if held:
            yield flush()

    return run


def add_grams(model: Model, j: int):
    """A shard of grams of order j, added up and written with the totals of its contexts. Gives packed rows of two kinds, wide contexts and the
    grams one word shorter, and its counts of counts."""
    folder, shards = model.folder, model.shards
    columns = max(5, j + 1)
    names = ["kind", "shard", *[f"c{i}" for i in range(columns)], *[f"n{i}" for i in range(1, 5)], "total", "k1", "k2", "k3"]

    def rows(kind: str, batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        blobs = batch.columns[1:] + [pa.nulls(n, pa.binary())] * (columns - len(batch.columns) + 1)
        return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.string()), batch.column(0), *blobs, *[pa.nulls(n, pa.int64())] * 8], names=names)

    def handle(shard: int, parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids, count = unpacked_grams(parts, j, model.width)
        key, at, count = distinct(gram_hash(ids), count)
        ids = [c[at] for c in ids]
        save_keys(folder, f"gram{j}-{shard}", key)
        save_counts(folder, f"gram{j}-{shard}-count", count)
        del key, at
        kinds = [count == 1, count == 2, count >= 3]
        if j > 1:
            vocabulary = Vocabulary(folder, model.offsets, model.tokens)
            wide = vocabulary.wide(ids[:-1])
            context = gram_hash(ids[:-1])
            if wide.any():
                yield rows("context", packed(*context_sums(context[wide], [w[wide] for w in (count, *kinds)], shards)))
            own, *sums = context_sums(context[~wide], [w[~wide] for w in (count, *kinds)], shards)[1]
            save_contexts(folder, f"context{j}-{shard}", own, sums, sums[0] > 1)
            del context, own, sums
            # no word stands in front of a start mark: such grams keep their counts
            _, at, left = distinct(gram_hash(ids[1:]), np.where(ids[1] == model.offsets[-1], count, 1))
            shorter = [c[at] for c in ids[1:]]
            yield rows("gram", packed_grams(vocabulary.route(shorter), shorter, left, model.width))
        numbers = [int((count == i).sum()) for i in (1, 2, 3, 4)] + [int(count.sum())] + [int(k.sum()) for k in kinds]
        yield pa.RecordBatch.from_arrays(
            [pa.array(["sum"]), pa.array([shard], pa.int32()), *[pa.nulls(1, pa.binary())] * columns, *[pa.array([x], pa.int64()) for x in numbers]],
            names=names)

    schema = "kind string, " + packed_schema(columns) + "".join(f", {x} bigint" for x in names[columns + 2:])
    return handle, schema


def context_sums(context: np.ndarray, columns: list[np.ndarray], shards: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Shards of the distinct contexts; these and the sums of the columns."""
    order = np.argsort(context)
    context = context[order]
    first = np.flatnonzero(np.append(True, context[1:] != context[:-1])[: len(context)])
    own = context[first]
    sums = [np.add.reduceat(w[order].astype(np.uint64), first) if len(own) else w.astype(np.uint64) for w in columns]
    return own % np.uint64(shards), [own, *sums]


def save_contexts(folder: str, name: str, own: np.ndarray, sums: list[np.ndarray], stored: np.ndarray) -> None:
    save_keys(folder, name, own[stored])
    for column, values in zip(("total", "k1", "k2", "k3"), sums):
        save_counts(folder, f"{name}-{column}", values[stored])


def add_contexts(model: Model, j: int):
    """A shard of wide contexts of order j, added up and written."""
    def handle(shard: int, parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        own, *sums = context_sums(np.frombuffer(parts[0], np.uint64), [np.frombuffer(p, np.uint64) for p in parts[1:]], model.shards)[1]
        save_contexts(model.folder, f"wide{j}-{shard}", own, sums, sums[0] > 0)
        yield pa.RecordBatch.from_arrays([pa.array([len(own)], pa.int64())], names=["contexts"])

    return handle, "contexts bigint"


def train(texts: DataFrame, text_col: str = "text", order: int = 3) -> Model:
    """A model of all texts. Besides the sizes of the vocabulary's shards, sums alone reach the driver."""
    with shuffles_freed(texts.sparkSession):
        return _trained(texts, text_col, order)


def _trained(texts: DataFrame, text_col: str, order: int) -> Model:
    spark = texts.sparkSession
    folder = model_folder(spark)
    texts = texts.select(F.col(text_col).alias("text"))
    shards = shard_count(texts, "text")
    handle, schema = add_words(folder, shards)
    counted = written(by_shard(texts.mapInArrow(tidy(word_counts(shards)), packed_schema(2)), shards, handle, schema))
    sizes = {row.shard: (row.words, row.tokens) for row in counted.collect()}
    offsets = np.concatenate([[0], np.cumsum([sizes.get(s, (0, 0))[0] for s in range(shards)])]).astype(np.int64)
    model = Model(folder, order, shards, offsets, sum(t for _, t in sizes.values()), {})
    grams, found = texts.mapInArrow(tidy(gram_counts(model)), packed_schema(order + 2)), {}
    for j in range(order, 0, -1):
        handle, schema = add_grams(model, j)
        done = written(by_shard(grams, shards, handle, schema))
        sums = done.where("kind = 'sum'").agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "total", "k1", "k2", "k3")]).first()
        found[j] = {k: int(v or 0) for k, v in sums.asDict().items()}
        if j > 1:
            handle, schema = add_contexts(model, j)
            contexts = done.where("kind = 'context'").select("shard", *[f"c{i}" for i in range(5)])
            written(by_shard(contexts, shards, handle, schema))
        grams = done.where("kind = 'gram'").select("shard", *[f"c{i}" for i in range(j + 1)])
    return Model(folder, order, shards, offsets, model.tokens, found)


def score(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep` with n_tokens, n_known, base_score (add-one unigram), score (log10) and perplexity of each text."""
    kept = df.select(F.col(text_col), *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:]]
    added = [unused(df.select(*keep), x) for x in ("n_tokens", "n_known", "base_score", "score", "perplexity")]
    names = [*keep, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 0):
                bound, logs, count = model.log_probabilities(piece.column(0))
                base = np.log10((count + 1) / (model.tokens + int(model.offsets[-1]) + 1))
                n = np.diff(bound)
                total, plain, known = (np.add.reduceat(x, bound[:-1]) for x in (logs, base, (count > 0).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    *piece.columns[1:], pa.array(n), pa.array(known), pa.array(plain), pa.array(total), pa.array(10 ** (-total / n))], names=names)

    return kept.mapInArrow(tidy(run), ", ".join(fields + [f"`{x}` {kind}" for x, kind in zip(added, ("bigint", "bigint", "double", "double", "double"))]))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))
