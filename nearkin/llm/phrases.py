"""Phrase collocations, counted in counting quotient filters.

Texts are cut into pieces and words; everything is per language. Words that reach min_count get ids: their places in sorted
hash arrays in the shared folder, which workers map. An n-gram is packed as the place of its first n - 1 words among
the frequent (n-1)-grams and the id of its last word, so that a key fits 64 bits whatever n, and n-grams whose
front or rest is not frequent are never counted (they cannot be frequent either).

A key is permuted invertibly within its bits. Its upper bits are the quotient, the lower ones the remainder, which is kept in
full, so a filter loses nothing and keys can be read back from it. A filter holds, in the order of permuted keys, the
run length of each quotient in unary, the remainders in as few bytes as they need, and counts of one byte with an
overflow list. Tasks send filters of what they have counted, cut into ranges of permuted keys; a range's filters are merged
in order, one range at a time, and its frequent keys become the next level's sorted arrays. Ranges hold a bounded
number of words' grams; of shards, the files and tasks, there are at most MAX_SHARDS, each with as many ranges as it needs.

A candidate's counts come from the same arrays: those of its fronts from its key, those of its rests by looking them up.

Defined results: null texts count as empty, a null language as `und`; a text in a language without a frequent word adds to n
only. Rows that repeat count each time. An empty table gives no rows. Other columns play no part and are not returned.
Words are looked up by 64-bit hashes of language and word; equal hashes of two frequent words are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearkin.llm.arrays import mixed, slices, tidy
from nearkin.llm.cutting import Spans, byte_set, cut, span_hashes
from nearkin.llm.lm import arrays_of, model_folder, save
from nearkin.plans.scale import written

#: What ends a piece, and what separates words within one.
BREAKS = byte_set(*b".,;:!?", range(0x0A, 0x0E))
SEPARATORS = BREAKS | byte_set(0x20, 0x09)
ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
FLUSH = 1_000_000
RANGE_WORDS = 2_500_000
MAX_SHARDS = 10_000
SHARD_WORDS = 2_000_000
SALTS = 64


def low_bits(n: int) -> np.uint64:
    return np.uint64((1 << n) - 1)


@dataclass
class Permutation:
    """An invertible mapping of the numbers of so many bits."""

    bits: int

    def _fold(self, x: np.ndarray) -> np.ndarray:
        return x ^ (x >> np.uint64((self.bits + 1) // 2))  # its own inverse: nothing is shifted twice

    def apply(self, x: np.ndarray) -> np.ndarray:
        for odd in ODD:
            x = (self._fold(x) * np.uint64(odd)) & low_bits(self.bits)
        return self._fold(x)

    def invert(self, x: np.ndarray) -> np.ndarray:
        x = self._fold(x)
        for odd in reversed(ODD):
            x = self._fold((x * np.uint64(pow(odd, -1, 1 << 64))) & low_bits(self.bits))
        return x


def range_of(key: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """The range of a key by its leading bits; ranges are in the order of keys."""
    top = key >> np.uint64(bits - 32) if bits > 32 else key << np.uint64(32 - bits)
    return ((top * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def filter_bytes(key: np.ndarray, count: np.ndarray, bits: int, quotient_bits: int) -> bytes:
    """A counting quotient filter of distinct permuted keys in rising order, with their counts."""
    rest = bits - quotient_bits
    quotient, remainder = (key >> np.uint64(rest)).astype(np.int64) if rest < 64 else np.zeros(len(key), np.int64), key & low_bits(rest)
    first = int(quotient[0])
    unary = np.zeros(len(key) + int(quotient[-1]) - first + 1, np.uint8)
    unary[np.arange(len(key)) + quotient - first] = 1  # a one for each key, a zero behind each quotient's run
    many = np.flatnonzero(count >= 255)
    head = np.array([len(key), bits, quotient_bits, first, len(unary), len(many)], np.int64)
    low = np.ascontiguousarray(remainder.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : -(-rest // 8)]
    return b"".join([head.tobytes(), np.packbits(unary).tobytes(), low.tobytes(), np.minimum(count, 255).astype(np.uint8).tobytes(),
                     count[many].astype(np.uint64).tobytes()])


def filter_entries(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The permuted keys of a filter in rising order and their counts."""
    n, bits, quotient_bits, first, length, many = np.frombuffer(data, np.int64, 6).tolist()
    rest, at = bits - quotient_bits, 48
    width = -(-rest // 8)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, -(-length // 8), at), count=length)
    at += -(-length // 8)
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    count = np.frombuffer(data, np.uint8, n, at).astype(np.uint64)
    count[count == 255] = np.frombuffer(data, np.uint64, many, at + n)
    key = whole.view("<u8").ravel().astype(np.uint64)
    if rest < 64:
        key |= (np.flatnonzero(unary) - np.arange(n) + first).astype(np.uint64) << np.uint64(rest)
    return key, count


def added_up(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in rising order with the sums of their counts."""
    if len(key) == 0:
        return key, count
    order = np.argsort(key, kind="stable")  # runs that are sorted already are merged
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(count, first)


def merged(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The entries of several filters of one range as those of one."""
    parts = [filter_entries(f) for f in filters]
    return added_up(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


@dataclass
class Level:
    """Sorted keys in the files of a folder, a file for each shard, with counts. A key's place counts through all shards."""

    folder: str
    name: str
    bits: int
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return int(self.offsets[-1])

    def find(self, key: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for one that is not there."""
        distinct, inverse = np.unique(key, return_inverse=True)
        place, shard = np.full(len(distinct), -1, np.int64), range_of(distinct, self.bits, len(self.offsets) - 1)
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(distinct)]):
            number = int(shard[lo]) if lo < hi else 0
            own = arrays_of(self.folder).array(f"{self.name}-{number}-key") if lo < hi else None
            if own is None or len(own) == 0:
                continue
            at = np.minimum(np.searchsorted(own, distinct[lo:hi]), len(own) - 1)
            place[lo:hi] = np.where(own[at] == distinct[lo:hi], at + self.offsets[number], -1)
        return place[inverse]

    def values(self, what: str, place: np.ndarray) -> np.ndarray:
        """The key or count at each place."""
        out = np.zeros(len(place), np.uint64)
        shard = np.searchsorted(self.offsets, place, "right") - 1
        for number in np.unique(shard).tolist():
            mine = shard == number
            out[mine] = arrays_of(self.folder).array(f"{self.name}-{number}-{what}")[place[mine] - self.offsets[number]]
        return out

    def texts(self, place: np.ndarray) -> list[bytes]:
        """The text at each place, for a level that has texts."""
        out: list[bytes] = [b""] * len(place)
        shard = np.searchsorted(self.offsets, place, "right") - 1
        for number in np.unique(shard).tolist():
            body, end = (arrays_of(self.folder).array(f"{self.name}-{number}-{x}") for x in ("text", "end"))
            for i in np.flatnonzero(shard == number).tolist():
                at = int(place[i] - self.offsets[number])
                out[i] = body[int(end[at - 1]) if at else 0: int(end[at])].tobytes()
        return out


class Grams:
    """The frequent n-grams found so far: levels[0] has the words."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @property
    def id_bits(self) -> int:
        return max(1, self.levels[0].size.bit_length())

    def key_bits(self, n: int) -> int:
        bits = self.id_bits + max(1, self.levels[n - 2].size.bit_length())
        if bits > 64:
            raise ValueError("n-grams of so many frequent words and phrases do not fit 64 bits: raise min_count")
        return bits

    def pack(self, n: int, front: np.ndarray, last: np.ndarray) -> np.ndarray:
        key = (front.astype(np.uint64) << np.uint64(self.id_bits)) | last.astype(np.uint64)
        return Permutation(self.key_bits(n)).apply(key)

    def unpack(self, n: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = Permutation(self.key_bits(n)).invert(key)
        return (key >> np.uint64(self.id_bits)).astype(np.int64), (key & low_bits(self.id_bits)).astype(np.int64)

    def keys_in(self, n: int, texts: pa.Array, langs: pa.Array) -> np.ndarray:
        """The keys of all n-grams within a piece of text whose first and last n - 1 words are frequent."""
        words = cut(texts, SEPARATORS)
        word = self.levels[0].find(word_keys(words, langs))
        piece = np.cumsum(BREAKS[words.data], dtype=np.int32)[words.start] + words.row if len(word) else np.zeros(0, np.int64)
        place = word
        for j in range(2, n + 1):
            if len(place) < 2:
                return np.zeros(0, np.uint64)
            good = (place[:-1] >= 0) & (place[1:] >= 0) & (piece[: len(place) - 1] == piece[j - 1:])
            key = self.pack(j, place[:-1][good], word[j - 1:][good])
            if j == n:
                return key
            place = np.full(len(good), -1, np.int64)
            place[good] = self.levels[j - 1].find(key)
        return np.zeros(0, np.uint64)

    def parts(self, n: int, key: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Word ids of n-grams by place, and the counts of their first 1 to n - 1 words."""
        front, last = self.unpack(n, key)
        ids, counts = [last], []
        for j in range(n - 1, 0, -1):
            level = self.levels[j - 1]
            counts.insert(0, level.values("count", front))
            if j == 1:
                ids.insert(0, front)
            else:
                front, last = self.unpack(j, level.values("key", front))
                ids.insert(0, last)
        return ids, counts

    def count_of(self, ids: list[np.ndarray]) -> np.ndarray:
        """The counts of frequent n-grams given as word ids."""
        place = ids[0]
        for j in range(2, len(ids) + 1):
            place = self.levels[j - 1].find(self.pack(j, place, ids[j - 1]))
        return self.levels[len(ids) - 1].values("count", place)


def word_keys(words: Spans, langs: pa.Array) -> np.ndarray:
    """A 64-bit hash of language and word, for each word."""
    coded = langs.dictionary_encode()
    of_lang = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()] or [0], np.uint64)
    return mixed(span_hashes(words) ^ of_lang[np.asarray(coded.indices)][words.row])


def word_strings(words: Spans, index: np.ndarray) -> pa.Array:
    """The words of these numbers as a string column."""
    start, length = words.start[index], words.end[index] - words.start[index]
    offsets = np.concatenate([[0], np.cumsum(length)])
    data = words.data[np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(index), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) to (lang, word, n): the distinct words of each few megabytes of text."""
    for batch in batches:
        for piece in slices(batch, 0, 4 << 20):
            words = cut(piece.column(0), SEPARATORS)
            _, first, count = np.unique(word_keys(words, piece.column(1)), return_index=True, return_counts=True)
            lang = piece.column(1).take(pa.array(words.row[first]))
            yield pa.RecordBatch.from_arrays([lang, word_strings(words, first), pa.array(count.astype(np.int64))], names=["lang", "word", "n"])


def vocabulary(words: DataFrame, folder: str) -> Level:
    """Frequent words (lang, word, n) as sorted arrays. The sizes of the shards reach the driver, a number each."""
    shards = max(1, min(MAX_SHARDS, -(-words.count() // SHARD_WORDS)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            whole = Spans(*_rows(column), np.arange(batch.num_rows + 1))
            key = word_keys(whole, batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range_of(key, 64, shards).astype(np.int32)), pa.array(key.view(np.int64)), *batch.columns], names=["shard", "key", "lang", "word", "n"])

    def write(shard: int, table: pa.Table) -> int:
        key = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        if (key[order][1:] == key[order][:-1]).any():
            raise ValueError("two frequent words have one hash")
        lang, word = table.column("lang").to_pylist(), table.column("word").to_pylist()
        texts = [f"{lang[i]}\n{word[i]}".encode() for i in order.tolist()]
        save(folder, f"word-{shard}-key", key[order])
        save(folder, f"word-{shard}-count", table.column("n").to_numpy()[order].astype(np.uint64))
        save(folder, f"word-{shard}-text", np.frombuffer(b"".join(texts), np.uint8))
        save(folder, f"word-{shard}-end", np.cumsum([len(t) for t in texts]))
        return len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            number = np.asarray(batch.column(0))
            for shard in np.unique(number).tolist():
                if shard not in held:  # sorted by shard, so the earlier ones are whole
                    yield from finish(held)
                    held = {}
                held.setdefault(shard, []).append(batch.filter(pa.array(number == shard)))
        yield from finish(held)

    def finish(held: dict) -> Iterator[pa.RecordBatch]:
        for shard, parts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([write(shard, pa.Table.from_batches(parts))], pa.int64())], names=["shard", "size"])

    rows = words.select("lang", "word", "n").mapInArrow(tidy(keyed), "shard int, key bigint, lang string, word string, n bigint")
    sizes = dict(written(rows.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(tidy(run), "shard int, size bigint")).collect())
    return Level(folder, "word", 64, offsets_of(sizes, shards))


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of the rows of a string column."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data, offsets[:-1], offsets[1:]


def offsets_of(sizes: dict[int, int], shards: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([sizes.get(s, 0) for s in range(shards)])]).astype(np.int64)


def gram_filters(grams: Grams, n: int, shards: int, ranges: int):
    """(text, lang) to filters of the n-grams counted: (shard, range, filter)."""
    bits = grams.key_bits(n)

    def flush(held: list) -> pa.RecordBatch:
        key, count = added_up(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
        quotient_bits = min(bits, max(0, len(key).bit_length() - 1))
        number = range_of(key, bits, ranges)
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        last = np.append(first[1:], len(key))
        data = [filter_bytes(key[a:b], count[a:b], bits, quotient_bits) for a, b in zip(first.tolist(), last.tolist())]
        number = number[first]
        return pa.RecordBatch.from_arrays(
            [pa.array((number // (ranges // shards)).astype(np.int32)), pa.array(number.astype(np.int32)), pa.array(data, pa.binary())], names=["shard", "range", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            for piece in slices(batch, 0):
                key, count = np.unique(grams.keys_in(n, piece.column(0), piece.column(1)), return_counts=True)
                if len(key):
                    held.append((key, count.astype(np.uint64)))
                    total += len(key)
                if total > FLUSH:
                    yield flush(held)
                    held, total = [], 0
        if held:
            yield flush(held)

    return run, "shard int, range int, filter binary"


def exact_share(a: np.ndarray, whole: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * a / whole) without overflow; Python's integers where 64 bits might not do. a is at most whole."""
    if len(a) and int(whole.max()) >= 1 << 40:
        return np.array([scale * int(x) // int(y) for x, y in zip(a, whole)], np.int64)
    if scale >= 1 << 23:
        raise ValueError("scale is too large")
    return (a.astype(np.uint64) * np.uint64(scale) // whole.astype(np.uint64)).astype(np.int64)


def lowest_cut(a: np.ndarray, fronts: list[np.ndarray], rests: list[np.ndarray], scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, r and score of the lowest-scoring cut; ties go to the first."""
    left, right = fronts[0].copy(), rests[0].copy()
    score = exact_share(a, left + right, scale)
    for front, rest in zip(fronts[1:], rests[1:]):
        other = exact_share(a, front + rest, scale)
        lower = other < score
        left[lower], right[lower], score[lower] = front[lower], rest[lower], other[lower]
    return left, right, score


def frequent_grams(grams: Grams, n: int, min_count: int, scale: int):
    """Sorted filters to the frequent n-grams with counts and scores, and a row with the size of each shard. Writes the
    shard's sorted arrays. One range is held at a time."""
    names = ["shard", "size", "lang", "phrase", "words", "a", "l", "r", "score"]

    def rows(key: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(key), 50_000):
            k, a = key[at: at + 50_000], count[at: at + 50_000]
            ids, fronts = grams.parts(n, k)
            left, right, score = lowest_cut(a, fronts, [grams.count_of(ids[c:]) for c in range(1, n)], scale)
            texts = [[t.decode().rsplit("\n", 1) for t in grams.levels[0].texts(i)] for i in ids]
            size = len(k)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(size, pa.int32()), pa.nulls(size, pa.int64()), pa.array([t[0] for t in texts[0]], pa.string()),
                pa.array([" ".join(w[1] for w in words) for words in zip(*texts)], pa.string()), pa.array([n] * size, pa.int32()),
                *[pa.array(x.astype(np.int64)) for x in (a, left, right, score)]], names=names)

    def finish(shard: int, kept: list) -> Iterator[pa.RecordBatch]:
        key, count = (np.concatenate([np.zeros(0, np.uint64), *x]) for x in (zip(*kept) if kept else ((), ())))
        save(grams.levels[0].folder, f"gram{n}-{shard}-key", key)
        save(grams.levels[0].folder, f"gram{n}-{shard}-count", count)
        yield from rows(key, count)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([len(key)], pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.string()),
             pa.nulls(1, pa.int32()), *[pa.nulls(1, pa.int64())] * 4], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, filters, kept = None, [], []

        def close() -> None:
            if filters:
                key, count = merged(filters)
                kept.append((key[count >= min_count], count[count >= min_count]))
                filters.clear()

        for batch in batches:
            for shard, number, data in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (shard, number):
                    close()
                    if now and now[0] != shard:
                        yield from finish(now[0], kept)
                        kept = []
                    now = (shard, number)
                filters.append(data)
        if now:
            close()
            yield from finish(now[0], kept)

    return run, "shard int, size bigint, lang string, phrase string, words int, a bigint, l bigint, r bigint, score bigint"


CANDIDATES = "lang string, phrase string, words int, a bigint, l bigint, r bigint, score bigint"


def candidate_phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 4, min_count: int = 30,
                      scale: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """Phrases of 2 to max_words words that occur min_count times or more within pieces, with a (their count), l, r and score
    of their lowest cut; and the number of word occurrences n of each language."""
    spark = df.sparkSession
    texts = df.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")).where("text is not null")
    words = written(texts.mapInArrow(tidy(word_counts), "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("n")))
    grams = Grams([vocabulary(words.where(F.col("n") >= min_count), model_folder(spark))])
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    needed = max(spark.sparkContext.defaultParallelism, -(-int(total) // RANGE_WORDS))
    shards = min(needed, MAX_SHARDS)
    ranges = shards * -(-needed // shards)
    found = spark.createDataFrame([], CANDIDATES)
    for n in range(2, max_words + 1):
        if grams.levels[-1].size == 0:
            break
        count, filter_schema = gram_filters(grams, n, shards, ranges)
        merge, schema = frequent_grams(grams, n, min_count, scale)
        filters = texts.mapInArrow(tidy(count), filter_schema)
        rows = written(filters.repartition(shards, "shard").sortWithinPartitions("shard", "range").mapInArrow(tidy(merge), schema))
        sizes = {r.shard: r.size for r in rows.where("size is not null").select("shard", "size").collect()}  # a row for each shard
        grams = Grams([*grams.levels, Level(grams.levels[0].folder, f"gram{n}", grams.key_bits(n), offsets_of(sizes, shards))])
        found = found.unionByName(rows.where("phrase is not null").drop("shard", "size"))
    return found, totals


def uncovered(candidates: DataFrame, percent: int = 80) -> DataFrame:
    """The candidates without those that lie inside a longer one with at least so many percent of their count."""
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda s: F.array_join(F.slice(words, s, m), " "))))
    longest = candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    longest = longest.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = 100 * F.col("longer").cast("decimal(30,0)") >= percent * F.col("a").cast("decimal(30,0)")
    return candidates.join(longest, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 4, min_count: int = 30, best: int = 2000,
                 percent: int = 80, scale: int = 2_000_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `best` phrases of each language by score, count and phrase.

    The order is cut in two steps, first within salts, so that no task sorts all phrases of a language.
    """
    candidates, totals = candidate_phrases(df, text_col, lang_col, max_words, min_count, scale)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = uncovered(candidates, percent).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")).where(F.col("rank") <= best)
    return salted.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
