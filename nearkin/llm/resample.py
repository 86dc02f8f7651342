"""Importance resampling towards a target distribution, by hashed n-gram features of deduplicated lines.

Features of a text are its runs of 1 to n consecutive words; a feature's bucket is its crc32 modulo `buckets`. The texts are cut
at newlines: Spark counts how often each distinct line occurs (combined before the shuffle), the features of a
distinct line are counted once and multiplied by its occurrences, and runs that cross a line's end are added separately.
With S and s (all features, those of a bucket) of the corpus and T and t of the target, a bucket's gain is
floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))). A document's weight is the floored mean gain of its features.
Its score adds Gumbel noise, -1000 ln(-ln u), where u comes from the sha256 of seed and id, so that the highest scores are
a draw without replacement in proportion to exp(weight / 1000). The gains are `buckets` numbers, whatever the corpus.

Scoring works the same way within a batch: distinct lines once, occurrences by their number, crossing runs separately.

Ranks are given by a sort over ranges of (score, id, row), so neither one score nor one id that repeats comes to one task.

Defined results: null and empty texts have no features and weight 0; a null id counts as empty in the noise and comes
first among equal scores; rows that repeat are documents of their own; an empty target or corpus counts as no features;
an empty table gives no rows. All columns but the text are kept; added columns get underscores in front where a name is taken.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.arrays import slices, tidy
from nearkin.llm.cutting import Spans, byte_set, cut
from nearkin.llm.quality import unused
from nearkin.plans.scale import written

#: Words are runs of digits, letters and characters beyond ASCII; the polynomial of crc32.
SEPARATORS = byte_set(range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80))
POLYNOMIAL = 0xEDB88320
LONG_WORD = 64
ROW_BITS = 33  # monotonically_increasing_id() keeps the row's place in its partition in so many bits


def crc_step() -> np.ndarray:
    """crc32 of one byte, for each byte: the usual table."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


def crc_shifts(step: np.ndarray) -> np.ndarray:
    """shifts[n][j][v]: what byte j with value v of a checksum becomes when n bytes follow, up to LONG_WORD. Checksums are
    linear, so that of a text and a word behind it is the shifted one of the text, xor that of the word."""
    out = np.empty((LONG_WORD + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(LONG_WORD):
        out[n + 1] = step[out[n] & 255] ^ (out[n] >> 8)
    return out


_step = crc_step()
_shifts = crc_shifts(_step)


def word_checksums(words: Spans) -> np.ndarray:
    """crc32 of each word, byte by byte for all words at once; long words one by one."""
    length = words.end - words.start
    out = np.full(len(length), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] <= LONG_WORD]
    sizes, start, state = length[order], words.start[order], out[order]
    for place in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -place, "left"))  # words longer than this place
        byte = words.data[start[:n] + place]
        state[:n] = _step[(state[:n] ^ byte) & 255] ^ (state[:n] >> 8)
    out[order] = state
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = zlib.crc32(words.data[words.start[i]: words.end[i]].tobytes())
    return out


def joined(front: np.ndarray, words: Spans, own: np.ndarray, at: np.ndarray) -> np.ndarray:
    """crc32 of texts, a space and the words `at`, from the checksums of the texts (front) and of all words (own)."""
    state = front ^ np.uint32(0xFFFFFFFF)
    state = _step[(state ^ 0x20) & 255] ^ (state >> 8) ^ np.uint32(0xFFFFFFFF)
    length = words.end[at] - words.start[at]
    n = np.minimum(length, LONG_WORD)
    out = own[at].copy()
    for j in range(4):
        out ^= _shifts[n, j, (state >> np.uint32(8 * j)) & 255]
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = zlib.crc32(words.data[words.start[at[i]]: words.end[at[i]]].tobytes(), int(state[i]))
    return out


def runs(words: Spans, own: np.ndarray, sequence: np.ndarray, group: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For k = 2 to n the place in `sequence` (of word numbers) and the checksum of each run of k words in one group."""
    at, front = np.arange(len(sequence)), own[sequence]
    for k in range(2, n + 1):
        at = at[at + k - 1 < len(sequence)]
        at = at[group[at] == group[at + k - 1]]
        front_of = front[at]
        front = np.zeros(len(sequence), np.uint32)
        front[at] = joined(front_of, words, own, sequence[at + k - 1])
        yield at, front[at]


def line_features(lines: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, Spans, np.ndarray]:
    """Row and bucket of each feature of a column of lines, its words and their checksums."""
    words = cut(lines, SEPARATORS)
    own, row = word_checksums(words), words.row
    found = [(row, own)] + [(row[at], key) for at, key in runs(words, own, np.arange(len(row)), row, n)]
    rows, keys = (np.concatenate(x) for x in zip(*found))
    return rows, keys % np.uint32(buckets), words, own


def crossing(words: Spans, own: np.ndarray, line: np.ndarray, document: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and bucket of each run of 2 to n words that crosses a line's end. line: the distinct lines in the order in
    which they occur, document: whose they are. Of a long line only its first and last n - 1 words can be in such a run."""
    size, place = np.diff(words.bound), np.arange(len(own)) - np.repeat(words.bound[:-1], np.diff(words.bound))
    edge = np.flatnonzero((place < n - 1) | (place >= np.repeat(size, size) - (n - 1)))
    first = np.searchsorted(edge, words.bound)
    count = np.diff(first)[line]
    begin = np.cumsum(count) - count
    sequence = edge[np.repeat(first[line] - begin, count) + np.arange(int(count.sum()))]
    owner, occurrence = np.repeat(document, count), np.repeat(np.arange(len(line)), count)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint32))]
    for k, (at, key) in enumerate(runs(words, own, sequence, owner, n), 2):
        over = occurrence[at] != occurrence[at + k - 1]
        found.append((owner[at[over]], key[over]))
    rows, keys = (np.concatenate(x) for x in zip(*found))
    return rows, keys % np.uint32(buckets)


def distinct_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct lines of a batch of texts; the number of each line in them, in order, and its text's row."""
    parts = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), "\n")
    document = np.repeat(np.arange(len(parts)), np.asarray(pc.list_value_length(parts)))
    coded = parts.flatten().dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices).astype(np.int64), document


def bucket_counts(texts: DataFrame, text_col: str, n: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    names = ["bucket", "n"]

    def sums(total: np.ndarray) -> pa.RecordBatch:
        hit = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=names)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in slices(batch, 0):
                row, key, _, _ = line_features(piece.column(0), n, buckets)
                times = np.asarray(piece.column(1))
                order = np.argsort(key, kind="stable")  # sums of whole numbers, not of doubles
                key, many = key[order], times[row[order]]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
                if len(first):
                    total[key[first]] += np.add.reduceat(many, first)
        yield sums(total)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in slices(batch, 0):
                lines, line, document = distinct_lines(piece.column(0))
                words = cut(lines, SEPARATORS)
                total += np.bincount(crossing(words, word_checksums(words), line, document, n, buckets)[1], minlength=buckets)
        yield sums(total)

    texts = texts.select(F.col(text_col).alias("text")).dropna()
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    both = lines.mapInArrow(tidy(within), "bucket int, n bigint").unionAll(texts.mapInArrow(tidy(across), "bucket int, n bigint"))
    out = np.zeros(buckets, np.int64)
    for bucket, count in both.groupBy("bucket").agg(F.sum("n")).collect():  # at most `buckets` rows
        out[bucket] = count
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket from the numbers of features of corpus and target."""
    buckets, all_corpus, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (all_corpus + buckets) / ((float(s) + 1) * (all_target + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(df: DataFrame, text_col: str, gains: np.ndarray, n: int, names: tuple[str, str, str]) -> DataFrame:
    """df without its text, with the number of words, the number of features and the weight of each text."""
    others = [c for c in df.columns if c.lower() != text_col.lower()]
    given = df.select(F.col(text_col).alias("text"), *[F.col(f"`{c}`") for c in others])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 0):
                lines, line, document = distinct_lines(piece.column(0))
                row, key, cut_lines, own = line_features(lines, n, len(gains))
                order = np.argsort(row, kind="stable")
                edges = np.searchsorted(row[order], np.arange(len(lines) + 1))
                upto = np.concatenate([[0], np.cumsum(gains[key[order]])])
                gain, size = upto[edges[1:]] - upto[edges[:-1]], np.diff(edges)  # of each distinct line, once
                over, crossed = crossing(cut_lines, own, line, document, n, len(gains))
                rows = piece.num_rows
                totals = []
                for per_line, per_run in ((gain, gains[crossed]), (size, np.ones(len(over), np.int64)), (np.diff(cut_lines.bound), None)):
                    sums = np.zeros(rows, np.int64)
                    np.add.at(sums, document, per_line[line])
                    if per_run is not None:
                        np.add.at(sums, over, per_run)
                    totals.append(sums)
                total, features, words = totals
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[1:], pa.array(words), pa.array(features), pa.array(weight)], names=[*others, *names])

    return given.mapInArrow(tidy(run), ", ".join(fields + [f"`{x}` bigint" for x in names]))


def ranked(df: DataFrame, score: str, id_col: str, rank: str, most: int) -> DataFrame:
    """df with the place of each row by falling score, ties to smaller ids, where it is at most `most`, else null.

    df should be a written table. Rows are sorted over ranges; the number of rows in each range, a few longs, makes the offsets.
    """
    row, place, part, offset = (unused(df, x) for x in ("_row", "_place", "_part", "_offset"))
    numbered = written(df.withColumn(row, F.monotonically_increasing_id()))
    order = [F.desc(score), F.asc(id_col), F.asc(row)]
    sorted_rows = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(sorted_rows.withColumn(place, F.monotonically_increasing_id()))
    placed = placed.withColumn(part, F.shiftright(place, ROW_BITS).cast("int"))
    before, offsets = 0, []
    for number, size in placed.groupBy(part).count().orderBy(part).collect():
        offsets.append((number, before))
        before += size
    table = df.sparkSession.createDataFrame(offsets, f"`{part}` int, `{offset}` bigint")
    at = F.col(offset) + F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return placed.join(F.broadcast(table), part).withColumn(rank, F.when(at <= most, at)).drop(row, place, part, offset)


def importance_resample(df: DataFrame, target: DataFrame, text_col: str = "text", id_col: str = "doc_id", target_text_col: str = "text",
                        percent: int = 25, n: int = 2, buckets: int = 10_000, min_words: int = 20, seed: int = 7) -> DataFrame:
    """df without its text, with n_features, weight, score and rank.

    Of the N documents with at least min_words words, the floor(percent * N / 100) with the highest scores have a rank from
    1; ties go to smaller ids. For other documents rank is null.
    """
    gains = bucket_gains(bucket_counts(df, text_col, n, buckets), bucket_counts(target, target_text_col, n, buckets))
    features, weight, score, rank, words = (unused(df, x) for x in ("n_features", "weight", "score", "rank", "_n_words"))
    drawn_by = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn_by, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")
    scored = written(weights(df, text_col, gains, n, (words, features, weight)).withColumn(score, F.col(weight) + noise))
    eligible = F.col(words) >= min_words
    drawn = percent * scored.where(eligible).count() // 100
    rest = scored.where(~eligible).withColumn(rank, F.lit(None).cast("bigint"))
    return ranked(scored.where(eligible), score, id_col, rank, drawn).unionByName(rest).drop(words)
