"""Removal of repeated passages by prefix-partitioned suffix trees over words.

A window is n consecutive words. A word is removed if a window around it has the words of a window that starts earlier: in a
document of a smaller id, or in the same one further in front. Suffixes are sampled where it loses nothing: of each
window the k-word gram of least hash is its anchor, so equal windows have equal anchors at equal places. A suffix starts at
each anchor and keeps the words in front of it that its windows need. Anchors that occur once in the whole
corpus are dropped; for the rest, suffixes are grouped by a prefix of variable length: its first two words, all k words where
more than group_rows texts share those, and all n words of a window where an anchor is in more than crowd_texts texts. Of
the last the least start is found by a minimum that is combined before the shuffle, so no such group is held by a task.
A task takes the other groups up to a bounded number of suffixes, sorts all window suffixes, and reads the tree off
the common prefix lengths of neighbours: nodes as deep as a window are its repeats, whose first leaf stays.

Defined results: null texts have no words. Rows without an id take no part and keep all words. Rows of the same id and
text are one document, and each gets its result; of different texts under one id, the smaller text hash
counts as earlier. Texts shorter than a window keep all words. An empty table gives no rows. Extra columns are kept; the
columns added get underscores in front where a name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.arrays import STEP, Words, mixed, slices, tidy, windows, words_of
from nearkin.llm.postings import gather, scatter, shard_count
from nearkin.llm.quality import unused
from nearkin.plans.scale import fits_broadcast, written

SHORT = 2
TREE_ROWS = 10_000
TREE_WINDOWS = 100_000


def least_places(values: np.ndarray, n: int) -> np.ndarray:
    """For every n consecutive values the place of the smallest, the first of equal ones."""
    best, span = np.arange(len(values)), 1

    def combined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[right] < values[left], right, left)

    while span * 2 <= n:
        best, span = combined(best[:-span], best[span:]), span * 2
    return combined(best[: len(best) - (n - span)], best[n - span:]) if n > span else best


def anchors(words: Words, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each window, the place of its anchor, and the grams' hashes by place. No window crosses a document."""
    grams = windows(words.hash, k)
    if len(words.hash) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    place = least_places(grams, n - k + 1)
    doc = words.doc
    start = np.flatnonzero(doc[: len(place)] == doc[n - 1:])
    return start, place[start], grams


def anchor_postings(column: pa.Array, n: int, k: int) -> tuple[np.ndarray, ...]:
    """Row, anchor hash, hash of its first words, and whether the row has it at several places; once per row and anchor."""
    words = words_of(column)
    _, place, grams = anchors(words, n, k)
    place = place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place
    row, key = words.doc[place], grams[place]
    short = windows(words.hash, SHORT)[place] if len(place) else key
    order = np.lexsort((key, row))
    row, key, short = row[order], key[order], short[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(key))) > 1
    return row[first], key[first], short[first], many.astype(np.uint64)


def repeated_anchors(key: np.ndarray, node: np.ndarray, short: np.ndarray, many: np.ndarray) -> Iterator[list[np.ndarray]]:
    """Of all postings of a shard those whose anchor occurs in two texts, or twice in one."""
    order = np.lexsort((node, key))
    key, node, short, many = key[order], node[order], short[order], many[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])  # a text that several tasks have sent
    key, node, short, many = key[new], node[new], short[new], many[new]
    if len(key) == 0:
        return
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    stays = np.repeat((size > 1) | (np.maximum.reduceat(many, first) > 0), size)
    yield [x[stays].view(np.int64) for x in (node, key, short)]


def suffix_rows(n: int, k: int):
    """Suffixes of the documents' repeated anchors, as rows (prefix, id, node, start, count, context).

    start and count are the windows of the anchor, context their words. Of equal contexts within a batch the first stays;
    the windows of the others are repeats already: rows without context.
    """
    names = ["prefix", "id", "node", "start", "count", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 2):
                ids, nodes = np.asarray(piece.column(0)), np.asarray(piece.column(1))
                words = words_of(piece.column(2))
                start, place, grams = anchors(words, n, k)
                wanted = piece.column(3)
                row = np.repeat(np.arange(len(ids)), np.asarray(wanted.value_lengths()))
                key = np.asarray(wanted.flatten().field("anchor")).view(np.uint64)
                long = np.asarray(wanted.flatten().field("long")).astype(bool)
                salt = np.arange(len(ids), dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
                known = key ^ salt[row]
                order = np.argsort(known)
                known, long = known[order], long[order]
                doc = words.doc
                mine = grams[place] ^ salt[doc[start]] if len(start) else np.zeros(0, np.uint64)
                at = np.minimum(np.searchsorted(known, mine), max(len(known) - 1, 0))
                hit = known[at] == mine if len(known) else np.zeros(len(mine), bool)
                start, place, at = start[hit], place[hit], at[hit]
                if len(start) == 0:
                    continue
                first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
                count = np.diff(np.append(first, len(start)))
                start, place = start[first], place[first]
                short = windows(words.hash, SHORT)
                prefix = np.where(long[at[first]], grams[place], short[place]).view(np.int64)
                owner = doc[start]
                body, lo, hi = words.data.tobytes(), words.start[start], words.end[start + count + n - 2]
                context = [body[a:b] for a, b in zip(lo.tolist(), hi.tolist())]
                order = np.lexsort((start, nodes[owner], ids[owner]))
                met, kept, same = {}, np.ones(len(start), bool), np.zeros(len(start), bool)
                for i in order.tolist():
                    own = (ids[owner[i]], nodes[owner[i]], start[i] - words.bound[owner[i]])
                    first_met = met.setdefault(context[i], own)
                    same[i] = first_met is not own and first_met == own  # the document again
                    if first_met is not own:
                        context[i], kept[i] = None, False
                prefix[~kept] = (grams[place[~kept]] + start[~kept].astype(np.uint64)).view(np.int64)  # anywhere
                made = pa.RecordBatch.from_arrays([
                    pa.array(prefix), pa.array(ids[owner]), pa.array(nodes[owner]),
                    pa.array((start - words.bound[owner]).astype(np.int64)), pa.array(count.astype(np.int64)),
                    pa.array(context, pa.binary())], names=names)
                yield made.filter(pa.array(~same)) if same.any() else made

    return run, "prefix bigint, id bigint, node bigint, start bigint, count bigint, context binary"


def window_rows(n: int, k: int):
    """The windows of the documents' crowded anchors, a row for each: two hashes of its words, id, node and start."""
    names = ["h1", "h2", "id", "node", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 2):
                ids, nodes = np.asarray(piece.column(0)), np.asarray(piece.column(1))
                words = words_of(piece.column(2))
                start, place, grams = anchors(words, n, k)
                if len(start) == 0:
                    continue
                wanted, doc = piece.column(3), words.doc
                salt = np.arange(len(ids), dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
                known = np.sort(np.asarray(wanted.flatten()).view(np.uint64) ^ salt[np.repeat(np.arange(len(ids)), np.asarray(wanted.value_lengths()))])
                mine = grams[place] ^ salt[doc[start]]
                start = start[known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine]
                owner = doc[start]
                first, second = windows(words.hash, n)[start], windows(mixed(words.hash ^ STEP), n)[start]
                yield pa.RecordBatch.from_arrays([
                    pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(ids[owner]), pa.array(nodes[owner]),
                    pa.array((start - words.bound[owner]).astype(np.int64))], names=names)

    return run, "h1 bigint, h2 bigint, id bigint, node bigint, start bigint"


def repeats_in_tree(ids: np.ndarray, nodes: np.ndarray, starts: np.ndarray, counts: np.ndarray, contexts: list[bytes],
                    n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and window number of every window suffix that is not the first leaf of its node at depth n."""
    words = words_of(pa.array(contexts, pa.binary()).cast(pa.large_binary()).view(pa.large_string()))
    row = np.repeat(np.arange(len(ids)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = words.bound[row] + number
    part_of = windows(words.hash, n)[begin]
    parts = -(-len(row) // TREE_WINDOWS)
    part_of = part_of % np.uint64(parts)  # equal suffixes are in one part, whatever the number of parts
    _, letter = np.unique(words.hash, return_inverse=True)
    found = []
    for part in range(parts):
        mine = np.flatnonzero(part_of == np.uint64(part)) if parts > 1 else np.arange(len(row))
        suffix = letter.astype(np.int32)[begin[mine][:, None] + np.arange(n)]
        r = row[mine]
        order = np.lexsort((starts[r] + number[mine], nodes[r], ids[r], *suffix.T[::-1]))
        suffix = suffix[order]
        depth = np.cumprod(suffix[1:] == suffix[:-1], axis=1).sum(axis=1)  # common prefix of neighbours, in words
        deep = np.concatenate([[False], depth >= n])
        first = np.maximum.accumulate(np.where(deep, 0, np.arange(len(order))))  # first leaf of each leaf's node
        own, top = mine[order], mine[order[first]]
        same = (ids[row[own]] == ids[row[top]]) & (nodes[row[own]] == nodes[row[top]])
        same &= starts[row[own]] + number[own] == starts[row[top]] + number[top]  # the document again, not a repeat
        found.append(own[deep & ~same])
    found = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return row[found], number[found]


def tree_marks(n: int):
    """Sorted suffix rows to runs of windows to remove: (id, node, start, count)."""
    names = ["id", "node", "start", "count"]

    def build(table: pa.Table) -> pa.RecordBatch:
        ids, nodes, starts, counts = (table.column(c).to_numpy() for c in names)
        contexts = table.column("context").to_pylist()
        given = np.array([c is None for c in contexts], bool)
        tree = np.flatnonzero(~given)
        out = [[x[given]] for x in (ids, nodes, starts, counts)]
        if len(tree):
            row, number = repeats_in_tree(ids[tree], nodes[tree], starts[tree], counts[tree], [contexts[i] for i in tree], n)
            if len(row):
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1)]))
                run, at = np.diff(np.append(first, len(row))), tree[row[first]]
                for to, x in zip(out, (ids[at], nodes[at], starts[at] + number[first], run)):
                    to.append(x)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            total += batch.num_rows
            while total >= TREE_ROWS:
                table = pa.concat_tables(held).combine_chunks()
                prefix = table.column("prefix").to_numpy()
                ends = np.flatnonzero(prefix[1:] != prefix[:-1]) + 1  # whole groups only
                if len(ends) == 0:
                    held = [table]
                    break
                cut = int(ends[ends <= TREE_ROWS][-1]) if ends[0] <= TREE_ROWS else int(ends[0])
                yield build(table.slice(0, cut))
                held, total = [table.slice(cut)], total - cut
        if total:
            yield build(pa.concat_tables(held).combine_chunks())

    return run, "id bigint, node bigint, start bigint, count bigint"


def without_repeats(fields: list[str], place: int, n: int):
    """Rows (marks, columns of the documents, id, node) to the columns and n_words, n_removed, kept. place: of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 1 + place):
                n_words, n_removed, kept = [], [], []
                for text, marks in zip(piece.column(1 + place).to_pylist(), piece.column(0).to_pylist()):
                    words = (text or "").encode().split()  # on the same six characters
                    stay = None
                    if marks and len(words) >= n:
                        edge = np.zeros(len(words) + 1, np.int32)
                        for mark in marks:
                            start, count = mark["start"], mark["count"]
                            edge[start] += 1
                            edge[len(words) if count < 0 else start + count + n - 1] -= 1
                        stay = np.cumsum(edge[:-1]) == 0
                    n_words.append(len(words))
                    n_removed.append(0 if stay is None else int(len(words) - stay.sum()))
                    kept.append(b" ".join(words if stay is None else compress(words, stay.tolist())).decode())
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[1:-2], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    names=fields)

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 20, k: int = 8,
                   group_rows: int = 20_000, crowd_texts: int = 5_000) -> DataFrame:
    """The rows of df with n_words, n_removed and kept: the words left, joined by one space."""
    id_name, node, mark = (unused(df, x) for x in ("_id", "_node", "_marks"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select("*", F.col(id_col).cast("bigint").alias(id_name), F.xxhash64(text).alias(node))
    named = docs.where(F.col(id_name).isNotNull())
    slim = named.select(F.col(id_name).alias("id"), F.col(node).alias("node"), text.alias("text"))
    firsts = written(slim.groupBy("node").agg(F.min("id").alias("id")))

    shards = shard_count(slim, "text")
    blobs = scatter(slim, lambda column: anchor_postings(column, n, k), shards, columns=3)
    repeated = written(gather(blobs, repeated_anchors, shards, "node bigint, anchor bigint, short bigint"))
    def near(keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if fits_broadcast(keys, 16) else keys

    crowds = written(repeated.groupBy("anchor").count().where(F.col("count") > crowd_texts).select("anchor"))
    hot = None if crowds.isEmpty() else repeated.join(near(crowds), "anchor", "left_semi")
    repeated = repeated if hot is None else repeated.join(near(crowds), "anchor", "left_anti")
    crowded = written(repeated.groupBy("short").count().where(F.col("count") > group_rows).select("short", F.lit(True).alias("long")))
    wanted = repeated.join(near(crowded), "short", "left").join(firsts, "node").groupBy("id", "node").agg(
        F.collect_list(F.struct("anchor", F.coalesce("long", F.lit(False)).alias("long"))).alias(mark))

    def to_docs(found: DataFrame, how: str) -> DataFrame:
        """Both joins deal out the same columns of the documents in the same way, so that one exchange serves both."""
        return named.join(found.select(F.col("id").alias(id_name), F.col("node").alias(node), mark), [id_name, node], how)

    rows_of, rows_schema = suffix_rows(n, k)
    rows = to_docs(wanted, "inner").select(id_name, node, F.col(text_col), mark, *columns).mapInArrow(tidy(rows_of), rows_schema)
    marks_of, marks_schema = tree_marks(n)
    found = rows.repartition(shards, "prefix").sortWithinPartitions("prefix").mapInArrow(tidy(marks_of), marks_schema)
    if hot is not None:  # a window of its own for each row: the first of equal ones by a minimum that is combined before the shuffle
        asked = hot.join(firsts, "node").groupBy("id", "node").agg(F.collect_list("anchor").alias(mark))
        windows_of, windows_schema = window_rows(n, k)
        single = written(to_docs(asked, "inner").select(id_name, node, F.col(text_col), mark).mapInArrow(tidy(windows_of), windows_schema))
        own = ["id", "node", "start"]
        stay = single.groupBy("h1", "h2").agg(F.min(F.struct(*own)).alias("first")).select("first.*")
        found = found.unionByName(single.select(*own).join(stay, own, "left_anti").withColumn("count", F.lit(1).cast("bigint")))
    copies = slim.select("id", "node").distinct().join(firsts.withColumnRenamed("id", "first"), "node").where(F.col("id") > F.col("first"))
    marks = found.unionByName(copies.select("id", "node", F.lit(0).cast("bigint").alias("start"), F.lit(-1).cast("bigint").alias("count"))) \
        .groupBy("id", "node").agg(F.collect_list(F.struct("start", "count")).alias(mark))

    added = [unused(df, c) for c in ("n_words", "n_removed", "kept")]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [
        f"`{added[0]}` bigint", f"`{added[1]}` bigint", f"`{added[2]}` string"]
    unnamed = docs.where(F.col(id_name).isNull()).withColumn(mark, F.lit(None).cast("array<struct<start:bigint,count:bigint>>"))
    both = to_docs(marks, "left").unionByName(unnamed).select(mark, *columns, id_name, node)
    place = [c.lower() for c in df.columns].index(text_col.lower())
    return both.mapInArrow(tidy(without_repeats([*df.columns, *added], place, n)), ", ".join(fields))
