"""Postings on their way to the task of their key: (key, node) pairs as packed arrays instead of rows.

A pair of 64-bit numbers takes 16 bytes in the shuffle and no JVM object. Keys are hashes, so shards are even, and a
frequent key costs one pair per node and task, since a task sends what a node holds once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.llm.arrays import slices, tidy

FLUSH = 500_000


def shard_count(df: DataFrame, text_col: str, shard_bytes: int = 8 << 20) -> int:
    """So many shards that each gets the postings of about shard_bytes of text."""
    total = df.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("bigint")), F.lit(0))).first()[0]
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-int(total) // shard_bytes))


def packed_schema(columns: int) -> str:
    return ", ".join(["shard int", *[f"c{i} binary" for i in range(columns)]])


def packed(shard: np.ndarray, parts: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each shard that occurs, with its part of each array as bytes."""
    shard = shard.astype(np.int32)
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cut = np.flatnonzero(np.diff(shard)) + 1
    first = np.concatenate([[0], cut])[: len(shard)]
    blobs = [pa.array([x.tobytes() for x in np.split(p[order], cut)][: len(first)], pa.binary()) for p in parts]
    return pa.RecordBatch.from_arrays([pa.array(shard[first]), *blobs], names=["shard", *[f"c{i}" for i in range(len(parts))]])


def fresh_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Nodes and texts (columns 0 and 1), piece by piece; a node that the task meets again is passed over."""
    seen: set[int] = set()
    for batch in batches:
        for piece in slices(batch, 1):
            nodes = np.asarray(piece.column(0))
            fresh = np.zeros(len(nodes), bool)
            for i, node in enumerate(nodes.tolist()):
                if node not in seen:
                    seen.add(node)
                    fresh[i] = True
            if fresh.any():
                yield nodes[fresh], piece.column(1).filter(pa.array(fresh))


def scatter(df: DataFrame, make: Callable, shards: int, columns: int = 1, shift: int = 0) -> DataFrame:
    """df: node, text. make(texts) gives the row number of each posting, its key and `columns` - 1 more uint64 columns.
    The key goes to a shard without its lowest `shift` bits. A node that a task meets again is passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush() -> pa.RecordBatch:
            parts = [np.concatenate(x) for x in zip(*held)]
            return packed((parts[0] >> np.uint64(shift)) % np.uint64(shards), parts)

        for nodes, texts in fresh_pieces(batches):
            row, key, *more = make(texts)
            held.append([key, nodes[row].view(np.uint64), *more])
            total += len(key)
            if total >= FLUSH:
                yield flush()
                held, total = [], 0
        if total:
            yield flush()

    return df.select("node", "text").mapInArrow(tidy(run), packed_schema(columns + 1))


def by_shard(blobs: DataFrame, shards: int, handle: Callable, schema: str) -> DataFrame:
    """handle(shard, columns) on the joined bytes of each column, one shard at a time; it gives record batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                shard, *blob = [c[i].as_py() for c in batch.columns]
                if shard != now:
                    if parts:
                        yield from handle(now, [b"".join(p) for p in parts])
                    now, parts = shard, [[] for _ in blob]
                for to, data in zip(parts, blob):
                    to.append(data)
        if parts:
            yield from handle(now, [b"".join(p) for p in parts])

    return blobs.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(tidy(run), schema)


def gather(blobs: DataFrame, reduce: Callable, shards: int, schema: str) -> DataFrame:
    """reduce(key, node, ...) on all postings of a shard; it gives the columns of the schema, part by part."""
    names = [f.split()[0] for f in schema.split(", ")]

    def handle(_: int, parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for columns in reduce(*[np.frombuffer(p, np.uint64) for p in parts]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return by_shard(blobs, shards, handle, schema)
