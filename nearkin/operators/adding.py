"""Sums of vectors by key, for partial results that tasks give off."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nearkin.functions import kernels

PARTIAL = "key int, v binary"  # v: packed doubles

BATCH_BYTES = 16 << 20


def partial_rows(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int32()), kernels.packed_column(sums)], names=["key", "v"]
    )


def partial_batches(keys: np.ndarray, sums: np.ndarray):
    """The same in batches of some megabytes."""
    step = max(1, BATCH_BYTES // (sums.shape[1] * 8))
    for first in range(0, len(keys), step):
        yield partial_rows(keys[first:first + step], sums[first:first + step])


def summed(parts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and sums on the driver; only for a number of keys that does not grow with the data."""
    table = sum_vectors(parts).toArrow()
    return table.column("key").to_numpy(), kernels.unpacked(table.column("v"))


def _added(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[starts], np.add.reduceat(rows[order], starts, axis=0)


def sum_vectors(parts: DataFrame) -> DataFrame:
    """(key, v) summed per key: spread by key, then added batch by batch.

    A task holds one row per key of its share, and every key comes once per task that made it.
    """

    def add(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _added(batch.column(0).to_numpy(), kernels.unpacked(batch.column(1)))
            if total is not None:
                new = _added(np.concatenate([total[0], new[0]]), np.concatenate([total[1], new[1]]))
            total = new
        if total is not None:
            yield from partial_batches(*total)

    return parts.repartition("key").mapInArrow(add, PARTIAL)
