"""Approximate cosine top-k over an inverted file; `nprobe` trades time for recall."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.functions.vectors import l2_normalize
from nearkin.operators.pq import codebook_array, train_codebooks
from nearkin.operators.ranking import rank_topk
from nearkin.operators.search import NEIGHBORS, as_arrow, keep_best, query_passes, winners
from nearkin.plans.scale import MAX_BROADCAST_BYTES, written

MAX_PROBES = 16_384


def train_cells(vectors: DataFrame, cells: int = 16, rounds: int = 5) -> DataFrame:
    """Cell centres of the unit-length vectors, as a codebook with one sub-space."""
    unit = written(vectors.select("doc_id", l2_normalize(F.col("vector")).alias("vector")))
    return train_codebooks(unit, 1, cells, rounds)


def assign_cells(vectors: DataFrame, centres: DataFrame) -> DataFrame:
    """(doc_id, vector, cell), vectors of unit length. Written by cell, a query reads its cells only."""
    shared = vectors.sparkSession.sparkContext.broadcast(codebook_array(centres))

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                rows = kernels.unit_rows(kernels.matrix(batch.column(1)))
                cell = kernels.nearest_codes(rows, shared.value)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), kernels.list_column(rows, pa.float64()), pa.array(cell, pa.int32())],
                    names=["doc_id", "vector", "cell"],
                )

    plain = vectors.select("doc_id", "vector").filter("vector is not null")
    return plain.mapInArrow(place, "doc_id bigint, vector array<double>, cell int")


def probes(queries: DataFrame, centres: DataFrame, nprobe: int) -> DataFrame:
    """(qid, vector, cell): the nprobe nearest cells of each query; ties go to the lower cell."""
    shared = queries.sparkSession.sparkContext.broadcast(codebook_array(centres))

    def pick(batches):
        for batch in batches:
            if batch.num_rows:
                rows = kernels.unit_rows(kernels.matrix(batch.column(1)))
                distance = kernels.significant(kernels.distance_tables(rows, shared.value)[:, 0, :], kernels.TIE_DIGITS)
                cell = np.argsort(distance, axis=1, kind="stable")[:, :nprobe]
                width = cell.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(0).to_numpy(), width)),
                     kernels.list_column(np.repeat(rows, width, axis=0), pa.float64()),
                     pa.array(cell.ravel(), pa.int32())],
                    names=["qid", "vector", "cell"],
                )

    plain = queries.select("qid", "vector").filter("vector is not null")
    return plain.mapInArrow(pick, "qid bigint, vector array<double>, cell int")


def ivf_topk(
    placed: DataFrame, centres: DataFrame, queries: DataFrame, k: int = 10, nprobe: int = 4, exclude_self: bool = True
) -> DataFrame:
    """Cosine top-k among the vectors of the probed cells.

    Probes go to every task, in passes of bounded size; a task scores each cell of its rows against the queries
    that probe it. The rows stay where they were read, so a cell with a third of all rows is still scored by many
    tasks.
    """
    return probed_topk(placed, written(probes(queries, centres, nprobe)), k, exclude_self)


def probed_topk(placed: DataFrame, asked: DataFrame, k: int, exclude_self: bool = True) -> DataFrame:
    """Cosine top-k among the vectors of the cells that are asked for: a written table (qid, vector, cell) of unit vectors."""
    placed = placed.select("doc_id", "vector", "cell")
    found = None
    for table in query_passes(asked, MAX_PROBES, MAX_BROADCAST_BYTES):
        part = _scan(placed, table, k, exclude_self)
        found = part if found is None else found.unionAll(part)
    return rank_topk(found, k, digits=kernels.TIE_DIGITS)


def _scan(placed: DataFrame, table: pa.Table, k: int, exclude_self: bool) -> DataFrame:
    """The k best rows per query and task for the probes of one pass."""
    cell_of, qid = table.column("cell").to_numpy(), table.column("qid").to_numpy()
    vectors = kernels.matrix(table.column("vector"))
    by_cell = {int(c): (qid[cell_of == c], vectors[cell_of == c]) for c in np.unique(cell_of)}
    shared = placed.sparkSession.sparkContext.broadcast(by_cell)

    def scan(batches):
        best = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, rows = batch.column(0).to_numpy(), kernels.matrix(batch.column(1))
            cell = batch.column(2).to_numpy()
            for c in np.unique(cell):
                if int(c) not in shared.value:
                    continue
                qids, asked_vectors = shared.value[int(c)]
                here = cell == c
                scores = asked_vectors @ rows[here].T
                new = winners(qids, ids[here], scores, k, exclude_self, kernels.TIE_DIGITS)
                best = new if best is None else keep_best(best, new, k, kernels.TIE_DIGITS)
        if best is not None:
            yield as_arrow(best, pa.RecordBatch)

    return placed.filter(F.col("cell").isin([int(c) for c in by_cell])).mapInArrow(scan, NEIGHBORS)
