"""Cells of unit vectors: exact top-k that leaves out cells which cannot matter, and top-k by residual codes with a re-rank.

Rows lie by cell, so that a search reads the files of the cells that some query needs. For every cell the widest angle
between its centre and a row of its own is known; by the triangle inequality of angles no row of a cell is nearer to a query than
the angle to the centre less that width.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.operators import ivf, pq
from nearkin.operators.ranking import rank_topk
from nearkin.operators.search import NEIGHBORS, as_arrow, keep_best, query_passes, winners
from nearkin.plans.scale import MAX_BROADCAST_BYTES, checked_join, written

MARGIN = 1e-8  # bounds count as reached when they are so near: more than rounding and ties can make up
ROW = "doc_id bigint, vector array<double>, cell int, codes array<int>"


@dataclass
class CellIndex:
    """placed: (doc_id, vector, cell), unit vectors, a written table; centres: a codebook with one sub-space; widths: (cell, rows,
    width), the widest angle of each cell."""

    placed: DataFrame
    centres: DataFrame
    widths: DataFrame


def _unit_centres(centres: DataFrame) -> np.ndarray:
    return kernels.unit_rows(pq.codebook_array(centres)[0])


def build(vectors: DataFrame, cells: int, rounds: int = 5) -> CellIndex:
    centres = written(ivf.train_cells(vectors, cells, rounds))
    return index_of(written(ivf.assign_cells(vectors, centres)), centres)


def index_of(placed: DataFrame, centres: DataFrame) -> CellIndex:
    """The index of saved rows, which may be split into folders by cell."""
    shared = placed.sparkSession.sparkContext.broadcast(_unit_centres(centres))

    def measure(batches):
        low = np.full(len(shared.value), np.inf)
        size = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            if batch.num_rows:
                cell = batch.column(1).to_numpy()
                near = np.einsum("ij,ij->i", kernels.matrix(batch.column(0)), shared.value[cell])
                np.minimum.at(low, cell, near)
                size += np.bincount(cell, minlength=len(size))
        hit = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(size[hit]), pa.array(low[hit])], names=["cell", "rows", "low"])

    parts = placed.select("vector", "cell").mapInArrow(measure, "cell int, rows bigint, low double")
    widths = parts.groupBy("cell").agg(F.sum("rows").alias("rows"), F.acos(F.greatest(F.least(F.min("low"), F.lit(1.0)), F.lit(-1.0))).alias("width"))
    return CellIndex(placed, centres, written(widths))


def _first_probes(index: CellIndex, queries: DataFrame, nprobe: int) -> DataFrame:
    return written(ivf.probes(queries, index.centres, nprobe))


def needed_cells(index: CellIndex, first: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """(qid, vector, cell): the cells not probed first that may hold a row better than the k-th found."""
    kth = found.filter(F.col("rank") == k).select("qid", F.col("score").alias("least"))
    asked = first.groupBy("qid").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("cell")).alias("probed"))
    asked = asked.join(kth, "qid", "left").select("qid", "vector", "probed", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    table = index.widths.orderBy("cell").toArrow()  # a row for each cell
    shared = first.sparkSession.sparkContext.broadcast(
        (table.column("cell").to_numpy(), table.column("width").to_numpy(), _unit_centres(index.centres)))

    def pick(batches):
        cells, width, centres = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = kernels.matrix(batch.column(1))
            angle = np.arccos(np.clip(rows @ centres[cells].T, -1, 1))
            bound = np.cos(np.maximum(angle - width, 0.0))
            loose = ~centres[cells].any(axis=1)  # a centre without direction bounds nothing
            bound[:, loose] = 1.0
            least = batch.column(3).to_numpy()
            open_ = bound >= (least - MARGIN * (1 + np.abs(np.where(np.isfinite(least), least, 0))))[:, None]
            for i, probed in enumerate(batch.column(2).to_pylist()):
                open_[i] &= ~np.isin(cells, probed)
            query, cell = np.nonzero(open_)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(query)), kernels.list_column(rows[query], pa.float64()), pa.array(cells[cell].astype(np.int32))],
                names=["qid", "vector", "cell"])

    return written(asked.mapInArrow(pick, "qid bigint, vector array<double>, cell int"))


def exact_topk(index: CellIndex, queries: DataFrame, k: int = 10, nprobe: int = 1, exclude_self: bool = True) -> tuple[DataFrame, DataFrame]:
    """Exact cosine top-k, and (qid, cell) of all cells that were looked into.

    The nearest cells of a query give its k-th score so far; of the others only those are searched whose bound reaches it.
    """
    first = _first_probes(index, queries, nprobe)
    found = written(ivf.probed_topk(index.placed, first, k, exclude_self))
    more = needed_cells(index, first, found, k)
    rest = ivf.probed_topk(index.placed, more, k, exclude_self)
    both = found.select("qid", "doc_id", "score").unionByName(rest.select("qid", "doc_id", "score"))
    return rank_topk(both, k, digits=kernels.TIE_DIGITS), first.select("qid", "cell").unionByName(more.select("qid", "cell"))


def rows_compared(index: CellIndex, looked: DataFrame, exclude_self: bool = True) -> DataFrame:
    """(qid, n_rows): how many rows each query was compared with."""
    counted = looked.join(index.widths.select("cell", "rows"), "cell")
    if exclude_self:
        own = index.placed.select(F.col("doc_id").alias("qid"), "cell", F.lit(1).alias("own"))
        counted = counted.join(own, ["qid", "cell"], "left")
        return counted.groupBy("qid").agg(F.sum(F.col("rows") - F.coalesce("own", F.lit(0))).alias("n_rows"))
    return counted.groupBy("qid").agg(F.sum("rows").alias("n_rows"))


# ---------------------------------------------------------------- residual codes

def residuals(index: CellIndex) -> DataFrame:
    """(doc_id, vector): what is left of each row when its centre is taken off."""
    shared = index.placed.sparkSession.sparkContext.broadcast(pq.codebook_array(index.centres)[0])

    def take_off(batches):
        for batch in batches:
            if batch.num_rows:
                rows = kernels.matrix(batch.column(1)) - shared.value[batch.column(2).to_numpy()]
                yield pa.RecordBatch.from_arrays([batch.column(0), kernels.list_column(rows, pa.float64())], names=["doc_id", "vector"])

    return index.placed.select("doc_id", "vector", "cell").mapInArrow(take_off, "doc_id bigint, vector array<double>")


def with_codes(index: CellIndex, codebooks: DataFrame) -> DataFrame:
    """(doc_id, vector, cell, codes): the rows with the codes of their residuals. Written by cell, a search by codes reads no vector."""
    centres, books = pq.codebook_array(index.centres)[0], pq.codebook_array(codebooks)
    shared = index.placed.sparkSession.sparkContext.broadcast((centres, books))

    def code(batches):
        centres, books = shared.value
        for batch in batches:
            if batch.num_rows:
                rows = kernels.matrix(batch.column(1)) - centres[batch.column(2).to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, kernels.list_column(kernels.nearest_codes(rows, books), pa.int32())], names=["doc_id", "vector", "cell", "codes"])

    return index.placed.select("doc_id", "vector", "cell").mapInArrow(code, ROW)


def coded_topk(coded: DataFrame, centres: DataFrame, codebooks: DataFrame, asked: DataFrame, k: int, exclude_self: bool = True) -> DataFrame:
    """(qid, doc_id, score, rank) by the inner product of a query with centre plus coded residual, among the rows of the
    probed cells (qid, vector, cell). Reads ids, cells and codes only."""
    books, middle = pq.codebook_array(codebooks), pq.codebook_array(centres)[0]
    coded, found = coded.select("doc_id", "cell", "codes"), None
    for table in query_passes(asked, ivf.MAX_PROBES, MAX_BROADCAST_BYTES):
        part = _scan_codes(coded, table, books, middle, k, exclude_self)
        found = part if found is None else found.unionAll(part)
    return rank_topk(found, k, digits=kernels.TIE_DIGITS)


def _scan_codes(coded: DataFrame, table: pa.Table, books: np.ndarray, centres: np.ndarray, k: int, exclude_self: bool) -> DataFrame:
    cell_of, qid, vectors = table.column("cell").to_numpy(), table.column("qid").to_numpy(), kernels.matrix(table.column("vector"))
    by_cell = {int(c): (qid[cell_of == c], vectors[cell_of == c]) for c in np.unique(cell_of)}
    shared = coded.sparkSession.sparkContext.broadcast((by_cell, books, centres))
    m, _, width = books.shape

    def scan(batches):
        by_cell, books, centres = shared.value
        best = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, cell, codes = batch.column(0).to_numpy(), batch.column(1).to_numpy(), kernels.matrix(batch.column(2), np.int64)
            for c in np.unique(cell).tolist():
                if c not in by_cell:
                    continue
                qids, asked = by_cell[c]
                here = cell == c
                scores = np.repeat((asked @ centres[c])[:, None], here.sum(), axis=1)
                for part in range(m):
                    products = asked[:, part * width:(part + 1) * width] @ books[part].T
                    scores += np.take(products, codes[here, part], axis=1)
                new = winners(qids, ids[here], scores, k, exclude_self, kernels.TIE_DIGITS)
                best = new if best is None else keep_best(best, new, k, kernels.TIE_DIGITS)
        if best is not None:
            yield as_arrow(best, pa.RecordBatch)

    return coded.filter(F.col("cell").isin(list(by_cell))).mapInArrow(scan, NEIGHBORS)


def reranked_topk(
    coded: DataFrame, centres: DataFrame, codebooks: DataFrame, queries: DataFrame, k: int = 10, nprobe: int = 4, refine: int = 10,
    exclude_self: bool = True,
) -> DataFrame:
    """Cosine top-k: refine * k rows of the probed cells by their codes, then these ranked by their vectors.

    `coded` is a written table (doc_id, vector, cell, codes). The vectors are read in the second step, of the probed cells and for
    the rows of the short list.
    """
    asked = written(ivf.probes(queries, centres, nprobe))
    short = written(coded_topk(coded, centres, codebooks, asked, refine * k, exclude_self).select("qid", "doc_id"))
    probed = asked.select("cell").distinct()
    wanted = [r["cell"] for r in probed.collect()]  # cells: no more than there are centres
    rows = coded.filter(F.col("cell").isin(wanted)).select("doc_id", "vector")
    met = checked_join(rows, short, ["doc_id"], 32, "qid", skewed="small")
    unit = asked.groupBy("qid").agg(F.first("vector").alias("q_vector"))
    met = checked_join(met, written(unit), ["qid"], F.size("q_vector") * 8 + 24, "doc_id")
    products = F.zip_with("q_vector", "vector", lambda x, y: x * y)
    scored = met.withColumn("score", F.aggregate(products, F.lit(0.0), lambda total, x: total + x))
    return rank_topk(scored, k, digits=kernels.TIE_DIGITS)
