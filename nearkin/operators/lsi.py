"""Latent semantic vectors: truncated SVD of the TF-IDF table without centring.

The term side (terms x width) is a table of row blocks from the random start to the directions, never an array on the driver
or in a task. Documents lie in blocks of bounded size. In a pass, every document block gets the rows of the basis that
its terms need, adds up its part of A Q and gives off its part of A'(A Q) for these terms; sums are made by term block. The
sums are made orthonormal by a QR of the rows of each task and of the triangles, 16 at a time. What reaches the driver
is a few width x width matrices.

A basis of bounded size goes to every task instead (`DocumentRows`): then documents are read where they lie, and the sums of
a task, one row for each term, are all that is shuffled.

Passes that only turn the basis towards the strongest directions may send single precision: their sums are made orthonormal
in doubles as they are, so it costs no accuracy but a noise that the last pass, in doubles, sees as a hardly different start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.operators.terms import tfidf_rows
from nearkin.plans.scale import shuffles_freed, written

OVERSAMPLES = 10
TERM_BLOCK = 128  # terms that travel in one row
BLOCK_ENTRIES = 4 << 20  # entries of a document block
BLOCK_DOCS = 32_768
PART_ENTRIES = 1 << 18  # entries that travel in one row
FAN_IN = 16  # matrices that one task of a tree takes
RANK_LIMIT = 1e-10  # directions weaker than this, in proportion to the strongest, are dropped
DENSE_FACTOR = 64
DENSE_CELLS = 1 << 22  # of a small dense matrix
GATHERED = 2_048  # rows that are gathered for one product
SHARED_BYTES = 128 << 20  # of a basis that goes to every task, in doubles
TASK_ENTRIES = 8 << 20  # entries that a task adds up at least before it gives its sums off, if all slots have work
SOUND_LIMIT = 1e-5  # below this the columns are made orthonormal twice

BASIS = "block int, v binary"


@dataclass
class LsiModel:
    """Terms in index order, the blocks (block, v) of their directions (terms x k), and the k singular values."""

    terms: list[str]
    directions: DataFrame
    singular_values: np.ndarray

    @property
    def k(self) -> int:
        return len(self.singular_values)


@dataclass
class DocumentBlocks:
    """A sparse table in blocks of documents: their ids, their entries by term, and which terms of a term block they need."""

    table: DataFrame
    id_type: str
    blocks: int

    def documents(self) -> DataFrame:
        return self.table.where("doc_id is not null").select("g", F.col("at"), "doc_id")

    def entries(self) -> DataFrame:
        return self.table.where("term is not null").select("g", "at", "term", "doc", "v")

    def needs(self) -> DataFrame:
        return self.table.where("ids is not null").select("g", F.col("at").alias("block"), "ids")


@dataclass
class DocumentRows:
    """Sparse rows (doc_id, idx, val) as they are, and by how many tasks a pass reads them."""

    table: DataFrame
    id_type: str
    tasks: int

    def read(self) -> DataFrame:
        return self.table.select("doc_id", "idx", "val").coalesce(self.tasks)


def documents_of(rows: DataFrame, terms: int, width: int) -> DocumentRows | DocumentBlocks:
    """A written table of sparse rows, ready for passes with a basis of this size."""
    if terms * width * 8 > SHARED_BYTES:
        return document_blocks(rows)
    slots = rows.sparkSession.sparkContext.defaultParallelism
    entries = rows.agg(F.coalesce(F.sum(F.size("idx")), F.lit(0))).first()[0]
    return DocumentRows(rows, dict(rows.dtypes)["doc_id"], slots * max(1, -(-entries // (TASK_ENTRIES * slots))))


def _bytes(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def document_blocks(rows: DataFrame) -> DocumentBlocks:
    """Sparse rows (doc_id, idx, val) cut into blocks by the hash of the id; `rows` should be a written table."""
    slots = rows.sparkSession.sparkContext.defaultParallelism
    n, entries = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("idx")), F.lit(0))).first()
    blocks = max(1, min(slots, n), -(-entries // BLOCK_ENTRIES), -(-n // BLOCK_DOCS))
    kind = dict(rows.dtypes)["doc_id"]
    names = ["g", "at", "doc_id", "term", "doc", "v", "ids"]

    def pack(g: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids = pa.concat_arrays([part.column("doc_id") for part in held])
        lengths = np.concatenate([np.asarray(part.column("idx").value_lengths()) for part in held])
        term = np.concatenate([np.asarray(part.column("idx").flatten()) for part in held]).astype(np.int32, copy=False)
        weight = np.concatenate([np.asarray(part.column("val").flatten()) for part in held])
        held.clear()
        order = np.argsort(term, kind="stable")  # documents are in order already
        weight, term = weight[order], term[order]
        doc = np.repeat(np.arange(len(doc_ids), dtype=np.int32), lengths)[order]
        del order
        needed = term[_bounds(term)[:-1]]
        first = np.flatnonzero(np.diff(needed // TERM_BLOCK, prepend=-1))
        ids = [x.astype(np.uint8) for x in np.split(needed % TERM_BLOCK, first[1:])] if len(needed) else []

        def batch(at: np.ndarray, doc_id=None, entries=None, need=None) -> pa.RecordBatch:
            size = len(at)
            columns = [pa.array(np.full(size, g, np.int32)), pa.array(at.astype(np.int32)),
                       pa.nulls(size, doc_ids.type) if doc_id is None else doc_id]
            columns += [pa.nulls(size, pa.binary())] * 3 if entries is None else [_bytes(x) for x in entries]
            columns += [pa.nulls(size, pa.binary()) if need is None else _bytes(need)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        yield batch(np.arange(len(doc_ids)), doc_id=doc_ids)
        for at, lo in enumerate(range(0, len(term), PART_ENTRIES)):
            yield batch(np.array([at]), entries=[[x[lo: lo + PART_ENTRIES]] for x in (term, doc, weight)])
        yield batch(needed[first] // TERM_BLOCK if len(needed) else needed, need=ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for g, part in _runs(batch, "g"):
                if g != now:
                    if held:
                        yield from pack(now, held)
                    now, held = g, []
                held.append(part)
        if held:
            yield from pack(now, held)

    schema = f"g int, at int, doc_id {kind}, term binary, doc binary, v binary, ids binary"
    numbered = rows.withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))
    return DocumentBlocks(written(numbered.repartitionById(blocks, F.col("g")).sortWithinPartitions("g").mapInArrow(run, schema)), kind, blocks)


def _runs(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The parts of a batch between changes of these integer columns, with their values."""
    keys = np.stack([np.asarray(batch.column(c)) for c in columns], axis=1)
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
        if lo < hi:
            key = keys[lo].tolist()
            yield (key[0] if len(key) == 1 else tuple(key)), batch.slice(lo, hi - lo)


def _matrix(data: bytes, width: int, kind: type = np.float64) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, width)


@dataclass
class Basis:
    """Blocks (block, v) of a matrix of this kind of numbers, and the matrix that makes its columns orthonormal."""

    blocks: DataFrame
    kind: type
    turn: np.ndarray

    @property
    def width(self) -> int:
        return self.turn.shape[1]


# ---------------------------------------------------------------- the basis as a table

def _in_tree(parts: DataFrame, combine: Callable[[list[np.ndarray]], np.ndarray], width: int) -> np.ndarray | None:
    """Matrices (v) of one width combined FAN_IN at a time until one task's share is left; that one comes to the driver."""
    def run(batches):
        held = []
        for batch in batches:
            for data in batch.column(0):
                held.append(_matrix(data.as_py(), width))
                if len(held) == FAN_IN:
                    held = [combine(held)]
        if held:
            yield pa.RecordBatch.from_arrays([_bytes([combine(held)])], names=["v"])

    parts = parts.select("v")
    while (n := parts.count()) > FAN_IN:
        parts = written(parts.repartition(-(-n // FAN_IN)).mapInArrow(run, "v binary"))
    left = [_matrix(r.v, width) for r in parts.collect()]  # FAN_IN matrices at most
    return combine(left) if left else None


def _triangle(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(parts), mode="r")


def _whitening(triangle: np.ndarray) -> tuple[np.ndarray, bool]:
    """T so that the columns of Z T are orthonormal, for Z with this triangle, without the directions that Z hardly has;
    and whether once is enough."""
    _, size, turned = np.linalg.svd(triangle)
    kept = size > RANK_LIMIT * size[0] if len(size) and size[0] > 0 else np.zeros(len(size), bool)
    return turned[: len(size)][kept].T / size[kept], bool(kept.any()) and size[kept][-1] > SOUND_LIMIT * size[0]


def _turned(basis: Basis, turn: np.ndarray) -> DataFrame:
    """Blocks of the columns of the basis times a matrix, in doubles."""
    turn, kind = basis.turn @ turn, basis.kind

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _bytes([_matrix(x.as_py(), len(turn), kind) @ turn for x in batch.column(1)])], names=["block", "v"])

    return basis.blocks.mapInArrow(run, BASIS)


def _with_triangles(batches: Iterator[tuple[int, np.ndarray]], width: int) -> Iterator[pa.RecordBatch]:
    """Blocks as rows (block, v, r), and a last row with the triangle of all of them."""
    names, held, size, triangle = ["block", "v", "r"], [], 0, []
    for block, rows in batches:
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), _bytes([rows]), pa.nulls(1, pa.binary())], names=names)
        held.append(rows.astype(np.float64))
        size += len(rows)
        if size > 8 * width:
            triangle, held, size = [_triangle(triangle + held)], [], 0
    if held or triangle:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), _bytes([_triangle(triangle + held)])], names=names)


SUMS = BASIS + ", r binary"


def _start(spark: SparkSession, terms: int, width: int, seed: int) -> DataFrame:
    def run(batches):
        def blocks():
            for batch in batches:
                for block in batch.column(0).to_pylist():
                    rows = min(TERM_BLOCK, terms - block * TERM_BLOCK)
                    yield block, np.random.default_rng([seed, block]).standard_normal((rows, width))

        yield from _with_triangles(blocks(), width)

    return written(spark.range(-(-terms // TERM_BLOCK)).selectExpr("cast(id as int) as block").mapInArrow(run, SUMS))


def _orthonormal(sums: DataFrame, width: int, kind: type = np.float64) -> Basis:
    """The basis of sums (block, v, r); it is written anew and measured again where the sums are nearly dependent."""
    triangles = sums.where("r is not null").select(F.col("r").alias("v"))
    turn, sound = _whitening(_in_tree(triangles, _triangle, width))
    basis = Basis(sums.where("block is not null").select("block", "v"), kind, turn)
    if sound or not turn.size:
        return basis
    width = basis.width

    def run(batches):
        yield from _with_triangles(((b, _matrix(v, width)) for batch in batches for b, v in zip(*(c.to_pylist() for c in batch.columns))), width)

    again = written(_turned(basis, np.eye(width)).mapInArrow(run, SUMS))
    turn, _ = _whitening(_in_tree(again.where("r is not null").select(F.col("r").alias("v")), _triangle, width))
    return Basis(again.where("block is not null").select("block", "v"), np.float64, turn)


# ---------------------------------------------------------------- a pass

def _needed_rows(basis: Basis, docs: DocumentBlocks, wire: type) -> DataFrame:
    """(g, block, v): the rows of the basis that each document block needs, as numbers of the kind `wire`."""
    turn, kind = basis.turn, basis.kind

    def run(batches):
        now, rows = None, None
        for batch in batches:
            blocks, roles = batch.column("block").to_pylist(), batch.column("role").to_pylist()
            out = []
            for i, (block, role) in enumerate(zip(blocks, roles)):
                if role == 0:
                    now, rows = block, (_matrix(batch.column("v")[i].as_py(), len(turn), kind) @ turn).astype(wire)
                elif block == now:
                    out.append((i, rows[np.frombuffer(batch.column("ids")[i].as_py(), np.uint8)]))
            if out:
                at = pa.array([i for i, _ in out])
                yield pa.RecordBatch.from_arrays([batch.column("g").take(at), batch.column("block").take(at), _bytes([v for _, v in out])], names=["g", "block", "v"])

    nothing = F.lit(None)
    both = basis.blocks.select("block", F.lit(0).alias("role"), nothing.cast("int").alias("g"), "v", nothing.cast("binary").alias("ids")).unionByName(
        docs.needs().select("block", F.lit(1).alias("role"), "g", nothing.cast("binary").alias("v"), "ids"))
    return both.repartition("block").sortWithinPartitions("block", "role").mapInArrow(run, "g int, block int, v binary")


def _over_blocks(docs: DocumentBlocks, basis: Basis, finish: Callable, schema: str, wire: type = np.float64, with_ids: bool = False) -> DataFrame:
    """finish(product, entries, ids) for each document block; product is its part of A Q, one row per document with
    entries, entries its (term, doc, value) by term."""
    width = basis.width

    def run(batches):
        now, state = None, None

        def done():
            if not state or not state["filled"]:
                return
            term, doc, value = state["entries"]
            bounds = np.append(0, np.cumsum(np.bincount(doc)))
            order = np.argsort(doc, kind="stable")
            sorted_value = value[order]
            local = np.cumsum(np.diff(term, prepend=-1) != 0, dtype=np.int32)
            local -= 1
            local = local[order]
            del order
            y = _sums(bounds, local, sorted_value, state.pop("needed"))
            del local, sorted_value
            yield from finish(y, state.pop("entries"), state["ids"])

        for batch in batches:
            for (g, kind), part in _runs(batch, "g", "kind"):
                if g != now:
                    yield from done()
                    now, state = g, {"ids": [], "parts": [], "filled": 0}
                if kind == 0:
                    state["ids"].append(part.column("doc_id"))
                elif kind == 1:
                    state["parts"] += [_entries(*x, wire) for x in zip(*(part.column(c) for c in ("term", "doc", "v")))]
                elif state["parts"] or "entries" in state:
                    if "entries" not in state:  # all of them came before; the rows that their terms need go where they belong
                        state["entries"] = _joined(state.pop("parts"))
                        state["parts"] = []
                        state["needed"] = np.empty((len(_bounds(state["entries"][0])) - 1, width), wire)
                    for v in part.column("v"):
                        rows = _matrix(v.as_py(), width, wire)
                        state["needed"][state["filled"]: state["filled"] + len(rows)] = rows
                        state["filled"] += len(rows)
        yield from done()

    none = {c: F.lit(None).cast("binary").alias(c) for c in ("term", "doc", "v")}
    no_id = F.lit(None).cast(docs.id_type).alias("doc_id")
    both = docs.entries().select("g", F.lit(1).alias("kind"), "at", no_id, "term", "doc", "v").unionByName(
        _needed_rows(basis, docs, wire).select("g", F.lit(2).alias("kind"), F.col("block").alias("at"), no_id, none["term"], none["doc"], "v"))
    if with_ids:
        both = both.unionByName(docs.documents().select("g", F.lit(0).alias("kind"), "at", "doc_id", none["term"], none["doc"], none["v"]))
    return both.repartitionById(docs.blocks, F.col("g")).sortWithinPartitions("g", "kind", "at").mapInArrow(run, schema)


def _entries(term: pa.Scalar, doc: pa.Scalar, value: pa.Scalar, kind: type) -> list[np.ndarray]:
    """Terms, documents and values of one row of a document block."""
    return [np.frombuffer(x.as_py(), t).astype(to, copy=False) for x, t, to in (
        (term, np.int32, np.int32), (doc, np.int32, np.int32), (value, np.float64, kind))]


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The columns of all parts, one after the other, so that only one of them is there twice."""
    out = []
    for _ in range(len(parts[0])):
        out.append(np.concatenate([part.pop(0) for part in parts]))
    return out


def _sums(bounds: np.ndarray, column: np.ndarray, value: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row i is the sum of value[j] * other[column[j]] for j from bounds[i] to bounds[i + 1]. Rows of equal length are
    made together, by one matrix product of a few thousand gathered rows at a time."""
    length = np.diff(bounds)
    out = np.zeros((len(length), other.shape[1]), other.dtype)
    order = np.argsort(length, kind="stable")
    first = np.flatnonzero(np.diff(length[order], prepend=0))
    for lo, hi in zip(first, [*first[1:], len(order)]):
        size = int(length[order[lo]])
        step = max(1, GATHERED // size)
        for at in range(lo, hi, step):
            rows = order[at: min(at + step, hi)]
            taken = bounds[rows][:, None] + np.arange(size)
            out[rows] = np.matmul(value[taken][:, None, :], other[column[taken]])[:, 0]
    return out


def _bounds(key: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys begin, and the end of the last one."""
    return np.append(np.flatnonzero(np.diff(key, prepend=-1)), len(key))


def _sparse_times(row: np.ndarray, column: np.ndarray, value: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that occur in a sparse matrix and their products with a dense one: through a small dense matrix where
    that is not much larger than the entries, else by sums of gathered rows."""
    rows, at = np.unique(row, return_inverse=True)
    if len(rows) * len(other) <= min(DENSE_FACTOR * len(value), DENSE_CELLS):
        small = np.zeros((len(rows), len(other)), other.dtype)
        small[at, column] = value
        return rows, small @ other
    order = np.argsort(at, kind="stable")
    return rows, _sums(_bounds(at[order]), column[order], value[order], other)


def _shared_basis(basis: Basis, terms: int, wire: type) -> Broadcast:
    """All rows of a basis of bounded size, for every task."""
    rows = np.zeros((terms, basis.width), wire)
    for batch in basis.blocks.select("block", "v").toArrow().to_batches():
        for block, v in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows[block * TERM_BLOCK: (block + 1) * TERM_BLOCK] = _matrix(v.as_py(), len(basis.turn), basis.kind) @ basis.turn
    return basis.blocks.sparkSession.sparkContext.broadcast(rows)


def _times(part: pa.RecordBatch, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The product of sparse rows (doc_id, idx, val) with a dense matrix; bounds, terms and values of the rows."""
    bounds = np.append(0, np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(part.column(1)), 0), np.int64)))
    term, value = np.asarray(part.column(1).flatten()), np.asarray(part.column(2).flatten()).astype(other.dtype, copy=False)
    return _sums(bounds, term, value, other), bounds, term, value


def _row_sums(docs: DocumentRows, shared: Broadcast, terms: int, width: int, wire: type) -> DataFrame:
    """(block, ids, v): each task's part of A'(A Q) for the terms that it meets."""
    def run(batches):
        basis, total, met = shared.value, None, np.zeros(terms, bool)
        for batch in batches:
            for part in kernels.pieces(batch, 1):
                y, bounds, term, value = _times(part, basis)
                total = np.zeros((terms, width), wire) if total is None else total
                doc = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(bounds))
                order = np.argsort(term, kind="stable")
                own = _bounds(term[order])
                there = term[order[own[:-1]]]
                met[there] = True
                total[there] += _sums(own, doc[order], value[order], y)
        for at in range(0, terms if total is not None else 0, 64 * TERM_BLOCK):
            known = at + np.flatnonzero(met[at: at + 64 * TERM_BLOCK])
            first = _bounds(known // TERM_BLOCK)
            if len(known):
                yield pa.RecordBatch.from_arrays([
                    pa.array(known[first[:-1]] // TERM_BLOCK, pa.int32()), _bytes(np.split((known % TERM_BLOCK).astype(np.uint8), first[1:-1])),
                    _bytes(np.split(total[known], first[1:-1]))], names=["block", "ids", "v"])

    return docs.read().mapInArrow(run, "block int, ids binary, v binary")


def _row_products(docs: DocumentRows, shared: Broadcast) -> DataFrame:
    """(doc_id, y): the rows of A Q; packed doubles."""
    def run(batches):
        for batch in batches:
            for part in kernels.pieces(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), kernels.packed_column(_times(part, shared.value)[0])], names=["doc_id", "y"])

    return docs.read().mapInArrow(run, f"doc_id {docs.id_type}, y binary")


def _gram_times(docs: DocumentRows | DocumentBlocks, basis: Basis, terms: int, wire: type) -> DataFrame:
    """A'(A Q) as blocks of the kind `wire`, with the triangles of the tasks' rows: a written table (block, v, r)."""
    width = basis.width

    def give(y, entries, _):
        term, doc, value = entries
        bounds = _bounds(term)
        needed = term[bounds[:-1]]
        first = _bounds(needed // TERM_BLOCK)  # of the terms of a term block
        for at in range(0, len(first) - 1, 64):
            cuts = first[at: at + 65]
            own = needed[cuts[0]: cuts[-1]]
            sums = _sums(bounds[cuts[0]: cuts[-1] + 1], doc, value, y)
            inner = cuts[1:-1] - cuts[0]
            yield pa.RecordBatch.from_arrays([
                pa.array(needed[cuts[:-1]] // TERM_BLOCK, pa.int32()), _bytes(np.split((own % TERM_BLOCK).astype(np.uint8), inner)),
                _bytes(np.split(sums, inner))], names=["block", "ids", "v"])

    def add(batches):
        def blocks():
            now, total = None, None
            for batch in batches:
                for block, ids, v in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                    if block != now:
                        if now is not None:
                            yield now, total
                        now, total = block, np.zeros((min(TERM_BLOCK, terms - block * TERM_BLOCK), width), wire)
                    total[np.frombuffer(ids.as_py(), np.uint8)] += _matrix(v.as_py(), width, wire)
            if now is not None:
                yield now, total

        yield from _with_triangles(blocks(), width)

    def sums(parts: DataFrame) -> DataFrame:
        with shuffles_freed(parts.sparkSession):
            return written(parts.repartition("block").sortWithinPartitions("block").mapInArrow(add, SUMS))

    if isinstance(docs, DocumentBlocks):
        return sums(_over_blocks(docs, basis, give, "block int, ids binary, v binary", wire))
    shared = _shared_basis(basis, terms, wire)
    found = sums(_row_sums(docs, shared, terms, width, wire))
    shared.destroy()
    return found


def _products(docs: DocumentRows | DocumentBlocks, basis: Basis, terms: int) -> DataFrame:
    """(doc_id, y): the rows of A Q, for documents with entries; packed doubles, a written table."""
    def give(y, _, ids):
        ids = pa.chunked_array(ids).combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        for at in range(0, len(y), 4096):
            yield pa.RecordBatch.from_arrays([ids.slice(at, min(4096, len(y) - at)), kernels.packed_column(y[at: at + 4096])], names=["doc_id", "y"])

    if isinstance(docs, DocumentBlocks):
        with shuffles_freed(basis.blocks.sparkSession):
            return written(_over_blocks(docs, basis, give, f"doc_id {docs.id_type}, y binary", with_ids=True))
    shared = _shared_basis(basis, terms, np.float64)
    found = written(_row_products(docs, shared))
    shared.destroy()
    return found


def _gram_within(products: DataFrame, width: int) -> np.ndarray:
    """Y'Y of the rows of a written table (doc_id, y)."""
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                y = kernels.unpacked(batch.column(0))
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([_bytes([total])], names=["v"])

    small = _in_tree(written(products.select("y").mapInArrow(run, "v binary")), np.add.reduce, width)
    return np.zeros((width, width)) if small is None else small


def _embedded(products: DataFrame, turn: np.ndarray, id_type: str, documents: DataFrame) -> DataFrame:
    """(doc_id, embedding): the rows times a matrix; documents without a row get zeros."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), kernels.list_column(kernels.unpacked(batch.column(1)) @ turn, pa.float64())], names=["doc_id", "embedding"])

    known = products.mapInArrow(run, f"doc_id {id_type}, embedding array<double>")
    return documents.select("doc_id").join(known, "doc_id", "left").select(
        "doc_id", F.coalesce("embedding", F.array_repeat(F.lit(0.0), turn.shape[1])).alias("embedding"))


def _signs(basis: Basis, turn: np.ndarray) -> np.ndarray:
    """The sign of the entry of largest magnitude of every column of the basis times a matrix; of equal ones the first term's."""
    turn, kind = basis.turn @ turn, basis.kind

    def run(batches):
        top, at, sign = np.full(turn.shape[1], -1.0), np.zeros(turn.shape[1], np.int64), np.ones(turn.shape[1])
        for batch in batches:
            for block, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = _matrix(v.as_py(), len(turn), kind) @ turn
                place = np.abs(rows).argmax(axis=0)
                value, term = rows[place, np.arange(rows.shape[1])], block * TERM_BLOCK + place
                better = (np.abs(value) > top) | ((np.abs(value) == top) & (term < at))
                top[better], at[better], sign[better] = np.abs(value)[better], term[better], np.where(value < 0, -1.0, 1.0)[better]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(top), dtype=np.int32)), pa.array(top), pa.array(-at), pa.array(sign)], names=["c", "top", "at", "sign"])

    found = basis.blocks.mapInArrow(run, "c int, top double, at bigint, sign double")
    best = found.groupBy("c").agg(F.max(F.struct("top", "at", "sign")).alias("best")).select("c", "best.sign").collect()  # a row for each column
    out = np.ones(turn.shape[1])
    for c, sign in best:
        out[c] = sign
    return out


def _fit(docs: DocumentRows | DocumentBlocks, terms: list[str], k: int, seed: int, power_steps: int, oversamples: int, exact_steps: int) -> tuple[LsiModel, DataFrame | None, np.ndarray]:
    """The model, the written products of the documents with the last basis, and the matrix from these to embeddings."""
    spark, width = docs.table.sparkSession, min(k + oversamples, len(terms))
    if not width:
        return LsiModel(terms, spark.createDataFrame([], BASIS), np.zeros(k)), None, np.zeros((0, k))
    basis = _orthonormal(_start(spark, len(terms), width, seed), width)
    for step in range(power_steps):
        wire = np.float32 if step < power_steps - exact_steps else np.float64
        sums = _gram_times(docs, basis, len(terms), wire)
        if sums.isEmpty():  # no document has a term
            break
        basis = _orthonormal(sums, basis.width, wire)
    products = _products(docs, basis, len(terms))
    values, spin = np.linalg.eigh(_gram_within(products, basis.width))
    order = np.argsort(-values)[:k]
    turn = spin[:, order] * _signs(basis, spin[:, order])
    missing = k - len(order)  # a corpus of lower rank: directions without weight
    turn = np.hstack([turn, np.zeros((len(turn), missing))])
    singular = np.append(np.sqrt(np.maximum(values[order], 0)), np.zeros(missing))
    return LsiModel(terms, _turned(basis, turn), singular), products, turn


def fit_lsi(rows: DataFrame, terms: list[str], k: int = 200, seed: int = 42, power_steps: int = 5, oversamples: int = OVERSAMPLES, exact_steps: int = 0) -> LsiModel:
    """Randomized range finder on the term side, then a small eigenproblem. One pass over the documents per step and half a
    one at the end; the last `exact_steps` steps send doubles, the others single precision."""
    return _fit(documents_of(written(rows), len(terms), k + oversamples), terms, k, seed, power_steps, oversamples, exact_steps)[0]


def project(rows: DataFrame, model: LsiModel, documents: DataFrame) -> DataFrame:
    """(doc_id, embedding) for every document; one without known terms is the zero vector."""
    docs = documents_of(rows, len(model.terms), model.k)
    return _embedded(_products(docs, Basis(model.directions, np.float64, np.eye(model.k)), len(model.terms)), np.eye(model.k), docs.id_type, documents)


def lsi_embed(
    rows: DataFrame, terms: list[str], documents: DataFrame, k: int = 200, seed: int = 42, power_steps: int = 5, oversamples: int = OVERSAMPLES,
    exact_steps: int = 0,
) -> tuple[DataFrame, LsiModel]:
    """Embeddings of all documents and the fitted model, from sparse TF-IDF rows."""
    docs = documents_of(written(rows), len(terms), k + oversamples)
    model, products, turn = _fit(docs, terms, k, seed, power_steps, oversamples, exact_steps)
    if products is None:
        return documents.select("doc_id", F.array_repeat(F.lit(0.0), k).alias("embedding")), model
    return _embedded(products, turn, docs.id_type, documents), model


def embed_texts(tokens: DataFrame, vocab: DataFrame, n_docs: int, model: LsiModel) -> DataFrame:
    """(doc_id, embedding) of texts (doc_id, tokens) outside the corpus, by the corpus' vocabulary and number of documents."""
    rows, names = tfidf_rows(tokens, vocab, n_docs)
    if names != model.terms:
        raise ValueError("the vocabulary is not the one the model was fitted on")
    return project(written(rows), model, tokens)


def direction_rows(model: LsiModel) -> DataFrame:
    """(at, direction): a row for each term in index order."""
    width = model.k

    def run(batches):
        for batch in batches:
            for block, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = _matrix(v.as_py(), width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block * TERM_BLOCK + np.arange(len(rows), dtype=np.int64)), kernels.list_column(rows, pa.float64())], names=["at", "direction"])

    return model.directions.mapInArrow(run, "at bigint, direction array<double>")


def save_model(spark: SparkSession, model: LsiModel, path: str) -> None:
    """The model as three tables: a row for each term, the blocks of directions, and the singular values."""
    names = spark.createDataFrame(pa.table({"at": np.arange(len(model.terms)), "term": model.terms}))
    names.write.mode("overwrite").parquet(f"{path}/terms")
    model.directions.write.mode("overwrite").parquet(f"{path}/directions")
    spark.createDataFrame(pa.table({"at": np.arange(model.k), "value": model.singular_values})).write.mode("overwrite").parquet(f"{path}/values")


def load_model(spark: SparkSession, path: str) -> LsiModel:
    """A saved model; its terms were bounded when it was fitted."""
    names = spark.read.parquet(f"{path}/terms").orderBy("at").toArrow().column("term").to_pylist()
    values = spark.read.parquet(f"{path}/values").orderBy("at").toArrow().column("value").to_numpy()
    return LsiModel(names, spark.read.parquet(f"{path}/directions"), values)
