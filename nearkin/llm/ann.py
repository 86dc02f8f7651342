"""Approximate nearest neighbours by largest inner product, with cross-polytope hashing.

A vector of length one is turned by fast Hadamard pseudo-rotations (three times: signs, then the Hadamard transform) and falls to
the nearest signed axis. `depth` such axes are a bucket of a table: the first is its cell, the others tell buckets apart within
a cell. A query probes, in every table, all buckets whose axes it is nearly as close to as to its own: the sum of its
coordinates along them is at most `slack` below that of the best bucket. The slack is fitted on at most SAMPLE queries
against all rows, as the quantile `target` of what their true neighbours need; every row is indexed. Queries that find fewer
than k + 1 vectors are asked again with all buckets, which is exact.

Vectors of a table meet queries of their own dimension only. They are kept apart by length, in bands of a quarter, since within
a band the largest inner product is nearly the smallest angle.

How it runs. Equal vectors are one class (a key of 128 bits) with its k + 1 smallest ids: no others can be in an
answer, so copies cost nothing however many. Cells are dealt out in slices of about SLICE_ROWS classes; a task holds one slice
and streams the queries that probe the cell. Candidates are never paired in a table: a task keeps the best k + 1 of each
query. What is kept is scored once more, by adding up products in the order of components in double precision, so a pair
has one score wherever it is found.

Defined results: rows and queries without id, and vectors that are null, zero, or hold a null or a value that is not finite,
take no part; pairs whose product is not a number are no answer. Rows equal in id and vector count once, rows of one id
with different vectors are candidates of their own, and such a query takes the vector of the smaller key. Ties go to smaller
ids. No query or no row gives an empty table. Extra columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.llm.arrays import tidy
from nearkin.plans.scale import fits_broadcast, written

SAMPLE = 256
SLICE_ROWS = 4096
QUERIES_AT_ONCE = 512
BUCKET_ROWS = 32
BAND = math.log(1.25)
DENSE = 0.03
GROUP = ["dim", "band", "tab", "cell", "slice"]


@dataclass(frozen=True)
class Hashing:
    """So many tables of `depth` axes each; the signs follow from the seed."""

    tables: int
    depth: int
    seed: int = 0

    def coordinates(self, unit: np.ndarray) -> np.ndarray:
        """(tables, depth, rows, signed axes): coordinates of unit vectors along all signed axes."""
        out = np.stack([np.stack([rotated(unit, signs) for signs in signs_of(unit.shape[1], t, self.depth, self.seed)]) for t in range(self.tables)])
        return np.concatenate([out, -out], axis=3)


@lru_cache(maxsize=256)
def signs_of(dim: int, table: int, depth: int, seed: int) -> np.ndarray:
    """(depth, 3, padded dimension) signs."""
    return np.random.default_rng([seed, dim, table]).choice([-1.0, 1.0], (depth, 3, 1 << max(0, (dim - 1).bit_length())))


def rotated(rows: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of signs and fast Hadamard transform; rows are filled up with zeros to a power of two."""
    size = signs.shape[1]
    out = np.zeros((len(rows), size))
    out[:, : rows.shape[1]] = rows
    for sign in signs:
        out *= sign
        span = 1
        while span < size:
            pairs = out.reshape(len(rows), size // (2 * span), 2, span)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), size)
            span *= 2
        out /= math.sqrt(size)
    return out


def unit_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at length one and the logarithms of their lengths, without overflow."""
    top = np.abs(rows).max(axis=1)
    small = rows / top[:, None]
    length = np.sqrt((small * small).sum(axis=1))
    return small / length[:, None], np.log(top) + np.log(length)


def by_dimension(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each dimension in a column of lists."""
    length, flat = np.asarray(column.value_lengths()), np.asarray(column.flatten())
    begin = np.cumsum(length) - length
    for dim in np.unique(length).tolist():
        mine = np.flatnonzero(length == dim)
        yield mine, flat[begin[mine][:, None] + np.arange(dim)]


def list_array(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.ravel(), kind))


def sound(vector: Column) -> Column:
    """Is the vector free of nulls and values that are not finite, and not zero?"""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def keyed(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector and the vector's key (k1, k2) of rows that take part."""
    df = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return df.where(F.col("id").isNotNull() & sound(F.col("vector"))).select(
        "id", "vector", F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), "vector").alias("k2"))


CLASS = "k1 bigint, k2 bigint, vector array<double>"


def classes_of(rows: DataFrame, ids_kept: int) -> DataFrame:
    """k1, k2, vector and the smallest ids of each distinct vector. Vectors and ids are combined apart and joined in place."""
    order = Window.partitionBy("k1", "k2").orderBy("id")
    ids = rows.select("k1", "k2", "id").distinct().withColumn("at", F.row_number().over(order)).where(F.col("at") <= ids_kept)
    ids = ids.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return rows.groupBy("k1", "k2").agg(F.first("vector").alias("vector")).join(ids, ["k1", "k2"])


def hash_rows(hashing: Hashing):
    """Classes with their dimension, band of length and the axes of all tables (codes, by table and depth)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine, rows in by_dimension(batch.column("vector")):
                for at in range(0, len(mine), SLICE_ROWS):
                    some = mine[at: at + SLICE_ROWS]
                    unit, length = unit_rows(rows[at: at + SLICE_ROWS])
                    codes = hashing.coordinates(unit).argmax(axis=3).astype(np.int32)
                    codes = codes.reshape(-1, len(some)).T
                    whole = batch.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays(
                        [*whole.columns, pa.array(np.full(len(some), rows.shape[1], np.int32)), pa.array(np.rint(length / BAND).astype(np.int32)),
                         list_array(codes, pa.int32())], names=["k1", "k2", "vector", "ids", "dim", "band", "codes"])

    return run, CLASS + ", ids array<bigint>, dim int, band int, codes array<int>"


def probe_cells(hashing: Hashing, slack: float):
    """Queries with the cells they probe, one row for each: those within the slack of the best by their first axis."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine, rows in by_dimension(batch.column("vector")):
                for at in range(0, len(mine), QUERIES_AT_ONCE):
                    first = hashing.coordinates(unit_rows(rows[at: at + QUERIES_AT_ONCE])[0])[:, 0]
                    tab, query, cell = np.nonzero(first >= first.max(axis=2, keepdims=True) - slack)
                    whole = batch.take(pa.array(mine[at + query]))
                    n = len(query)
                    yield pa.RecordBatch.from_arrays(
                        [*whole.columns, pa.array(np.full(n, rows.shape[1], np.int32)), pa.array(tab.astype(np.int32)), pa.array(cell.astype(np.int32))],
                        names=["k1", "k2", "vector", "dim", "tab", "cell"])

    return run, CLASS + ", dim int, tab int, cell int"


def in_order(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, added up from the first component to the last."""
    return np.cumsum(left * right, axis=1)[:, -1]


def best_pairs(queries: np.ndarray, rows: np.ndarray, probed: np.ndarray, first_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and score of the k best rows of each query among the probed ones; ties go to the smaller first id."""
    with np.errstate(all="ignore"):
        if probed.mean() > DENSE:
            score = np.where(probed, queries @ rows.T, -np.inf)
        else:
            score = np.full(probed.shape, -np.inf)
            query, row = np.nonzero(probed)
            for at in range(0, len(query), 1 << 16):
                q, r = query[at: at + (1 << 16)], row[at: at + (1 << 16)]
                score[q, r] = np.einsum("ij,ij->i", queries[q], rows[r])
        score[np.isnan(score)] = -np.inf
        least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k] if score.shape[1] > k else np.full(len(score), -np.inf)
        off = 1e-12 * np.sqrt((queries**2).sum(axis=1)) * np.sqrt((rows**2).sum(axis=1).max())  # what the order of a sum may change
        least = np.where(np.isfinite(off) & np.isfinite(least), least - off, least)
        query, row = np.nonzero(probed & (score >= least[:, None]))
        exact = np.concatenate([in_order(queries[query[a: a + (1 << 16)]], rows[row[a: a + (1 << 16)]]) for a in range(0, max(len(query), 1), 1 << 16)])
    order = np.lexsort((first_id[row], -exact, query))
    order = order[~np.isnan(exact[order])]
    query, row, exact = query[order], row[order], exact[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], row[place < k], exact[place < k]


def search_cells(hashing: Hashing, slack: float, k: int):
    """Rows of a slice, then the queries that probe its cell, to the best k classes of each query in the slice."""
    names = ["q1", "q2", "tab", "k1", "k2", "ids", "score"]

    def answer(tab: int, cell: int, held: tuple, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table, rows, buckets, of_bucket, first_id = held
        _, vectors = next(by_dimension(part.column("vector")))
        for at in range(0, part.num_rows, QUERIES_AT_ONCE):
            queries = vectors[at: at + QUERIES_AT_ONCE]
            along = hashing.coordinates(unit_rows(queries)[0])[tab]
            total = along[0][:, cell][:, None] + sum(along[j][:, buckets[:, j - 1]] for j in range(1, hashing.depth))
            probed = (total >= along.max(axis=2).sum(axis=0)[:, None] - slack)[:, of_bucket]
            query, row, score = best_pairs(queries, rows, probed, first_id, k)
            if len(query):
                asked, found = part.take(pa.array(at + query)), table.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [asked.column("k1"), asked.column("k2"), pa.array(np.full(len(query), tab, np.int32)), found.column("k1"), found.column("k2"),
                     found.column("ids"), pa.array(score)], names=names)

    def hold(parts: list[pa.RecordBatch]) -> tuple:
        table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        _, rows = next(by_dimension(table.column("vector")))
        _, axes = next(by_dimension(table.column("axes")))
        buckets, of_bucket = np.unique(axes, axis=0, return_inverse=True)
        ids = table.column("ids")
        first_id = np.asarray(ids.flatten())[np.cumsum(np.asarray(ids.value_lengths())) - np.asarray(ids.value_lengths())]
        return table, rows, buckets, of_bucket.ravel(), first_id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = None, [], None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)) for c in (*GROUP, "kind")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if lo == hi:
                    continue
                group, kind = tuple(keys[lo, :-1].tolist()), keys[lo, -1]
                if group != now:
                    now, parts, held = group, [], None
                part = batch.slice(lo, hi - lo)
                if kind == 0:
                    parts.append(part)
                elif parts:
                    held = held or hold(parts)
                    yield from answer(group[2], group[3], held, part)

    return run, "q1 bigint, q2 bigint, tab int, k1 bigint, k2 bigint, ids array<bigint>, score double"


@dataclass
class Index:
    """All classes of a table of vectors with their buckets (a written table), and how many of a cell there are."""

    classes: DataFrame
    cells: DataFrame
    hashing: Hashing
    k: int

    def answers(self, asked: DataFrame, slack: float) -> DataFrame:
        """q1, q2, best: the best k + 1 (score, vec_id) of each query class that its probes find, in order."""
        hashing, most = self.hashing, self.k + 1
        near = F.broadcast if fits_broadcast(self.cells, 24) else (lambda df: df)
        slices = F.ceil(F.col("rows") / SLICE_ROWS).cast("int")
        tables = F.transform(F.sequence(F.lit(0), F.lit(hashing.tables - 1)), lambda t: F.struct(
            t.alias("tab"), F.get("codes", t * hashing.depth).alias("cell"), F.slice("codes", t * hashing.depth + 2, hashing.depth - 1).alias("axes")))
        rows = self.classes.select("k1", "k2", "vector", "ids", "dim", "band", F.inline(tables)).join(near(self.cells), ["dim", "band", "tab", "cell"])
        rows = rows.select("dim", "band", "tab", "cell", F.pmod(F.xxhash64("k2", "k1"), slices).cast("int").alias("slice"), F.lit(0).alias("kind"),
                           "k1", "k2", "vector", "ids", "axes")
        probes, schema = probe_cells(hashing, slack)
        asked = asked.select("k1", "k2", "vector").mapInArrow(tidy(probes), schema).join(near(self.cells), ["dim", "tab", "cell"])
        asked = asked.select("dim", "band", "tab", "cell", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), F.lit(1).alias("kind"), "k1", "k2",
                             "vector", F.lit(None).cast("array<bigint>").alias("ids"), F.lit(None).cast("array<int>").alias("axes"))
        search, schema = search_cells(hashing, slack, most)
        found = rows.unionByName(asked).repartition(*GROUP).sortWithinPartitions(*GROUP, "kind").mapInArrow(tidy(search), schema)
        found = found.select("q1", "q2", "tab", "k1", "k2", "score", F.explode("ids").alias("vec_id"))
        for keys in (["q1", "q2", "tab"], ["q1", "q2"]):  # first within a table, where a vector is found once
            if len(keys) == 2:
                found = found.dropDuplicates(["q1", "q2", "k1", "k2", "vec_id"])
            order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
            found = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most)
        return found.groupBy("q1", "q2").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "score", "vec_id"))), lambda x: F.struct(
            x["score"].alias("score"), x["vec_id"].alias("vec_id"))).alias("best"))


def build(rows: DataFrame, k: int, tables: int = 2, depth: int | None = None, seed: int = 0) -> Index:
    """The index of keyed rows. Without a depth there are so many axes that a bucket has about BUCKET_ROWS classes."""
    classes = written(classes_of(rows, k + 1))
    n, dim = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    if depth is None:
        axes = 2 << max(0, ((dim or 1) - 1).bit_length())
        depth = max(2, math.ceil(math.log(max(n, 1) / BUCKET_ROWS) / math.log(max(axes, 2)))) if n else 2
    hashing = Hashing(tables, depth, seed)
    run, schema = hash_rows(hashing)
    hashed = written(classes.select("k1", "k2", "vector", "ids").mapInArrow(tidy(run), schema))
    heads = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.struct(t.alias("tab"), F.get("codes", t * depth).alias("cell")))
    cells = written(hashed.select("dim", "band", F.inline(heads)).groupBy("dim", "band", "tab", "cell").agg(F.count("*").alias("rows")))
    return Index(hashed, cells, hashing, k)


def fit_slack(index: Index, asked: DataFrame, target: float) -> float:
    """The slack with which the share `target` of the true neighbours of at most SAMPLE queries is found.

    The sample (the smallest keys) goes to all tasks; the true neighbours come from one pass over all classes.
    """
    sample = asked.select("k1", "k2", "vector").orderBy("k1", "k2").limit(SAMPLE).toArrow().combine_chunks()
    hashing, k = index.hashing, index.k
    if sample.num_rows == 0:
        return 0.0
    batch = sample.to_batches()[0]
    shared = index.classes.sparkSession.sparkContext.broadcast((np.asarray(batch.column("k1")), np.asarray(batch.column("k2")), [
        (mine, queries, hashing.coordinates(unit_rows(queries)[0])) for mine, queries in by_dimension(batch.column("vector"))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k1, k2, parts = shared.value
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for mine, queries, along in parts:
                own = np.flatnonzero(dims == queries.shape[1])
                for at in range(0, len(own), SLICE_ROWS):
                    block = batch.take(pa.array(own[at: at + SLICE_ROWS]))
                    _, rows = next(by_dimension(block.column("vector")))
                    _, codes = next(by_dimension(block.column("codes")))
                    r1, r2 = np.asarray(block.column("k1")), np.asarray(block.column("k2"))
                    other = (k1[mine][:, None] != r1) | (k2[mine][:, None] != r2)
                    query, row, score = best_pairs(queries, rows, other, r1, k)
                    need = np.full(len(query), np.inf)
                    for t in range(hashing.tables):
                        best, got = along[t].max(axis=2).sum(axis=0)[query], 0
                        for j in range(hashing.depth):
                            got = got + along[t, j, query, codes[row, t * hashing.depth + j]]
                        need = np.minimum(need, best - got)
                    yield pa.RecordBatch.from_arrays([pa.array(mine[query].astype(np.int32)), pa.array(score), pa.array(need)], names=["query", "score", "need"])

    found = index.classes.select("k1", "k2", "vector", "dim", "codes").mapInArrow(tidy(run), "query int, score double, need double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "need")
    needs = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).select("need").toArrow().column("need").to_numpy()
    shared.unpersist()
    return float(np.quantile(needs, target, method="higher")) + 1e-9 if len(needs) else 0.0


def nearest(rows: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 20, tables: int = 2, depth: int | None = None,
            target: float = 0.95, seed: int = 0) -> DataFrame:
    """query_id, rank, vec_id, score: about the k rows of largest inner product with each query, never the row of its own id.

    `target` is the share of true neighbours that the fitted probes are to find.
    """
    index = build(keyed(rows, id_col, vector_col), k, tables, depth, seed)
    asked = keyed(queries, id_col, vector_col)
    names = written(asked.groupBy("id").agg(F.min(F.struct("k1", "k2")).alias("key")).select(F.col("id").alias("query_id"), "key.*"))
    kinds = written(asked.groupBy("k1", "k2").agg(F.first("vector").alias("vector")).join(names.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi"))
    first = written(index.answers(kinds, fit_slack(index, kinds, target)))
    enough = first.where(F.size("best") > k)
    short = written(kinds.join(enough.select(F.col("q1").alias("k1"), F.col("q2").alias("k2")), ["k1", "k2"], "left_anti"))
    found = enough if short.isEmpty() else enough.unionByName(index.answers(short, float("inf")))
    best = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    answers = names.join(found.select(F.col("q1").alias("k1"), F.col("q2").alias("k2"), "best"), ["k1", "k2"])
    return answers.select("query_id", F.posexplode(best).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
