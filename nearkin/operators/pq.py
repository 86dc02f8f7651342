"""Product quantization: k-means codebooks per sub-space, codes and coded search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.functions.hashing import id_order
from nearkin.operators.adding import PARTIAL, partial_rows, summed
from nearkin.operators.search import batch_topk
from nearkin.plans.scale import collect_bounded

CODEBOOK = "m int, code int, centroid array<double>"
MAX_CODEBOOK_BYTES = 256 << 20
SEED_STEPS = 3
OVERSAMPLING = 2.0  # rows drawn in a seeding pass, for each centre
CANDIDATE_ROUNDS = 5


def _parts(rows: np.ndarray, m: int) -> np.ndarray:
    """Rows cut into m parts: (m, rows, width)."""
    return rows.reshape(len(rows), m, -1).transpose(1, 0, 2)


def _checked(rows: np.ndarray, m: int, ks: int, starts: int) -> np.ndarray:
    if len(rows) < ks:
        raise ValueError(f"{ks} centres need at least as many vectors, got {len(rows)}")
    if rows.shape[1] % m:
        raise ValueError(f"dimension {rows.shape[1]} is not divisible by {m} sub-vectors")
    if rows.nbytes * starts > MAX_CODEBOOK_BYTES:
        raise ValueError("codebooks of this size do not fit a task")
    return np.ascontiguousarray(_parts(rows, m))


def seeds_in_order(vectors: DataFrame, m: int, ks: int, starts: int = 1) -> np.ndarray:
    """Codebooks (starts, m, ks, width) made of the first ks vectors in a fixed order of ids, another one for each start."""
    books = []
    for start in range(starts):
        key = id_order(F.col("doc_id")) if start == 0 else id_order(F.concat(F.lit(f"{start}:"), F.col("doc_id").cast("string")))
        first = vectors.orderBy(key, "doc_id").limit(ks).select("vector")
        books.append(_checked(kernels.matrix(first.toArrow().column("vector")), m, ks, starts))
    return np.stack(books)


@dataclass
class Sets:
    """Centres of `starts` x m sub-spaces, as many in each as there are: sets[start * m + part] is (centres, width)."""

    m: int
    sets: list[np.ndarray]

    def nearest(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For every set its number, the rows' parts, their nearest centres and squared distances."""
        parts = np.ascontiguousarray(_parts(rows, self.m))
        for number, centres in enumerate(self.sets):
            part = parts[number % self.m]
            code, apart = kernels.nearest_with_distance(part, centres)
            yield number, part, code, apart


def _tallied(vectors: DataFrame, sets: Sets) -> tuple[list[np.ndarray], np.ndarray]:
    """Counts and sums of the rows of every centre, and the inertia of every set, in one pass over the vectors."""
    shared = vectors.sparkSession.sparkContext.broadcast(sets)
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in sets.sets])])
    width = sets.sets[0].shape[1]

    def tally(batches):
        centres = shared.value
        total, inertia = np.zeros((bounds[-1], 1 + width)), np.zeros((len(centres.sets), 1 + width))
        for batch in batches:
            if batch.num_rows:
                for number, part, code, apart in centres.nearest(kernels.matrix(batch.column(0))):
                    total[bounds[number]: bounds[number + 1]] += kernels.sums_by_code(part, code, len(centres.sets[number]))
                    inertia[number, 0] += apart.sum()
        both = np.concatenate([total, inertia])
        hit = np.flatnonzero(both[:, 0])
        yield partial_rows(hit, both[hit])

    key, sums = summed(vectors.select("vector").mapInArrow(tally, PARTIAL))  # a row for each centre and set at most
    shared.unpersist()
    whole = np.zeros((bounds[-1] + len(sets.sets), 1 + width))
    if len(key):
        whole[key] = sums
    return np.split(whole[: bounds[-1]], bounds[1:-1]), whole[bounds[-1]:, 0]


def _farthest(vectors: DataFrame, sets: Sets, empty: dict[int, int]) -> dict[int, np.ndarray]:
    """For sets with centres that lost all their rows, as many rows farthest from their centres; ties by id."""
    shared = vectors.sparkSession.sparkContext.broadcast(sets)

    def pick(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.asarray(batch.column(0))
            for number, part, _, apart in shared.value.nearest(kernels.matrix(batch.column(1))):
                if number in empty:
                    best = np.lexsort((ids, -apart))[: empty[number]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(best), number, np.int32)), pa.array(ids[best]), pa.array(apart[best]), kernels.packed_column(part[best])],
                        names=["number", "id", "apart", "v"])

    found = vectors.select(F.xxhash64("doc_id").alias("id"), "vector").mapInArrow(pick, "number int, id bigint, apart double, v binary")
    order = Window.partitionBy("number").orderBy(F.desc("apart"), "id")
    most = max(empty.values())
    table = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most).orderBy("number", "at").toArrow()
    shared.unpersist()
    number = table.column("number").to_numpy()
    rows = kernels.unpacked(table.column("v"))
    return {n: rows[number == n][:size] for n, size in empty.items()}


def _moved(vectors: DataFrame, sets: Sets, sums: list[np.ndarray], reseed: bool) -> Sets:
    """Every centre at the mean of its rows. One without rows stays where it is, or goes to a row far from its centre."""
    out = []
    for centres, total in zip(sets.sets, sums):
        held = total[:, 0] > 0
        centres = centres.copy()
        centres[held] = total[held, 1:] / total[held, :1]
        out.append(centres)
    empty = {number: int((total[:, 0] == 0).sum()) for number, total in enumerate(sums) if (total[:, 0] == 0).any()}
    if reseed and empty:
        for number, rows in _farthest(vectors, sets, empty).items():
            out[number][np.flatnonzero(sums[number][:, 0] == 0)[: len(rows)]] = rows
    return Sets(sets.m, out)


def _oversampled(vectors: DataFrame, sets: Sets, costs: np.ndarray, expected: float, salt: tuple[int, ...]) -> list[np.ndarray]:
    """Rows drawn for every set with a chance in proportion to their squared distance, `expected` of them on average."""
    shared = vectors.sparkSession.sparkContext.broadcast(sets)

    def draw(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.asarray(batch.column(0))
            for number, part, _, apart in shared.value.nearest(kernels.matrix(batch.column(1))):
                hit = np.flatnonzero(kernels.uniform(ids, number, *salt) * costs[number] < expected * apart)
                if len(hit):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hit), number, np.int32)), pa.array(ids[hit]), kernels.packed_column(part[hit])], names=["number", "id", "v"])

    drawn = vectors.select(F.xxhash64("doc_id").alias("id"), "vector").mapInArrow(draw, "number int, id bigint, v binary")
    table = collect_bounded(drawn, int(8 * expected * len(sets.sets)) + 1_000, MAX_CODEBOOK_BYTES)
    shared.unpersist()
    if table is None:
        raise ValueError("far more seeds were drawn than expected: the vectors are not finite?")
    table = table.sort_by([("number", "ascending"), ("id", "ascending")])
    number = table.column("number").to_numpy()
    rows = kernels.unpacked(table.column("v")) if table.num_rows else np.zeros((0, sets.sets[0].shape[1]))
    return [rows[number == n] for n in range(len(sets.sets))]


def _chosen(candidates: np.ndarray, weight: np.ndarray, ks: int, fill: np.ndarray, seed: int) -> np.ndarray:
    """ks centres out of weighted candidates, one by one with chances in proportion to weighted squared distance, then a few
    rounds of k-means on the candidates. Where there are too few different ones, `fill` makes up the rest."""
    rng, picked = np.random.default_rng(seed), []
    chance = weight.astype(np.float64)
    apart = np.full(len(candidates), np.inf)
    while len(picked) < ks and chance.sum() > 0:
        picked.append(int(np.searchsorted(np.cumsum(chance), rng.random() * chance.sum(), "right").clip(0, len(chance) - 1)))
        apart = np.minimum(apart, ((candidates - candidates[picked[-1]]) ** 2).sum(axis=1))
        chance = weight * apart
    centres = candidates[picked]
    for _ in range(CANDIDATE_ROUNDS):
        code = kernels.nearest_centre(candidates, centres)
        total = kernels.sums_by_code(candidates * weight[:, None], code, len(centres))
        mass = np.bincount(code, weights=weight, minlength=len(centres))
        centres[mass > 0] = total[mass > 0, 1:] / mass[mass > 0, None]
    return np.concatenate([centres, fill[: ks - len(centres)]])


def seeds_by_distance(vectors: DataFrame, m: int, ks: int, starts: int = 1, seed: int = 42) -> np.ndarray:
    """Codebooks (starts, m, ks, width) by oversampling: SEED_STEPS passes that draw about OVERSAMPLING * ks rows for each
    sub-space and start, one that weighs them by the rows they are nearest to, and a choice of ks among them."""
    fill = seeds_in_order(vectors, m, ks, starts)
    plain = [book for start in fill for book in start]
    sets = Sets(m, [book[:1] for book in plain])
    for step in range(SEED_STEPS):
        costs = _tallied(vectors, sets)[1]
        drawn = _oversampled(vectors, sets, costs, OVERSAMPLING * ks, (seed, step))
        sets = Sets(m, [np.concatenate([a, b]) for a, b in zip(sets.sets, drawn)])
    weights = [total[:, 0] for total in _tallied(vectors, sets)[0]]
    chosen = [_chosen(c, w, ks, f, seed + i) for i, (c, w, f) in enumerate(zip(sets.sets, weights, plain))]
    return np.stack(chosen).reshape(fill.shape)


SEEDINGS = {"order": seeds_in_order, "distance": seeds_by_distance}


def train_codebooks(
    vectors: DataFrame, m: int = 8, ks: int = 256, rounds: int = 5, starts: int = 1, seeding: str = "order", tolerance: float | None = None,
    reseed: bool = False,
) -> DataFrame:
    """Codebooks (m, code, centroid) from k-means over all vectors (doc_id, vector).

    All sub-spaces and all starts move in the same pass. Of several starts, each sub-space keeps the one with the least
    inertia, the first of equal ones. With a tolerance, training ends when no inertia falls by more than that share.
    """
    if seeding not in SEEDINGS:
        raise ValueError(f"unknown seeding {seeding!r}; there are {sorted(SEEDINGS)}")
    vectors = vectors.select("doc_id", "vector").filter("vector is not null")
    books = SEEDINGS[seeding](vectors, m, ks, starts)
    sets, before = Sets(m, list(books.reshape(-1, *books.shape[2:]))), None
    for _ in range(rounds):
        sums, inertia = _tallied(vectors, sets)
        if tolerance is not None and before is not None and (before - inertia <= tolerance * before).all():
            break
        sets, before = _moved(vectors, sets, sums, reseed), inertia
    trained = np.stack(sets.sets).reshape(books.shape)
    if starts == 1:
        return codebook_table(vectors, trained[0])
    inertia = _tallied(vectors, sets)[1].reshape(starts, m)
    return codebook_table(vectors, trained[inertia.argmin(axis=0), np.arange(m)])


def codebook_inertia(vectors: DataFrame, codebooks: DataFrame) -> DataFrame:
    """(m, inertia): the sum of squared distances of all sub-vectors to their nearest centres."""
    books = codebook_array(codebooks)
    inertia = _tallied(vectors.select("vector").filter("vector is not null"), Sets(len(books), list(books)))[1]
    return vectors.sparkSession.createDataFrame(list(enumerate(inertia.tolist())), "m int, inertia double")


def codebook_table(like: DataFrame, codebooks: np.ndarray) -> DataFrame:
    m, ks, _ = codebooks.shape
    rows = [Row(m=part, code=code, centroid=codebooks[part, code].tolist())
            for part in range(m) for code in range(ks)]
    return like.sparkSession.createDataFrame(rows, CODEBOOK)


def codebook_array(codebooks: DataFrame) -> np.ndarray:
    """The table as an array (m, ks, width), after a check of its size."""
    rows, size = codebooks.agg(F.count("*"), F.coalesce(F.sum(F.size("centroid") * 8), F.lit(0))).first()
    if size > MAX_CODEBOOK_BYTES:
        raise ValueError("codebooks of this size do not fit a task")
    table = codebooks.orderBy("m", "code").toArrow()
    m = int(table.column("m").to_numpy().max()) + 1
    if rows % m:
        raise ValueError("sub-spaces with different numbers of centres")
    return kernels.matrix(table.column("centroid")).reshape(m, rows // m, -1)


def encode(vectors: DataFrame, codebooks: DataFrame) -> DataFrame:
    """(doc_id, codes): the nearest centre in every sub-space; ties go to the lower code."""
    shared = vectors.sparkSession.sparkContext.broadcast(codebook_array(codebooks))

    def code(batches):
        for batch in batches:
            if batch.num_rows:
                codes = kernels.nearest_codes(kernels.matrix(batch.column(1)), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), kernels.list_column(codes, pa.int32())], names=["doc_id", "codes"]
                )

    plain = vectors.select(F.col("doc_id").cast("bigint"), "vector").filter("vector is not null")
    return plain.mapInArrow(code, "doc_id bigint, codes array<int>")


def distance_table(queries: DataFrame, codebooks: DataFrame) -> DataFrame:
    """(qid, m, distances): squared distance of each query's sub-vector to every centre."""
    shared = queries.sparkSession.sparkContext.broadcast(codebook_array(codebooks))

    def look_up(batches):
        for batch in batches:
            if batch.num_rows:
                tables = kernels.distance_tables(kernels.matrix(batch.column(1)), shared.value)
                n, m, ks = tables.shape
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(0).to_numpy(), m)),
                     pa.array(np.tile(np.arange(m, dtype=np.int32), n)),
                     kernels.list_column(tables.reshape(n * m, ks), pa.float64())],
                    names=["qid", "m", "distances"],
                )

    plain = queries.select(F.col("qid").cast("bigint"), "vector")
    return plain.mapInArrow(look_up, "qid bigint, m int, distances array<double>")


def pq_topk(
    codes: DataFrame, codebooks: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True, **options
) -> DataFrame:
    """Top-k by coded distance, smallest first; the score is the squared distance."""
    shared = codes.sparkSession.sparkContext.broadcast(codebook_array(codebooks))
    found = batch_topk(
        codes.select("doc_id", F.col("codes").alias("item")),
        queries.select("qid", F.col("vector").alias("item")),
        lambda vectors: kernels.CodeDistanceScorer(vectors, shared.value), k, exclude_self, **options,
    )
    return found.withColumn("score", F.abs("score"))
