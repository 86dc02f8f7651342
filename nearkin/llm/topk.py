"""Exact top-k by inner product of integer vectors, term at a time.

A task holds a block of rows as postings: for each term (component) the rows with a weight and the weights. For each
term of the query rows, the weighted postings are added into dense score arrays, one per query of a group. The k best
of a block are cut out by partition selection; a window merges the blocks' winners.

Sums of longs are exact modulo 2**64, so a score is right if it fits a long. It does where the product of the two lengths
(norms) is below 2**63; the scores of other pairs are summed in Python's integers, and one that does not fit is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.llm.arrays import tidy
from nearkin.plans.scale import written

BLOCK_ROWS = 8192
GROUP = 64
BLOCK_BYTES = 64 << 20
LIMIT = 1 << 63


def integer_codes(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as longs; null for vectors that are null or hold a null or a value that is not
    finite. A finite component whose code is no long is an error: there is no integer score for it."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def code(x: Column) -> Column:
        scaled = x.cast("double") * scale
        fits = (scaled >= F.lit(-float(LIMIT))) & (scaled < F.lit(float(LIMIT)))
        return F.when(fits, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component is too large for an integer code")).cast("bigint"))

    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, code))


def postings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term, row and weight of all entries that are not zero, by term."""
    lengths = np.asarray(column.value_lengths())
    weight = np.asarray(column.flatten())
    row = np.repeat(np.arange(len(column)), lengths)
    term = np.arange(len(weight)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.argsort(term, kind="stable")
    order = order[weight[order] != 0]
    return term[order], row[order], weight[order]


def by_term(parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    term, row, weight = parts
    cut = np.flatnonzero(np.diff(term)) + 1
    return {int(t[0]): (r, w) for t, r, w in zip(*(np.split(x, cut) for x in (term, row, weight))) if len(t)}


def norms(row: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Length of each of n vectors, a little above the true one."""
    return np.sqrt(np.bincount(row, weights=weight.astype(np.float64) ** 2, minlength=n)) * (1 + 1e-9)


def wide_scores(number: int, terms: dict, posted: dict, asked: np.ndarray, n: int) -> np.ndarray:
    """Scores of one query of a group with the asked ones of n rows, as Python integers."""
    score = np.zeros(n, object)
    for term, (query, weight) in terms.items():
        own = weight[query == number]
        if len(own) and term in posted:
            row, posting = posted[term]
            mine = asked[row]
            score[row[mine]] += posting[mine].astype(object) * int(own[0])
    return score[asked]


def best(score: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of one block, ties to smaller ids, the query's own id left out."""
    score, ids = score[ids != own], ids[ids != own]
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        above, level = np.flatnonzero(score > least), np.flatnonzero(score == least)
        need = k - len(above)
        level = level[np.argpartition(ids[level], need - 1)[:need]] if len(level) > need else level
        found = np.concatenate([above, level])
        score, ids = score[found], ids[found]
    return score, ids


def topk(rows: DataFrame, queries: DataFrame, id_col: str, codes_col: str, k: int = 10, block_queries: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each query by integer inner product, ties to smaller ids.

    A row is never a candidate for the query of its own id. Rows and queries without codes or id take no part; rows
    that repeat an id are candidates of their own, a repeated query counts once. Vectors of different lengths meet on
    the terms that both have. No query or no row gives an empty table. A score that does not fit a long is an error.

    Queries go out in blocks of at most about `block_queries` rows and BLOCK_BYTES; each block makes one pass over the rows,
    which are never shuffled: k rows per query and task are. A block's winners are written and its queries given back before the next
    one is fetched.
    """
    columns = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(codes_col).alias("codes")).dropna()
    asked = queries.select(F.col(id_col).cast("bigint").alias("id"), F.col(codes_col).alias("codes")).dropna()
    asked = written(asked.dropDuplicates(["id"]))
    schema = "query_id bigint, vec_id bigint, score bigint"

    def task(query_ids: np.ndarray, query_terms: dict):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if len(query_ids) == 0:
                return
            groups = [{} for _ in range(0, len(query_ids), GROUP)]
            entries = list(query_terms.value.values()) or [(np.zeros(0, np.int64),) * 2]
            query_norms = norms(*(np.concatenate(x) for x in zip(*entries)), len(query_ids))
            for term, (row, weight) in query_terms.value.items():
                for g in np.unique(row // GROUP):
                    groups[g][term] = (row[row // GROUP == g] % GROUP, weight[row // GROUP == g])
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    block = batch.slice(at, BLOCK_ROWS)
                    ids, parts = np.asarray(block.column(0)), postings(block.column(1))
                    posted, row_norms = by_term(parts), norms(parts[1], parts[2], len(ids))
                    out = [[], [], []]
                    for g, terms in enumerate(groups):
                        own = query_ids[g * GROUP: (g + 1) * GROUP]
                        score = np.zeros((len(own), len(ids)), np.int64)
                        for term, (query, weight) in terms.items():
                            if term in posted:
                                row, posting = posted[term]
                                if len(row) == len(ids):  # every row has the term: no need to scatter
                                    for q, w in zip(query, weight):
                                        score[q] += posting * w
                                else:
                                    for q, w in zip(query, weight):
                                        score[q, row] += posting * w
                        for q, query_id in enumerate(own):
                            large = (row_norms * query_norms[g * GROUP + q] >= LIMIT) & (ids != query_id)
                            if large.any():
                                exact = wide_scores(q, terms, posted, large, len(ids))
                                if max(exact) >= LIMIT or min(exact) < -LIMIT:
                                    raise ValueError(f"scores of query {query_id} do not fit a long")
                            s, i = best(score[q], ids, query_id, k)
                            for to, part in zip(out, (np.full(len(s), query_id), i, s)):
                                to.append(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["query_id", "vec_id", "score"])
        return run

    spark = rows.sparkSession
    n, size = asked.agg(F.count("*"), F.coalesce(F.sum(8 * F.size("codes")), F.lit(0))).first()
    passes = max(1, -(-n // block_queries), -(-size // BLOCK_BYTES))
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(passes)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = None
    for number in range(passes):
        block = numbered.where(F.col("block") == number).select("id", "codes").toArrow().combine_chunks()
        ids = np.asarray(block.column("id"))
        codes = block.column("codes").combine_chunks()
        if isinstance(codes, pa.ChunkedArray):
            codes = codes.chunk(0) if codes.num_chunks else pa.array([], pa.list_(pa.int64()))
        sent = spark.sparkContext.broadcast(by_term(postings(codes)))
        best_rows = columns.mapInArrow(tidy(task(ids, sent)), schema).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if passes > 1:  # a query is in one block only
            best_rows = written(best_rows)
            sent.destroy()
        found = best_rows if found is None else found.unionAll(best_rows)
    return found.select("query_id", "rank", "vec_id", "score")
