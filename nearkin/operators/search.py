"""Exact and coded top-k: one batched matrix product per task, one small shuffle of winners."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.operators.ranking import rank_topk
from nearkin.plans.scale import MAX_BROADCAST_BYTES, collect_bounded, written

NEIGHBORS = "qid bigint, doc_id bigint, score double"
MAX_QUERIES = 4_096
SCORES_AT_ONCE = 4_000_000


def winners(
    qids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, exclude_self: bool, digits: int | None
) -> list[np.ndarray]:
    """The k best (qid, id, score) per query out of one block of scores (queries x rows)."""
    if exclude_self:
        order = np.argsort(qids)
        at = np.minimum(np.searchsorted(qids, ids, sorter=order), len(qids) - 1)
        own = np.flatnonzero(qids[order[at]] == ids)
        scores[order[at[own]], own] = -np.inf
    query, row = kernels.best_of(scores, ids, k, digits)
    return [qids[query], ids[row], scores[query, row]]


def keep_best(best: list[np.ndarray], new: list[np.ndarray], k: int, digits: int | None) -> list[np.ndarray]:
    """Merges two lists of winners and cuts each query to k."""
    qid, ids, score = (np.concatenate(pair) for pair in zip(best, new))
    keep = kernels.first_k(qid, ids, score, k, digits)
    return [qid[keep], ids[keep], score[keep]]


def as_arrow(best: list[np.ndarray], cls):
    arrays = [pa.array(best[0], pa.int64()), pa.array(best[1], pa.int64()), pa.array(best[2], pa.float64())]
    return cls.from_arrays(arrays, names=["qid", "doc_id", "score"])


def batch_topk(
    corpus: DataFrame,
    queries: DataFrame,
    make_scorer: Callable[[pa.Array], Callable[[pa.Array], np.ndarray]],
    k: int,
    exclude_self: bool = True,
    max_queries: int = MAX_QUERIES,
    max_query_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Top-k of corpus (doc_id, item) for queries (qid, item), higher scores first.

    The query set goes out in passes of bounded rows and bytes. In a pass every task keeps k rows per query while it
    reads its part of the corpus, so only winners are shuffled, and the corpus never is. One window merges all passes.
    """
    corpus = corpus.select("doc_id", "item").filter("item is not null")
    queries = queries.select("qid", "item").filter("item is not null")
    table = collect_bounded(queries, max_queries, max_query_bytes)
    if table is not None:
        passes = [table]
    else:
        passes = query_passes(written(queries), max_queries, max_query_bytes)
    found = None
    for table in passes:
        part = _scan(corpus, table.combine_chunks(), make_scorer, k, exclude_self)
        found = part if found is None else found.unionAll(part)
    return rank_topk(found, k, digits=digits_of(make_scorer))


def query_passes(queries: DataFrame, max_rows: int, max_bytes: int) -> Iterator[pa.Table]:
    """A written query set in parts by the hash of the id, each within the bounds; a part that is not is cut in half."""
    waiting = [(1, 0)]
    while waiting:
        parts, number = waiting.pop()
        mine = queries.filter(F.pmod(F.xxhash64("qid"), F.lit(parts)) == number)
        table = collect_bounded(mine, max_rows, max_bytes)
        if table is not None:
            yield table
        elif parts >= 1 << 40:
            raise ValueError("a single query is larger than max_query_bytes")
        else:
            waiting += [(2 * parts, number), (2 * parts, number + parts)]


def _scan(corpus: DataFrame, table: pa.Table, make_scorer, k: int, exclude_self: bool) -> DataFrame:
    """The k best rows per query and task for the queries of one pass."""
    shared = corpus.sparkSession.sparkContext.broadcast(table)

    def scan(batches):
        asked = shared.value
        if not asked.num_rows:
            return
        qids, scorer = asked.column("qid").to_numpy(), make_scorer(whole(asked.column("item")))
        step = max(1, SCORES_AT_ONCE // len(qids))
        best = None
        for batch in batches:
            for part in kernels.pieces(batch, 1, step):
                scores = scorer(part.column(1))
                new = winners(qids, part.column(0).to_numpy(), scores, k, exclude_self, scorer.digits)
                best = new if best is None else keep_best(best, new, k, scorer.digits)
        if best is not None:
            yield as_arrow(best, pa.RecordBatch)

    return corpus.mapInArrow(scan, NEIGHBORS)


def whole(column: pa.ChunkedArray) -> pa.Array:
    joined = column.combine_chunks()
    return joined.chunk(0) if isinstance(joined, pa.ChunkedArray) else joined


def digits_of(make_scorer) -> int | None:
    return getattr(make_scorer, "digits", kernels.TIE_DIGITS)


def _items(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.select(key, F.col(column).alias("item"))


def cosine_topk(corpus: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True, **options) -> DataFrame:
    """Exact cosine top-k over `vector`; a zero vector scores 0."""
    corpus, queries = _items(corpus, "doc_id", "vector"), _items(queries, "qid", "vector")
    return batch_topk(corpus, queries, kernels.CosineScorer, k, exclude_self, **options)


def inner_product_topk(
    corpus: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True, **options
) -> DataFrame:
    """Exact inner-product top-k over `vector`; over unit vectors this is the flat cosine index."""
    corpus, queries = _items(corpus, "doc_id", "vector"), _items(queries, "qid", "vector")
    return batch_topk(corpus, queries, kernels.InnerProductScorer, k, exclude_self, **options)


def jaccard_topk(corpus: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True, **options) -> DataFrame:
    """Exact Jaccard top-k over `words`, arrays of distinct words.

    Two empty sets score 0. Documents without a shared word score 0 and fill up the answer in id
    order. The words stay with their document: a join on the word would shuffle one row per
    document and query.
    """
    corpus, queries = _items(corpus, "doc_id", "words"), _items(queries, "qid", "words")
    return batch_topk(corpus, queries, kernels.JaccardScorer, k, exclude_self, **options)
