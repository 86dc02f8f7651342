"""MinHash settings swept in one job: signatures once, every setting as rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.functions import text as T
from nearkin.functions.banding import band_keys, best_bands
from nearkin.operators.lsh import PAIRS_AT_ONCE, lsh_candidates, lsh_topk, minhash_signatures
from nearkin.operators.ranking import as_queries, rows_of
from nearkin.operators.search import MAX_QUERIES, NEIGHBORS, as_arrow, keep_best, query_passes, whole
from nearkin.plans.scale import MAX_BROADCAST_BYTES, written

NUM_PERMS = (128, 256, 512)
THRESHOLDS = (0.45, 0.55, 0.65)


def grid(num_perms: Iterable[int] = NUM_PERMS, thresholds: Iterable[float] = THRESHOLDS) -> list[tuple[int, float]]:
    return [(n, t) for n in num_perms for t in thresholds]


def sweep_features(tokens: DataFrame, settings: list[tuple[int, float]], shingle_n: int = 3) -> DataFrame:
    """(setting, doc_id, words, keys): a shorter signature is the start of the longest one."""
    longest = max(n for n, _ in settings)
    signed = minhash_signatures(tokens, longest, shingle_n)
    signed = signed.select("doc_id", T.token_set(F.col("tokens")).alias("words"), "signature")
    variants = [
        F.struct(F.lit(i).alias("setting"), band_keys(F.col("signature"), *best_bands(t, n)).alias("keys"))
        for i, (n, t) in enumerate(settings)
    ]
    return signed.select("doc_id", "words", F.inline(F.array(*variants)))


def _side_by_side(tokens: DataFrame, settings: list[tuple[int, float]], shingle_n: int) -> DataFrame:
    """(doc_id, words, keys_0, keys_1, ...): the keys of every setting beside the words, which are held once."""
    signed = _signed(tokens, settings, shingle_n)
    keys = [band_keys(F.col("signature"), *best_bands(t, n)).alias(f"keys_{i}") for i, (n, t) in enumerate(settings)]
    return signed.select("doc_id", "words", *keys)


def _signed(tokens: DataFrame, settings: list[tuple[int, float]], shingle_n: int) -> DataFrame:
    """(doc_id, signature, words): one signature, long enough for all settings."""
    signed = minhash_signatures(tokens.select("doc_id", "tokens"), max(n for n, _ in settings), shingle_n)
    return signed.select("doc_id", "signature", T.token_set(F.col("tokens")).alias("words"))


def _swept(corpus: DataFrame, table: pa.Table, settings: list[tuple[int, float]], k: int) -> DataFrame:
    """(setting, qid, doc_id, score): at most k candidates per setting, query and task. A pair is scored once for all settings."""
    bands = [best_bands(t, n) for n, t in settings]
    shared = corpus.sparkSession.sparkContext.broadcast(table)

    def sweep(batches):
        asked = shared.value
        if not asked.num_rows:
            return
        signatures = kernels.matrix(asked.column("signature"), np.int64)
        qids, scorer = asked.column("qid").to_numpy(), kernels.PairJaccard(whole(asked.column("words")))
        indices = [kernels.BandIndex(kernels.band_hashes(signatures, b, r)) for b, r in bands]
        step, best = max(1, PAIRS_AT_ONCE // len(qids)), [None] * len(bands)
        for batch in batches:
            for part in kernels.pieces(batch, 2, step):
                ids, own = part.column(0).to_numpy(), kernels.matrix(part.column(1), np.int64)
                pairs = [np.ravel_multi_index(index.pairs(kernels.band_hashes(own, b, r)), (len(qids), len(ids))) for index, (b, r) in zip(indices, bands)]
                every = np.unique(np.concatenate(pairs))
                query, row = np.divmod(every, len(ids))
                every, query, row = (x[qids[query] != ids[row]] for x in (every, query, row))
                score = scorer(query, row, part.column(2))
                for i, mine in enumerate(pairs):
                    hit = np.isin(every, mine)
                    new = [qids[query[hit]], ids[row[hit]], score[hit]]
                    best[i] = keep_best(new if best[i] is None else best[i], [x[:0] for x in new] if best[i] is None else new, k, None)
        for i, kept in enumerate(best):
            if kept is not None:
                rows = as_arrow(kept, pa.RecordBatch)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, i, np.int32)), *rows.columns], names=["setting", *rows.schema.names])

    return corpus.mapInArrow(sweep, f"setting int, {NEIGHBORS}")


def lsh_sweep(
    tokens: DataFrame, sample: DataFrame, truth: DataFrame, k: int = 10,
    settings: list[tuple[int, float]] | None = None, shingle_n: int = 3,
) -> DataFrame:
    """(method, num_perm, threshold, recall) of banded MinHash for every setting."""
    settings = settings or grid()
    sample = written(sample)
    queries = _signed(rows_of(tokens, sample), settings, shingle_n).withColumnRenamed("doc_id", "qid")
    corpus, found = _signed(tokens, settings, shingle_n), None
    for table in query_passes(written(queries), MAX_QUERIES, MAX_BROADCAST_BYTES):
        part = _swept(corpus, table.combine_chunks(), settings, k)
        found = part if found is None else found.unionAll(part)
    order = Window.partitionBy("setting", "qid").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    hits = (
        best.join(truth.select("qid", "doc_id"), ["qid", "doc_id"], "left_semi")
        .groupBy("setting", "qid").agg(F.count("*").alias("hits"))
    )
    named = tokens.sparkSession.createDataFrame(
        [(i, n, float(t)) for i, (n, t) in enumerate(settings)], "setting int, num_perm int, threshold double"
    )
    asked = sample.select("qid", F.explode(F.array(*[F.lit(i) for i in range(len(settings))])).alias("setting"))
    recall = (
        asked.join(hits, ["setting", "qid"], "left")
        .groupBy("setting")
        .agg(F.avg(F.coalesce("hits", F.lit(0)) / F.lit(float(k))).alias("recall"))
    )
    return named.join(recall, "setting").select(F.lit("lsh").alias("method"), "num_perm", "threshold", "recall")


def with_fixed_methods(
    sweep: DataFrame, fixed: DataFrame, settings: list[tuple[int, float]] | None = None
) -> DataFrame:
    """Repeats methods that take no swept setting (method, recall) for every setting."""
    settings = settings or grid()
    points = F.array(*[F.struct(F.lit(n).alias("num_perm"), F.lit(t).alias("threshold")) for n, t in settings])
    rows = fixed.select("method", "recall", F.inline(points)).select("method", "num_perm", "threshold", "recall")
    return sweep.unionByName(rows)


def sweep_series(sweep: DataFrame, thresholds: Iterable[float] = THRESHOLDS, value: str = "recall") -> DataFrame:
    """One row per method and num_perm, one column per threshold."""
    table = sweep.groupBy("method", "num_perm").pivot("threshold", list(thresholds)).agg(F.first(value))
    names = [f"{value}_{round(t * 100)}" for t in thresholds]
    return table.toDF("method", "num_perm", *names)


def sweep_times(
    tokens: DataFrame, sample: DataFrame, k: int = 10,
    settings: list[tuple[int, float]] | None = None, shingle_n: int = 3,
) -> DataFrame:
    """(method, num_perm, threshold, lookup_time, avg_time): seconds per query of one batch job each.

    `lookup_time` finds the candidates, `avg_time` ranks them as well. Signatures are made once.
    """
    settings = settings or grid()
    sample = written(sample)
    n = max(sample.count(), 1)
    corpus = written(_side_by_side(tokens, settings, shingle_n))
    queries = written(rows_of(corpus, sample))
    rows = []
    for i, (num_perm, threshold) in enumerate(settings):
        keyed, asked = (df.select("doc_id", "words", F.col(f"keys_{i}").alias("keys")) for df in (corpus, queries))
        asked = as_queries(asked)
        times = []
        for job in (lsh_candidates, lambda a, b: lsh_topk(a, b, k)):
            start = time.perf_counter()
            job(keyed, asked).write.format("noop").mode("overwrite").save()
            times.append((time.perf_counter() - start) / n)
        rows.append(("lsh", num_perm, float(threshold), *times))
    schema = "method string, num_perm int, threshold double, lookup_time double, avg_time double"
    return tokens.sparkSession.createDataFrame(rows, schema)


def fixed_times(
    spark: SparkSession, jobs: dict[str, Callable[[], DataFrame]], n_queries: int,
    settings: list[tuple[int, float]] | None = None,
) -> DataFrame:
    """(method, num_perm, threshold, lookup_time, avg_time) of methods that take no swept setting: timed once, repeated for all.

    They have no look-up apart from the ranking, so both times are the same.
    """
    rows = []
    for method, job in jobs.items():
        start = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        seconds = (time.perf_counter() - start) / max(n_queries, 1)
        rows += [(method, n, float(t), seconds, seconds) for n, t in settings or grid()]
    schema = "method string, num_perm int, threshold double, lookup_time double, avg_time double"
    return spark.createDataFrame(rows, schema)
