"""The whole run: text to vectors, codes, buckets and their measured recall."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nearkin.functions.banding import best_bands
from nearkin.functions.text import ENGLISH_STOP_WORDS, shingles, token_set
from nearkin.functions.vectors import l2_normalize
from nearkin.operators import hyperplane, ivf, lsh, pq, terms
from nearkin.operators.lsi import lsi_embed
from nearkin.operators.ranking import first_n, query_sample
from nearkin.operators.skipgram import train_skipgram
from nearkin.operators.words import mean_pool, train_word2vec, word_vectors
from nearkin.plans import evaluate
from nearkin.plans.features import tokens_of
from nearkin.plans.methods import METHODS, Method, Saved, truth_of
from nearkin.plans.scale import scratch_folder, shuffles_freed, spread, written
from nearkin.sources.metrics import write_json
from nearkin.sources.tables import read_table, write_table
from nearkin.sources.text import read_tokens, write_tokens


@dataclass
class PipelineConfig:
    max_docs: int | None = None
    lsi_dims: int = 200
    max_features: int = 50_000
    pq_m: int = 8
    pq_ks: int = 256
    pq_rounds: int = 10
    pq_starts: int = 3
    pq_seeding: str = "distance"
    pq_tolerance: float | None = 0.005
    pq_normalize: bool = False
    num_perm: int = 128
    threshold: float = 0.8
    shingle_n: int = 5
    k: int = 10
    n_queries: int = 200
    power_steps: int = 5
    stop_words: tuple[str, ...] = field(default=ENGLISH_STOP_WORDS)
    embedding: str = "lsi"  # or w2v (Spark's trainer) or sgns (trained by word blocks), of lsi_dims dimensions as well
    w2v_min_count: int = 2
    w2v_epochs: int = 5
    basis: str = "token"  # or shingle: the sets that MinHash answers are ranked on and measured by
    methods: tuple[str, ...] = ("pq", "lsh", "flat")
    n_bits: int = 16
    cells: int = 16
    nprobe: int = 4


EMBEDDINGS = ("lsi", "w2v", "sgns")


def _timed(df: DataFrame, n_queries: int) -> tuple[DataFrame, float, int]:
    """The written rows, the seconds per query of the job that made them, and how many they are, counted by the same job."""
    seen = Observation()
    start = time.perf_counter()
    table = written(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return table, (time.perf_counter() - start) / max(n_queries, 1), int(seen.get["rows"])


def run_pipeline(
    spark: SparkSession, documents: DataFrame, config: PipelineConfig | None = None, out: str | None = None
) -> DataFrame:
    """Runs all stages over (doc_id, text) and returns (method, n_queries, lookup_time, avg_time, n_candidates, recall).

    Every stage is a Parquet table below `out`, so a later run can start from any of them.
    """
    c = config or PipelineConfig()
    out = out or f"{scratch_folder(spark)}/run-{time.time_ns()}"

    if c.basis not in ("token", "shingle"):
        raise ValueError(f"unknown basis {c.basis!r}: token or shingle")
    if unknown := set(c.methods) - set(METHODS):
        raise ValueError(f"unknown methods {sorted(unknown)}; there are {tuple(METHODS)}")

    # text
    docs = spread(first_n(documents.select("doc_id", "text"), c.max_docs), "doc_id")
    write_tokens(tokens_of(docs, stop_words=c.stop_words), f"{out}/tokens")
    tokens = spread(read_tokens(spark, f"{out}/tokens").select("doc_id", "tokens"), "doc_id")
    n_docs = tokens.count()

    # vectors
    if c.embedding not in EMBEDDINGS:
        raise ValueError(f"unknown embedding {c.embedding!r}; there are {EMBEDDINGS}")
    if "pq" in c.methods and (c.lsi_dims % c.pq_m or c.pq_ks > n_docs):
        raise ValueError(
            f"{c.lsi_dims} dimensions need a multiple of {c.pq_m} sub-vectors; {c.pq_ks} centres need as many documents (there are {n_docs})")
    write_table(_embedded(tokens, n_docs, c), "embeddings", f"{out}/embeddings")
    vectors = read_table(spark, "embeddings", f"{out}/embeddings").withColumnRenamed("embedding", "vector")

    # product quantization
    if "pq" in c.methods:
        plain = vectors.select("doc_id", l2_normalize(F.col("vector")).alias("vector")) if c.pq_normalize else vectors
        books = pq.train_codebooks(plain, c.pq_m, c.pq_ks, c.pq_rounds, c.pq_starts, c.pq_seeding, c.pq_tolerance, reseed=True)
        write_table(books, "codebooks", f"{out}/codebooks")
        write_table(pq.encode(plain, read_table(spark, "codebooks", f"{out}/codebooks")), "codes", f"{out}/codes")

    # hyperplane buckets and cells
    if "hyperplane" in c.methods:
        write_table(hyperplane.hyperplane_signatures(vectors, c.n_bits), "buckets", f"{out}/buckets")
    if {"ivf", "cells"} & set(c.methods):
        write_table(ivf.train_cells(vectors, c.cells, c.pq_rounds), "codebooks", f"{out}/centres")
        write_table(ivf.assign_cells(vectors, read_table(spark, "codebooks", f"{out}/centres")), "cells", f"{out}/cells")

    # signatures and bands; answers are ranked, and the truth is made, on token or shingle sets
    signed = lsh.minhash_signatures(tokens, c.num_perm, c.shingle_n)
    write_table(signed, "signatures", f"{out}/signatures")
    signed = read_table(spark, "signatures", f"{out}/signatures")
    bands, rows = best_bands(c.threshold, c.num_perm)
    write_table(lsh.band_table(signed, bands, rows), "bands", f"{out}/bands")
    keyed = lsh.with_keys(signed, bands, rows).select("doc_id", "keys")
    with shuffles_freed(spark):
        write_table(_features(keyed, tokens, c), "features", f"{out}/features", "zstd")

    # flat index
    write_table(vectors.select("doc_id", l2_normalize(F.col("vector")).alias("embedding")), "embeddings", f"{out}/flat")

    metrics = evaluate_indices(spark, out, c.methods, c.k, c.n_queries, c.pq_normalize, c.n_bits, c.nprobe)
    write_json(metrics, f"{out}/metrics")
    return metrics


def _features(keyed: DataFrame, tokens: DataFrame, c: PipelineConfig) -> DataFrame:
    """(doc_id, words, keys) of (doc_id, keys). Token sets are smaller than their tokens and are made before the join, shingles
    are several times their tokens and are made behind it."""
    if c.basis == "token":
        return keyed.join(tokens.select("doc_id", token_set(F.col("tokens")).alias("words")), "doc_id")
    shingled = token_set(shingles(F.col("tokens"), c.shingle_n)).alias("words")
    return keyed.join(tokens.select("doc_id", "tokens"), "doc_id").select("doc_id", shingled, "keys")


def _embedded(tokens: DataFrame, n_docs: int, c: PipelineConfig) -> DataFrame:
    """(doc_id, embedding) by the chosen model."""
    if c.embedding == "w2v":
        model = train_word2vec(tokens, c.lsi_dims, min_count=c.w2v_min_count, epochs=c.w2v_epochs)
        return mean_pool(tokens, word_vectors(model))
    if c.embedding == "sgns":
        return mean_pool(tokens, train_skipgram(tokens, c.lsi_dims, min_count=c.w2v_min_count, epochs=c.w2v_epochs))
    vocab = written(terms.vocabulary(terms.term_counts(tokens), c.max_features))
    rows, names = terms.tfidf_rows(tokens, vocab, n_docs)
    if c.lsi_dims > len(names):
        raise ValueError(f"{c.lsi_dims} dimensions need as many terms (there are {len(names)})")
    return lsi_embed(rows, names, tokens, c.lsi_dims, power_steps=c.power_steps)[0]


def evaluate_indices(
    spark: SparkSession, folder: str, methods: Iterable[str] | Mapping[str, Method] = ("pq", "lsh", "flat"), k: int = 10, n_queries: int = 200,
    pq_normalize: bool = False, n_bits: int = 16, nprobe: int = 4,
) -> DataFrame:
    """(method, n_queries, lookup_time, avg_time, n_candidates, recall) of saved indices: the tables that `run_pipeline` has
    left in a folder. `methods` are names of METHODS, or methods of your own by name.

    Times are seconds per query of one batch job. `lookup_time` finds the candidates, `avg_time` ranks them as well; a
    method that does not do these apart has the same time for both. n_candidates are all rows compared with a query.
    """
    chosen = dict(methods) if isinstance(methods, Mapping) else {}
    if not chosen:
        methods = tuple(methods)
        if unknown := set(methods) - set(METHODS):
            raise ValueError(f"unknown methods {sorted(unknown)}; there are {tuple(METHODS)}")
        chosen = {name: METHODS[name] for name in methods}
    saved = Saved(spark, folder, pq_normalize, n_bits, nprobe)
    sample = written(query_sample(read_table(spark, "features", f"{folder}/features").select("doc_id"), n_queries))
    n = sample.count()
    truths = {kind: written(truth_of(kind, saved, sample, k)) for kind in sorted({m.truth for m in chosen.values()})}
    recalls, times = {}, []
    for name, method in chosen.items():
        if method.look_up:
            pairs, look_up, rows = _timed(method.look_up(saved, sample), n)
            found, ranked, _ = _timed(method.answer(saved, sample, k, pairs), n)
            times.append((name, look_up, look_up + ranked, rows - pairs.filter("qid = doc_id").count()))
        else:
            found, seconds, _ = _timed(method.answer(saved, sample, k), n)
            times.append((name, seconds, seconds, method.scored(saved, sample) if method.scored else None))
        recalls[name] = evaluate.recall_per_query(sample, truths[method.truth], found, k)
    table = spark.createDataFrame(times, "method string, lookup_time double, avg_time double, n_candidates bigint")
    metrics = evaluate.method_recall(recalls).join(F.broadcast(table), "method")
    return written(metrics.select("method", "n_queries", "lookup_time", "avg_time", "n_candidates", "recall"))
