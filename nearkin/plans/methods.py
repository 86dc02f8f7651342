"""The search methods of a run: what each looks up, how it answers, and which truth it is measured by.

A method is an entry of METHODS, or one of your own handed to `evaluate_indices`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.functions.vectors import l2_normalize
from nearkin.operators import cells, hyperplane, ivf, lsh, pq, search
from nearkin.operators.ranking import as_queries, rank_topk, rows_of
from nearkin.plans.scale import written
from nearkin.sources.tables import read_table


@dataclass
class Saved:
    """The tables that a run has left in a folder, and the settings that its searches take."""

    spark: SparkSession
    folder: str
    pq_normalize: bool = False
    n_bits: int = 16
    nprobe: int = 4

    def table(self, kind: str, name: str | None = None) -> DataFrame:
        return read_table(self.spark, kind, f"{self.folder}/{name or kind}")

    def vectors(self, name: str = "embeddings") -> DataFrame:
        return self.table("embeddings", name).withColumnRenamed("embedding", "vector")

    def asked_vectors(self, sample: DataFrame, name: str = "embeddings") -> DataFrame:
        return rows_of(self.vectors(name), sample).withColumnRenamed("doc_id", "qid")

    def asked_features(self, sample: DataFrame) -> DataFrame:
        return as_queries(rows_of(self.table("features"), sample))


@dataclass(frozen=True)
class Method:
    """`answer` gives neighbors (qid, doc_id, score, rank) for a sample (qid). With a `look_up`, which gives the pairs
    (qid, doc_id) it ranks, the two are timed apart. `scored` says how many rows a method without one compares."""

    truth: str
    answer: Callable[..., DataFrame]
    look_up: Callable[[Saved, DataFrame], DataFrame] | None = None
    scored: Callable[[Saved, DataFrame], int] | None = None


def _all_rows(saved: Saved, sample: DataFrame) -> int:
    return sample.count() * (saved.table("embeddings").count() - 1)


def _flat(saved: Saved, sample: DataFrame, k: int) -> DataFrame:
    return search.inner_product_topk(saved.vectors("flat"), saved.asked_vectors(sample, "flat"), k)


def _pq(saved: Saved, sample: DataFrame, k: int) -> DataFrame:
    asked = saved.asked_vectors(sample)
    if saved.pq_normalize:
        asked = asked.select("qid", l2_normalize(F.col("vector")).alias("vector"))
    return pq.pq_topk(saved.table("codes"), saved.table("codebooks"), asked, k)


def _lsh_pairs(saved: Saved, sample: DataFrame) -> DataFrame:
    return lsh.lsh_candidates(saved.table("features").select("doc_id", "keys"), saved.asked_features(sample))


def _lsh(saved: Saved, sample: DataFrame, k: int, pairs: DataFrame) -> DataFrame:
    asked = written(saved.asked_features(sample).select("qid", "q_words"))
    return rank_topk(lsh.score_pairs(pairs.filter("qid <> doc_id"), saved.table("features"), asked), k)


def _hyperplane_pairs(saved: Saved, sample: DataFrame) -> DataFrame:
    asked = hyperplane.hyperplane_signatures(saved.asked_vectors(sample), saved.n_bits)
    return hyperplane.hyperplane_candidates(saved.table("buckets"), asked.select("qid", F.col("bucket").alias("q_bucket")))


def _hyperplane(saved: Saved, sample: DataFrame, k: int, pairs: DataFrame) -> DataFrame:
    asked = written(saved.asked_vectors(sample).withColumnRenamed("vector", "q_vector"))
    return hyperplane.rerank(pairs, saved.vectors(), asked, k)


def _ivf(saved: Saved, sample: DataFrame, k: int) -> DataFrame:
    return ivf.ivf_topk(saved.table("cells"), saved.table("codebooks", "centres"), saved.asked_vectors(sample), k, saved.nprobe)


def _probed_rows(saved: Saved, sample: DataFrame) -> int:
    probes = ivf.probes(saved.asked_vectors(sample), saved.table("codebooks", "centres"), saved.nprobe).select("qid", "cell")
    own = saved.table("cells").select(F.col("doc_id").alias("qid"), "cell")
    sizes = saved.table("cells").groupBy("cell").count()
    rows = probes.join(sizes, "cell").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    return int(rows) - probes.join(own, ["qid", "cell"], "left_semi").count()


def _cell_index(saved: Saved) -> cells.CellIndex:
    return cells.index_of(saved.table("cells"), saved.table("codebooks", "centres"))


def _cells(saved: Saved, sample: DataFrame, k: int) -> DataFrame:
    return cells.exact_topk(_cell_index(saved), saved.asked_vectors(sample), k)[0]


def _rows_in_cells(saved: Saved, sample: DataFrame, k: int = 10) -> int:
    index = _cell_index(saved)
    looked = cells.exact_topk(index, saved.asked_vectors(sample), k)[1]
    return int(cells.rows_compared(index, looked).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0])


METHODS: dict[str, Method] = {
    "pq": Method("cosine", _pq, scored=_all_rows),
    "lsh": Method("jaccard", _lsh, look_up=_lsh_pairs),
    "flat": Method("cosine", _flat, scored=_all_rows),
    "hyperplane": Method("cosine", _hyperplane, look_up=_hyperplane_pairs),
    "ivf": Method("cosine", _ivf, scored=_probed_rows),
    "cells": Method("cosine", _cells, scored=_rows_in_cells),
}


def truth_of(kind: str, saved: Saved, sample: DataFrame, k: int) -> DataFrame:
    """The exact answers by this measure."""
    if kind == "cosine":
        return search.cosine_topk(saved.vectors(), saved.asked_vectors(sample), k)
    if kind == "jaccard":
        words = saved.table("features").select("doc_id", "words")
        return search.jaccard_topk(words, rows_of(words, sample).withColumnRenamed("doc_id", "qid"), k)
    raise ValueError(f"unknown truth {kind!r}: cosine or jaccard")
