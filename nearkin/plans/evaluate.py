"""Recall against the exact answer, and a readable report."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recall_per_query(queries: DataFrame, truth: DataFrame, retrieved: DataFrame, k: int = 10) -> DataFrame:
    """(qid, recall): shared ids of both answers divided by k, 0 for an empty answer."""
    hits = (
        truth.select("qid", "doc_id")
        .join(retrieved.select("qid", "doc_id").withColumn("hit", F.lit(1)), ["qid", "doc_id"], "left")
        .groupBy("qid").agg(F.count("hit").alias("hits"))
    )
    return queries.select("qid").join(hits, "qid", "left").select(
        "qid", (F.coalesce("hits", F.lit(0)) / F.lit(float(k))).alias("recall")
    )


def method_recall(recalls: dict[str, DataFrame]) -> DataFrame:
    """(method, n_queries, recall): mean recall per method."""
    tagged = [df.select(F.lit(name).alias("method"), "recall") for name, df in recalls.items()]
    return (
        functools.reduce(DataFrame.unionByName, tagged)
        .groupBy("method")
        .agg(F.count("*").alias("n_queries"), F.avg("recall").alias("recall"))
    )


def _top_ids(neighbors: DataFrame, name: str, top: int) -> DataFrame:
    best = neighbors.filter(F.col("rank") <= top)
    ordered = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "doc_id"))).alias("r"))
    return ordered.select("qid", F.col("r.doc_id").alias(name))


def query_report(
    queries: DataFrame, truth: DataFrame, retrieved: DataFrame, candidates: DataFrame | None = None, top: int = 5
) -> DataFrame:
    """(qid, truth, retrieved, n_candidates) with the first ids of both answers.

    `candidates` (qid, doc_id) are counted without the query itself; without them the count is NULL.
    """
    empty = F.array().cast("array<bigint>")
    report = (
        queries.select("qid")
        .join(_top_ids(truth, "truth", top), "qid", "left")
        .join(_top_ids(retrieved, "retrieved", top), "qid", "left")
    )
    if candidates is None:
        count = F.lit(None).cast("bigint")
    else:
        others = candidates.filter("qid <> doc_id").groupBy("qid").agg(F.count("*").alias("n"))
        report = report.join(others, "qid", "left")
        count = F.coalesce("n", F.lit(0))
    return report.select(
        "qid", F.coalesce("truth", empty).alias("truth"), F.coalesce("retrieved", empty).alias("retrieved"),
        count.alias("n_candidates"),
    )
