"""Random-hyperplane buckets for cosine similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.functions.vectors import dot, norm
from nearkin.operators.ranking import rank_topk
from nearkin.plans.scale import checked_join, written


def hyperplane_signatures(vectors: DataFrame, n_bits: int = 128, seed: int = 42) -> DataFrame:
    """Adds `bucket`: per plane '1' where the vector lies strictly on its positive side. Null vectors are left out."""
    vectors = vectors.filter("vector is not null")
    at = vectors.columns.index("vector")

    def sign(batches):
        for batch in batches:
            rows = kernels.matrix(batch.column(at))
            planes = kernels.hyperplanes(n_bits, rows.shape[1], seed)
            bits = (rows @ planes.T > 0).astype(np.uint8) + ord("0")
            keys = np.ascontiguousarray(bits).view(f"S{n_bits}").ravel() if len(rows) else []
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(keys, pa.binary()).cast(pa.string())],
                names=batch.schema.names + ["bucket"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(sign, f"{schema}, bucket string")


def hyperplane_buckets(signed: DataFrame) -> DataFrame:
    """(bucket, doc_id): the index as a table."""
    return signed.select("bucket", "doc_id")


def hyperplane_bucket_sizes(signed: DataFrame) -> DataFrame:
    return signed.groupBy("bucket").agg(F.count("*").alias("n_docs"))


def _pairs(signed: DataFrame, queries: DataFrame) -> DataFrame:
    queries = written(queries.withColumnRenamed("q_bucket", "bucket"))
    row_bytes = F.length("bucket") + 16
    if "q_vector" in queries.columns:
        row_bytes = row_bytes + F.size("q_vector") * 8
    return checked_join(signed, queries, ["bucket"], row_bytes, "doc_id")


def hyperplane_candidates(signed: DataFrame, queries: DataFrame) -> DataFrame:
    """(qid, doc_id) of all vectors in exactly the query's bucket, itself included."""
    pairs = _pairs(signed.select("doc_id", "bucket"), queries.select("qid", "q_bucket"))
    return pairs.select("qid", "doc_id")


def hyperplane_topk(signed: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True) -> DataFrame:
    """The bucket's vectors ranked by cosine; may give fewer than k rows.

    Needs vector and bucket on the corpus, q_vector and q_bucket on the queries.
    """
    corpus = signed.select("doc_id", "bucket", "vector", norm(F.col("vector")).alias("length"))
    asked = queries.select("qid", "q_bucket", "q_vector", norm(F.col("q_vector")).alias("q_length"))
    pairs = _pairs(corpus, asked)
    if exclude_self:
        pairs = pairs.filter("qid <> doc_id")
    return rank_topk(_scored(pairs), k, digits=kernels.TIE_DIGITS)


def _scored(pairs: DataFrame) -> DataFrame:
    score = F.try_divide(dot(F.col("q_vector"), F.col("vector")), F.col("q_length") * F.col("length"))
    return pairs.withColumn("score", F.coalesce(score, F.lit(0.0)))


def rerank(pairs: DataFrame, vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Candidate pairs (qid, doc_id), a written table, ranked by cosine; a query's own row is left out."""
    corpus = vectors.filter("vector is not null").select("doc_id", "vector", norm(F.col("vector")).alias("length"))
    asked = queries.select("qid", "q_vector", norm(F.col("q_vector")).alias("q_length"))
    met = checked_join(corpus, pairs.filter("qid <> doc_id"), ["doc_id"], 32, "qid", skewed="small")
    met = checked_join(met, asked, ["qid"], F.size("q_vector") * 8 + 24, "doc_id")
    return rank_topk(_scored(met), k, digits=kernels.TIE_DIGITS)
