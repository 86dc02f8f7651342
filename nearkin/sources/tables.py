"""Vectors, signatures, bands, codebooks and codes as Parquet tables with a shape check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.plans.scale import small_batches
from nearkin.sources.text import require_columns

# columns each kind of table must have, and the column a reader usually filters on
KINDS: dict[str, tuple[tuple[str, ...], str | None]] = {
    "embeddings": (("doc_id", "embedding"), None),
    "signatures": (("doc_id", "signature"), None),
    "features": (("doc_id", "words", "keys"), None),
    "bands": (("doc_id", "band", "bucket"), "band"),
    "buckets": (("bucket", "doc_id"), None),
    "codebooks": (("m", "code", "centroid"), None),
    "codes": (("doc_id", "codes"), None),
    "cells": (("doc_id", "vector", "cell"), "cell"),
    "neighbors": (("qid", "doc_id", "score", "rank"), None),
}


def write_table(df: DataFrame, kind: str, path: str, codec: str = "snappy") -> None:
    columns, split_by = KINDS[kind]
    writer = require_columns(df, *columns).select(*columns).write.mode("overwrite").option("compression", codec)
    with small_batches(df.sparkSession):
        (writer.partitionBy(split_by) if split_by else writer).parquet(path)


def read_table(spark: SparkSession, kind: str, path: str) -> DataFrame:
    columns, _ = KINDS[kind]
    return require_columns(spark.read.parquet(path), *columns).select(*columns)


def signature_path(folder: str, num_perm: int, shingle_n: int) -> str:
    """Signatures of different settings never share a path."""
    return f"{folder}/signatures_np{num_perm}_sh{shingle_n}"


def read_signatures(spark: SparkSession, path: str, num_perm: int) -> DataFrame:
    table = read_table(spark, "signatures", path)
    odd = table.filter(F.size("signature") != num_perm).limit(1).count()
    if odd:
        raise ValueError(f"signatures at {path} do not have {num_perm} numbers")
    return table
