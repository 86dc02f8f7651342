"""New documents to index rows as they arrive.

Tokens, words, signatures and bucket keys depend on one row only, so the batch code runs on a
stream unchanged: no state and no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from nearkin.plans.features import lsh_features, tokens_of


def lsh_rows(documents: DataFrame, num_perm: int = 128, threshold: float = 0.8, shingle_n: int = 5) -> DataFrame:
    """(doc_id, words, keys) of a streaming or batch table of documents."""
    return lsh_features(tokens_of(documents), num_perm, threshold, shingle_n)


def start_ingest(documents: DataFrame, path: str, checkpoint: str, **settings) -> StreamingQuery:
    """Appends the index rows of a stream of documents to a Parquet table, each exactly once."""
    rows = lsh_rows(documents, **settings)
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
