"""Top-k per query and fixed orders of ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.functions.hashing import id_order

MAX_LISTED_IDS = 4_096
BUCKET_DIGITS = 4  # 65,536 buckets of ids: the list of their sizes is bounded


def significant(score: Column, digits: int) -> Column:
    """The score cut to so many significant digits."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(score))))
    return F.when(score == 0, score).otherwise(F.round(score / power, digits - 1) * power)


def rank_topk(scored: DataFrame, k: int, digits: int | None = None) -> DataFrame:
    """The k best rows (qid, doc_id, score, rank) of each query; equal scores by smaller id.

    With `digits`, scores that agree to so many significant digits count as equal, whatever their size. Scores that
    are null or not a number are no answers. Spark keeps k rows per query and task before the shuffle
    (WindowGroupLimit).
    """
    score = F.col("score") if digits is None else significant(F.col("score"), digits)
    scored = scored.filter(~F.isnan("score"))
    order = Window.partitionBy("qid").orderBy(score.desc(), F.col("doc_id"))
    return (
        scored.select("qid", "doc_id", "score")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )


def first_n(df: DataFrame, n: int | None, id_col: str = "doc_id") -> DataFrame:
    """The n rows with the smallest ids; None or 0 keeps all rows."""
    return df.orderBy(id_col).limit(n) if n else df


def query_sample(df: DataFrame, n: int, id_col: str = "doc_id") -> DataFrame:
    """min(n, rows) ids as `qid`, the same ones on every run and partitioning."""
    return df.select(F.col(id_col).alias("qid")).orderBy(id_order(F.col("qid")), "qid").limit(n)


def ids_at_places(df: DataFrame, places: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds to `places` (column `place`, 0..n-1) the id standing there in a fixed order of all ids.

    The order is by the first hex digits of md5(id), then by id. The digits cut the ids into
    even buckets; only their sizes are gathered, and only buckets that are asked for are sorted,
    each on its own.
    """
    ids = df.select(F.col(id_col).alias("_id"))
    ids = ids.withColumn("_bucket", F.substring(id_order(F.col("_id")), 1, BUCKET_DIGITS))
    sizes = sorted((r["_bucket"], r["count"]) for r in ids.groupBy("_bucket").count().collect())
    names = [name for name, _ in sizes]
    ends = np.cumsum([size for _, size in sizes])
    begins = ends - np.array([size for _, size in sizes])

    def locate(batches):
        for batch in batches:
            place = batch.column("place").to_numpy()
            bucket = np.searchsorted(ends, place, side="right")
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array([names[b] for b in bucket], pa.string()),
                                 pa.array(place - begins[bucket], pa.int64())],
                names=batch.schema.names + ["_bucket", "_at"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in places.schema.fields)
    located = places.mapInArrow(locate, f"{schema}, _bucket string, _at bigint")
    asked = located.select("_bucket").distinct()  # at most 65,536 rows
    in_bucket = Window.partitionBy("_bucket").orderBy("_id")
    numbered = (
        ids.join(F.broadcast(asked), "_bucket", "left_semi")
        .withColumn("_at", (F.row_number().over(in_bucket) - 1).cast("bigint"))
    )
    return located.join(numbered, ["_bucket", "_at"]).drop("_bucket", "_at")


def rows_of(df: DataFrame, sample: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows named by a sample (qid). Apply it to the source, before costly features.

    A short list of ids becomes a filter that reaches the scan and skips row groups there.
    """
    ids = [row["qid"] for row in sample.select("qid").limit(MAX_LISTED_IDS + 1).collect()]
    if len(ids) <= MAX_LISTED_IDS:
        return df.filter(F.col(id_col).isin(ids))
    return df.join(sample.select(F.col("qid").alias(id_col)), id_col, "left_semi")


def as_queries(features: DataFrame) -> DataFrame:
    """Renames doc_id, words, keys, bucket and vector to their query-side names."""
    names = {"doc_id": "qid", "words": "q_words", "keys": "q_keys", "bucket": "q_bucket", "vector": "q_vector"}
    return features.select([F.col(c).alias(names.get(c, c)) for c in features.columns])
