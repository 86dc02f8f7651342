"""Jaccard similarity of randomly drawn pairs of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions.hashing import md5_number
from nearkin.functions.text import jaccard
from nearkin.operators.ranking import ids_at_places
from nearkin.plans.scale import checked_join, written

PERCENTS = (10, 25, 50, 75, 90, 95)


def _draws(spark, n_samples: int, n_docs: int, seed: int) -> DataFrame:
    def place(side: str):
        text = F.concat(F.lit(f"{seed}:"), F.col("draw").cast("string"), F.lit(f":{side}"))
        return F.struct(F.lit(side).alias("side"), F.pmod(md5_number(text), F.lit(n_docs)).alias("place"))

    drawn = spark.range(n_samples).withColumnRenamed("id", "draw")
    return drawn.select("draw", F.explode(F.array(place("a"), place("b"))).alias("p")).select("draw", "p.side", "p.place")


def jaccard_sample(
    corpus: DataFrame, n_samples: int = 2000, seed: int = 42, make_words: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(draw, a_id, b_id, jaccard) for pairs drawn with replacement from (doc_id, words).

    With `make_words` the corpus may be any table with doc_id: only the rows that were drawn are turned into (doc_id, words).

    A draw of the same document twice is left out, so there may be fewer rows than draws.
    """
    spark = corpus.sparkSession
    n_docs = corpus.count()
    if not n_docs:
        return spark.createDataFrame([], "draw bigint, a_id bigint, b_id bigint, jaccard double")
    named = ids_at_places(corpus, _draws(spark, n_samples, n_docs, seed)).drop("place")
    named = written(named.withColumnRenamed("_id", "doc_id"))
    rows = corpus if make_words else corpus.select("doc_id", "words")
    drawn = written(checked_join(rows, written(named.select("doc_id").distinct()), ["doc_id"], 16, "doc_id"))
    drawn = make_words(drawn).select("doc_id", "words") if make_words else drawn
    sided = checked_join(drawn, named, ["doc_id"], 32, "doc_id")
    pair = sided.groupBy("draw").agg(
        F.min(F.when(F.col("side") == "a", F.struct("doc_id", "words"))).alias("a"),
        F.min(F.when(F.col("side") == "b", F.struct("doc_id", "words"))).alias("b"),
    )
    return pair.filter("a.doc_id <> b.doc_id").select(
        "draw", F.col("a.doc_id").alias("a_id"), F.col("b.doc_id").alias("b_id"),
        jaccard(F.col("a.words"), F.col("b.words")).alias("jaccard"),
    )


def percentiles(sample: DataFrame, column: str = "jaccard", percents: tuple[int, ...] = PERCENTS) -> DataFrame:
    """(percent, value), linearly interpolated; equal values are counted before they meet."""
    counted = sample.groupBy(column).agg(F.count("*").alias("n"))
    points = F.percentile(F.col(column), F.array(*[F.lit(p / 100) for p in percents]), F.col("n"))
    wide = counted.agg(points.alias("v"))
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in percents]).alias("percent"), F.col("v").alias("value"))
    return wide.filter("v is not null").select(F.inline(pairs)).toDF("percent", "value")
