"""The queries of the llm operators over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.llm import ann, bpe, jaccard, lm, mixing, phrases, quality, resample, sharding, substring, topk, urls, warc
from nearkin.session import ship

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    documents = quality.text_stats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text, counts = F.col("text"), {name: F.col(name) for name in quality.STATS}
    base, more = quality.base_rules(counts), quality.more_rules(counts, text)
    failed = base["few_words"] | base["repetition"]
    order = quality.rule_order(quality.sample_rows(documents, "text"), more)
    kept = ~failed & quality.cascade(more, order).isNull()
    return documents.select("doc_id", *quality.STATS, failed.alias("base_failed"), kept.alias("kept"))


@query
def op2_substring_dedup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(documents).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.integer_codes(F.col("embedding")).alias("codes"))
    return topk.topk(rows, rows.where(F.col("vec_id") % 100 == 0), "vec_id", "codes", k=10)


@query
def op4_sharding(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sharding.shuffled_shards(documents, sharding.size_of(F.col("text")), shards=8)
    return rows.select(
        "doc_id", sharding.size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_lm_scoring(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", lm.held_out("doc_id").alias("held_out"))
    model = lm.train(documents.where(~F.col("held_out")), order=3)
    return lm.score(documents, model, keep=("doc_id", "held_out")).withColumn("train_tokens", F.lit(model.tokens).cast("bigint"))


#: The rules of the URL query as (host, path, action).
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query
def op6_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.judge(pages, rules, urls.page_links(pages))


@query
def op7_warc_derivatives(spark, sf_dir):
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages"))).select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "header", "payload_digest", "block_digest", "content_type",
        "content_length", "block")


@query
def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.encode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        keep=("doc_id",), ids=False, digests=True)


@query
def op9_ngram_jaccard(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_components(documents).select("doc_id", "n_shingles", "component_id", "n_links")


def token_count(text):
    return F.size(quality.words_of(text)).cast("bigint")


@query
def op10_temperature_mix(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", token_count(F.col("text")).alias("n_tokens"))
    return mixing.temperature_mix(documents, "source", F.col("n_tokens"), repetition_limit=2.0).rows


@query
def op11_cross_polytope(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, rows.where(F.col("vec_id") % 20 == 0), "vec_id", "embedding", k=20)


@query
def op12_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def op13_importance_resampling(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.importance_resample(documents, table(spark, sf_dir, "benchmark").select("text")).select(
        "doc_id", "n_features", "weight", "score", "rank")
