"""Every operator as a query over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import settings as S
from nearkin.functions import text as T
from nearkin.functions import vectors as V
from nearkin.functions.banding import best_bands
from nearkin.functions.hashing import md5_number
from nearkin.operators import cells, hyperplane, ivf, lsh, lsi, pairs, pq, search, skipgram, terms, words
from nearkin.operators.ranking import as_queries, first_n, query_sample, rows_of
from nearkin.plans import evaluate, features, pipeline, sweep
from nearkin.plans.scale import scratch_folder, spread, written
from nearkin.session import ship
from nearkin.sources.text import merge_csv as read_merged
from nearkin.sources.metrics import save_metrics, write_json
from nearkin.sources.tables import read_signatures, read_table, signature_path, write_table
from nearkin.sources.text import read_documents, read_tokens, union_by_name, write_csv, write_tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


# ------------------------------------------------------------------ inputs

def documents(spark, sf_dir) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spread(table, "doc_id")


def vectors(spark, sf_dir) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return table.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))


def tokens(spark, sf_dir) -> DataFrame:
    return features.tokens_of(documents(spark, sf_dir))


def document_sample(spark, sf_dir, n=S.N_QUERIES) -> DataFrame:
    return listed(query_sample(spark.read.parquet(f"{sf_dir}/documents.parquet"), n))


def vector_sample(spark, sf_dir, n=S.N_QUERIES) -> DataFrame:
    return listed(query_sample(vectors(spark, sf_dir), n))


def listed(sample: DataFrame) -> DataFrame:
    """The ids of a sample as a table of literals, so that it is drawn once."""
    return sample.sparkSession.createDataFrame(sample.toArrow())


def asked_vectors(spark, sf_dir, n=S.N_QUERIES) -> DataFrame:
    return rows_of(vectors(spark, sf_dir), vector_sample(spark, sf_dir, n)).withColumnRenamed("doc_id", "qid")


def asked_words(spark, sf_dir, n=S.N_QUERIES, corpus=None) -> DataFrame:
    asked = rows_of(corpus or tokens(spark, sf_dir), document_sample(spark, sf_dir, n))
    return features.words_of(asked).withColumnRenamed("doc_id", "qid")


def lsh_corpus(spark, sf_dir, corpus=None) -> DataFrame:
    """Keys and words as a table: a search reads the columns it needs."""
    return written(features.lsh_features(corpus or tokens(spark, sf_dir), S.NUM_PERM, S.THRESHOLD, S.SHINGLE_N))


def lsh_queries(spark, sf_dir, corpus=None) -> DataFrame:
    asked = rows_of(corpus or tokens(spark, sf_dir), document_sample(spark, sf_dir))
    return as_queries(features.lsh_features(asked, S.NUM_PERM, S.THRESHOLD, S.SHINGLE_N))


def signed_vectors(spark, sf_dir) -> DataFrame:
    return hyperplane.hyperplane_signatures(vectors(spark, sf_dir), S.N_BITS)


def signed_queries(spark, sf_dir) -> DataFrame:
    asked = rows_of(vectors(spark, sf_dir), vector_sample(spark, sf_dir))
    return as_queries(hyperplane.hyperplane_signatures(asked, S.N_BITS))


def codebooks(spark, sf_dir) -> DataFrame:
    return pq.train_codebooks(vectors(spark, sf_dir), S.PQ_M, S.PQ_KS, S.ROUNDS)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Shown with six digits; ranks were given before."""
    return df.select([F.round(c, 6).alias(c) if c in columns else F.col(c) for c in df.columns])


def rounded_list(column: str):
    return F.transform(column, lambda x: F.round(x, 6)).alias(column)


# ------------------------------------------------------------------ text

@query
def union_by_name_(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", F.col("html").alias("text"))
    return union_by_name([docs, items, pages])


@query
def tokenize(spark, sf_dir):
    return tokens(spark, sf_dir)


@query
def joined_text(spark, sf_dir):
    return tokens(spark, sf_dir).select("doc_id", T.joined(F.col("tokens")).alias("joined"))


@query
def first_n_docs(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return features.tokens_of(first_n(table, S.MAX_DOCS))


@query
def token_sets(spark, sf_dir):
    sets = features.words_of(tokens(spark, sf_dir))
    return sets.select("doc_id", F.array_sort("words").alias("words"))


@query
def shingles(spark, sf_dir):
    runs = T.shingles(F.col("tokens"), S.SHINGLE_N)
    return tokens(spark, sf_dir).select("doc_id", runs.alias("shingles"))


@query
def term_counts(spark, sf_dir):
    return terms.term_counts(tokens(spark, sf_dir))


@query
def vocabulary(spark, sf_dir):
    return terms.vocabulary(term_counts(spark, sf_dir), S.MAX_FEATURES)


def weighing(spark, sf_dir):
    """Tokens, vocabulary and number of documents."""
    vocab = written(vocabulary(spark, sf_dir))
    return tokens(spark, sf_dir), vocab, spark.read.parquet(f"{sf_dir}/documents.parquet").count()


@query
def tfidf(spark, sf_dir):
    return rounded(terms.tfidf(*weighing(spark, sf_dir)), "tfidf")


@query
def lsi_embed(spark, sf_dir):
    rows, names = terms.tfidf_rows(*weighing(spark, sf_dir))
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return lsi.lsi_embed(rows, names, table, S.LSI_DIMS)[0]


@query
def lsi_leading(spark, sf_dir):
    """The three strongest latent directions, after as many passes as four digits need."""
    rows, names = terms.tfidf_rows(*weighing(spark, sf_dir))
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found, _ = lsi.lsi_embed(rows, names, table, 3, power_steps=S.LEADING_STEPS, exact_steps=S.LEADING_STEPS // 2)
    return found.select("doc_id", *[F.round(F.col("embedding")[i], 4).alias(f"direction_{i + 1}") for i in range(3)])


@query
def word2vec_train(spark, sf_dir):
    model = words.train_word2vec(tokens(spark, sf_dir), S.W2V_SIZE, min_count=S.W2V_MIN_COUNT)
    return words.word_vectors(model)


@query
def word2vec_embed(spark, sf_dir):
    corpus = written(tokens(spark, sf_dir))
    model = words.train_word2vec(corpus, S.W2V_SIZE, min_count=S.W2V_MIN_COUNT)
    return words.mean_pool(corpus, words.word_vectors(model))


@query
def skipgram_two_rounds(spark, sf_dir):
    """Word vectors after two epochs on one block of words, with fixed start values and draws."""
    found = skipgram.train_skipgram(
        tokens(spark, sf_dir), S.SG_SIZE, S.SG_WINDOW, S.SG_MIN_COUNT, epochs=2, draws=S.SG_DRAWS, rate=S.SG_RATE, steps=1, seed=S.SEED, blocks=1)
    return found.select("word", rounded_list("vector"))


def md5_word_vectors(counts: DataFrame) -> DataFrame:
    """Vectors made from the md5 of every word that occurs at least twice."""
    known = counts.groupBy("term").agg(F.sum("tf").alias("total")).filter(F.col("total") >= S.W2V_MIN_COUNT)
    numbers = [md5_number(F.concat("term", F.lit(f":{i}"))) % 2_000_006 / 1_000_003.0 - 1.0 for i in range(S.POOL_DIM)]
    return known.select(F.col("term").alias("word"), F.array(*numbers).alias("vector"))


@query
def mean_pool(spark, sf_dir):
    corpus = written(tokens(spark, sf_dir))
    pooled = words.mean_pool(corpus, md5_word_vectors(terms.term_counts(corpus)))
    return pooled.select("doc_id", rounded_list("embedding"))


# ------------------------------------------------------------------ MinHash

@query
def minhash_signature(spark, sf_dir):
    return lsh.minhash_signatures(tokens(spark, sf_dir), S.NUM_PERM, S.SHINGLE_N).select("doc_id", "signature")


@query
def lsh_bands(spark, sf_dir):
    return lsh.band_table(minhash_signature(spark, sf_dir), *best_bands(S.THRESHOLD, S.NUM_PERM))


@query
def lsh_candidates(spark, sf_dir):
    return lsh.lsh_candidates(lsh_corpus(spark, sf_dir), lsh_queries(spark, sf_dir))


def lsh_answers(spark, sf_dir, corpus=None):
    return lsh.lsh_topk(lsh_corpus(spark, sf_dir, corpus), lsh_queries(spark, sf_dir, corpus), S.K)


@query
def lsh_topk(spark, sf_dir):
    return lsh_answers(spark, sf_dir)


@query
def lsh_candidate_stats(spark, sf_dir):
    counts = lsh.candidate_counts(lsh_corpus(spark, sf_dir).select("doc_id", "keys"))
    return rounded(lsh.candidate_stats(counts), "mean_candidates", "share_none", "share_self_only")


@query
def lsh_candidate_examples(spark, sf_dir):
    return lsh.candidate_examples(lsh_corpus(spark, sf_dir).select("doc_id", "keys"))


# ------------------------------------------------------------------ vectors

@query
def l2_normalize(spark, sf_dir):
    unit = V.l2_normalize(F.col("vector")).alias("vector")
    return vectors(spark, sf_dir).select("doc_id", unit).select("doc_id", rounded_list("vector"))


@query
def hyperplane_signature(spark, sf_dir):
    return hyperplane.hyperplane_signatures(vectors(spark, sf_dir), S.SIGNATURE_BITS).select("doc_id", "bucket")


@query
def hyperplane_buckets(spark, sf_dir):
    return hyperplane.hyperplane_buckets(signed_vectors(spark, sf_dir))


@query
def hyperplane_bucket_sizes(spark, sf_dir):
    return hyperplane.hyperplane_bucket_sizes(signed_vectors(spark, sf_dir))


@query
def hyperplane_candidates(spark, sf_dir):
    return hyperplane.hyperplane_candidates(signed_vectors(spark, sf_dir), signed_queries(spark, sf_dir))


@query
def hyperplane_topk(spark, sf_dir):
    found = hyperplane.hyperplane_topk(signed_vectors(spark, sf_dir), signed_queries(spark, sf_dir), S.K)
    return rounded(found, "score")


@query
def hyperplane_topk_wide(spark, sf_dir):
    """The same with few planes: large buckets, so that nearly every query has its k rows."""
    table, asked = vectors(spark, sf_dir), rows_of(vectors(spark, sf_dir), vector_sample(spark, sf_dir))
    signed, queries = (hyperplane.hyperplane_signatures(df, S.WIDE_BITS) for df in (table, asked))
    return rounded(hyperplane.hyperplane_topk(signed, as_queries(queries), S.K), "score")


@query
def pq_subvectors(spark, sf_dir):
    table = vectors(spark, sf_dir)
    parts = V.subvectors(F.col("vector"), S.PQ_M, S.DIM)
    return table.select("doc_id", F.posexplode(parts).alias("m", "part")).select("doc_id", "m", rounded_list("part"))


@query
def pq_train(spark, sf_dir):
    return codebooks(spark, sf_dir).select("m", "code", rounded_list("centroid"))


def best_codebooks(spark, sf_dir) -> DataFrame:
    return pq.train_codebooks(vectors(spark, sf_dir), S.PQ_M, S.PQ_KS, S.ROUNDS, starts=S.PQ_STARTS)


@query
def pq_train_best(spark, sf_dir):
    """Of several starts the one with the least inertia, for each sub-space."""
    return best_codebooks(spark, sf_dir).select("m", "code", rounded_list("centroid"))


@query
def pq_inertia(spark, sf_dir):
    """Inertia of the codebooks of one start and of the best of several."""
    table = vectors(spark, sf_dir)
    made = {1: written(codebooks(spark, sf_dir)), S.PQ_STARTS: written(best_codebooks(spark, sf_dir))}
    tagged = [pq.codebook_inertia(table, books).withColumn("starts", F.lit(n)) for n, books in made.items()]
    return rounded(union_by_name(tagged), "inertia")


@query
def pq_encode(spark, sf_dir):
    return pq.encode(vectors(spark, sf_dir), codebooks(spark, sf_dir))


@query
def pq_distance_table(spark, sf_dir):
    table = pq.distance_table(asked_vectors(spark, sf_dir), codebooks(spark, sf_dir))
    return table.select("qid", "m", rounded_list("distances"))


def pq_answers(spark, sf_dir, n=S.N_QUERIES):
    books = written(codebooks(spark, sf_dir))
    codes = pq.encode(vectors(spark, sf_dir), books)
    return pq.pq_topk(codes, books, asked_vectors(spark, sf_dir, n), S.K)


def small_vectors(spark, sf_dir):
    """Raw vectors scaled down: answers and codes must not depend on the size of the numbers."""
    small = F.transform("vector", lambda x: x.cast("double") * S.SMALL)
    return vectors(spark, sf_dir).select("doc_id", small.alias("vector"))


@query
def pq_encode_small(spark, sf_dir):
    table = small_vectors(spark, sf_dir)
    return pq.encode(table, pq.train_codebooks(table, S.PQ_M, S.PQ_KS, S.ROUNDS))


@query
def inner_product_topk_raw(spark, sf_dir):
    table = small_vectors(spark, sf_dir)
    asked = rows_of(table, vector_sample(spark, sf_dir)).withColumnRenamed("doc_id", "qid")
    return search.inner_product_topk(table, asked, S.K).select("qid", "doc_id", "rank")


@query
def merge_csv(spark, sf_dir):
    """Given tables written as CSV files of two headers and read back as one."""
    folder = f"{scratch_folder(spark)}/csv-{uuid.uuid4().hex}"
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    for name, df in (("items", items), ("labels", labels), ("merged", items)):
        write_csv(df, f"{folder}/{name}")
    return read_merged(spark, f"{folder}/*/*.csv", f"{folder}/merged")


@query
def merge_csv_quoted(spark, sf_dir):
    """The same with column names that hold line breaks, commas and quotes; two headers agree in their first line."""
    folder = f"{scratch_folder(spark)}/csv-{uuid.uuid4().hex}"
    names = {"id\nof item": "item_id", "id\nof doc": "doc_id", 'id, "page"': "page_id"}
    parts = {"items": ("benchmark", "item_id", "text"), "labels": ("labels", "doc_id", "quality"), "pages": ("pages", "page_id", "url")}
    for (name, (source, key, value)), odd in zip(parts.items(), names):
        write_csv(spark.read.parquet(f"{sf_dir}/{source}.parquet").select(F.col(key).alias(odd), value), f"{folder}/{name}")
    merged = read_merged(spark, f"{folder}/*/*.csv")
    return merged.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in merged.columns])


@query
def pq_topk(spark, sf_dir):
    return rounded(pq_answers(spark, sf_dir), "score")


@query
def ivf_topk(spark, sf_dir):
    table = vectors(spark, sf_dir)
    centres = written(ivf.train_cells(table, S.CELLS, S.ROUNDS))
    placed = ivf.assign_cells(table, centres)
    return rounded(ivf.ivf_topk(placed, centres, asked_vectors(spark, sf_dir), S.K, S.NPROBE), "score")


def cell_index(spark, sf_dir):
    return cells.build(vectors(spark, sf_dir), S.CELLS, S.ROUNDS)


@query
def cosine_topk_cells(spark, sf_dir):
    """The exact answers, without looking into cells that cannot hold one."""
    found, _ = cells.exact_topk(cell_index(spark, sf_dir), asked_vectors(spark, sf_dir), S.K)
    return rounded(found, "score")


@query
def cells_compared(spark, sf_dir):
    """How many rows each query is compared with by that search."""
    index = cell_index(spark, sf_dir)
    return cells.rows_compared(index, cells.exact_topk(index, asked_vectors(spark, sf_dir), S.K)[1])


@query
def ivf_codes_topk(spark, sf_dir):
    """Probed cells searched by residual codes, a short list ranked by vectors."""
    index = cell_index(spark, sf_dir)
    books = written(pq.train_codebooks(cells.residuals(index), S.PQ_M, S.RESIDUAL_KS, S.ROUNDS))
    coded = written(cells.with_codes(index, books))
    asked = asked_vectors(spark, sf_dir)
    return rounded(cells.reranked_topk(coded, index.centres, books, asked, S.K, S.NPROBE, S.REFINE), "score")


def cosine_truth(spark, sf_dir, n=S.N_QUERIES):
    return search.cosine_topk(vectors(spark, sf_dir), asked_vectors(spark, sf_dir, n), S.K)


@query
def cosine_topk(spark, sf_dir):
    return rounded(cosine_truth(spark, sf_dir), "score")


def flat_answers(spark, sf_dir, n=S.N_QUERIES):
    unit = V.l2_normalize(F.col("vector")).alias("vector")
    corpus = vectors(spark, sf_dir).select("doc_id", unit)
    asked = asked_vectors(spark, sf_dir, n).select("qid", unit)
    return search.inner_product_topk(corpus, asked, S.K)


@query
def inner_product_topk(spark, sf_dir):
    return rounded(flat_answers(spark, sf_dir), "score")


def jaccard_truth(spark, sf_dir, n=S.N_QUERIES, corpus=None):
    words = features.words_of(corpus or tokens(spark, sf_dir))
    return search.jaccard_topk(words, asked_words(spark, sf_dir, n, corpus), S.K)


@query
def jaccard_topk(spark, sf_dir):
    return jaccard_truth(spark, sf_dir)


# ------------------------------------------------------------------ evaluation

@query
def query_sample_(spark, sf_dir):
    return query_sample(spark.read.parquet(f"{sf_dir}/documents.parquet"), S.N_QUERIES)


def recalls(spark, sf_dir) -> dict[str, DataFrame]:
    asked, asked_docs = vector_sample(spark, sf_dir), document_sample(spark, sf_dir)
    cosine, corpus = written(cosine_truth(spark, sf_dir)), written(tokens(spark, sf_dir))
    return {
        "pq": evaluate.recall_per_query(asked, cosine, pq_answers(spark, sf_dir), S.K),
        "lsh": evaluate.recall_per_query(asked_docs, jaccard_truth(spark, sf_dir, corpus=corpus), lsh_answers(spark, sf_dir, corpus), S.K),
        "flat": evaluate.recall_per_query(asked, cosine, flat_answers(spark, sf_dir), S.K),
    }


@query
def recall_per_query(spark, sf_dir):
    tagged = [df.select(F.lit(m).alias("method"), "qid", "recall") for m, df in recalls(spark, sf_dir).items()]
    return rounded(union_by_name(tagged), "recall")


@query
def method_recall(spark, sf_dir):
    return rounded(evaluate.method_recall(recalls(spark, sf_dir)), "recall")


@query
def query_report(spark, sf_dir):
    asked, asked_docs = vector_sample(spark, sf_dir), document_sample(spark, sf_dir)
    cosine = written(cosine_truth(spark, sf_dir))
    reports = {
        "pq": evaluate.query_report(asked, cosine, pq_answers(spark, sf_dir)),
        "lsh": evaluate.query_report(
            asked_docs, jaccard_truth(spark, sf_dir), lsh_answers(spark, sf_dir),
            lsh.lsh_candidates(lsh_corpus(spark, sf_dir), lsh_queries(spark, sf_dir)),
        ),
        "flat": evaluate.query_report(asked, cosine, flat_answers(spark, sf_dir)),
    }
    return union_by_name([df.withColumn("method", F.lit(m)) for m, df in reports.items()])


def drawn_pairs(spark, sf_dir):
    return pairs.jaccard_sample(
        documents(spark, sf_dir), S.N_SAMPLES, make_words=lambda df: features.words_of(features.tokens_of(df)))


@query
def jaccard_sample(spark, sf_dir):
    return drawn_pairs(spark, sf_dir)


@query
def jaccard_percentiles(spark, sf_dir):
    return rounded(pairs.percentiles(drawn_pairs(spark, sf_dir)), "value")


def sweep_table(spark, sf_dir):
    n, corpus = S.SWEEP_QUERIES, written(tokens(spark, sf_dir))
    sample = document_sample(spark, sf_dir, n)
    table = sweep.lsh_sweep(corpus, sample, jaccard_truth(spark, sf_dir, n, corpus), S.K)
    asked = vector_sample(spark, sf_dir, n)
    cosine = written(cosine_truth(spark, sf_dir, n))
    fixed = evaluate.method_recall({
        "pq": evaluate.recall_per_query(asked, cosine, pq_answers(spark, sf_dir, n), S.K),
        "flat": evaluate.recall_per_query(asked, cosine, flat_answers(spark, sf_dir, n), S.K),
    })
    return sweep.with_fixed_methods(table, fixed.select("method", "recall"))


@query
def lsh_sweep(spark, sf_dir):
    return rounded(sweep_table(spark, sf_dir), "recall")


@query
def lsh_sweep_times(spark, sf_dir):
    n = S.SWEEP_QUERIES
    books = written(codebooks(spark, sf_dir))
    codes = written(pq.encode(vectors(spark, sf_dir), books))
    asked = written(asked_vectors(spark, sf_dir, n))
    fixed = sweep.fixed_times(spark, {
        "pq": lambda: pq.pq_topk(codes, books, asked, S.K), "flat": lambda: flat_answers(spark, sf_dir, n)}, n)
    return sweep.sweep_times(tokens(spark, sf_dir), document_sample(spark, sf_dir, n), S.K).unionByName(fixed)


@query
def sweep_time_pivot(spark, sf_dir):
    """The time series beside the recall series: one row per method and number of hashes, one column per threshold."""
    return sweep.sweep_series(lsh_sweep_times(spark, sf_dir), value="avg_time")


@query
def sweep_pivot(spark, sf_dir):
    return sweep.sweep_series(rounded(sweep_table(spark, sf_dir), "recall"))


@query
def pipeline_metrics(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pipeline.run_pipeline(spark, table)


@query
def pipeline_recall(spark, sf_dir):
    """The run's methods and queries, and the recall of those methods that involve no iteration."""
    metrics = pipeline.run_pipeline(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    known = F.when(F.col("method") != "pq", F.round("recall", 6))
    return metrics.select("method", "n_queries", known.alias("recall"))


@query
def pipeline_shingles(spark, sf_dir):
    """A run whose MinHash answers are ranked on and measured by shingle sets, with the number of rows compared."""
    config = pipeline.PipelineConfig(basis="shingle", methods=("lsh", "flat"), lsi_dims=S.DIM, power_steps=1)
    metrics = pipeline.run_pipeline(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), config)
    return rounded(metrics.select("method", "n_queries", "n_candidates", "recall"), "recall")


# ------------------------------------------------------------------ sinks: written and read back

def folder_of(spark) -> str:
    return f"{scratch_folder(spark)}/sink-{uuid.uuid4().hex}"


@query
def saved_documents(spark, sf_dir):
    return read_documents(spark, f"{sf_dir}/documents.parquet")


@query
def saved_tokens(spark, sf_dir):
    path = folder_of(spark)
    write_tokens(tokens(spark, sf_dir), path)
    return read_tokens(spark, path).select("doc_id", "joined")


@query
def saved_embeddings(spark, sf_dir):
    path = folder_of(spark)
    write_table(vectors(spark, sf_dir).withColumnRenamed("vector", "embedding"), "embeddings", path)
    back = read_table(spark, "embeddings", path)
    return back.select("doc_id", F.col("embedding").cast("array<double>").alias("embedding")).select("doc_id", rounded_list("embedding"))


@query
def saved_signatures(spark, sf_dir):
    path = signature_path(folder_of(spark), S.NUM_PERM, S.SHINGLE_N)
    write_table(lsh.minhash_signatures(tokens(spark, sf_dir), S.NUM_PERM, S.SHINGLE_N), "signatures", path)
    return read_signatures(spark, path, S.NUM_PERM)


@query
def saved_bands(spark, sf_dir):
    path = folder_of(spark)
    signed = lsh.minhash_signatures(tokens(spark, sf_dir), S.NUM_PERM, S.SHINGLE_N)
    write_table(lsh.band_table(signed, *best_bands(S.THRESHOLD, S.NUM_PERM)), "bands", path)
    return read_table(spark, "bands", path)


@query
def saved_pq_index(spark, sf_dir):
    path = folder_of(spark)
    write_table(codebooks(spark, sf_dir), "codebooks", f"{path}/codebooks")
    write_table(pq.encode(vectors(spark, sf_dir), read_table(spark, "codebooks", f"{path}/codebooks")), "codes", f"{path}/codes")
    return read_table(spark, "codes", f"{path}/codes")


@query
def saved_metrics_json(spark, sf_dir):
    path = folder_of(spark)
    write_json(method_recall(spark, sf_dir), path)
    return spark.read.schema("method string, n_queries bigint, recall double").json(path)


@query
def saved_metrics_csv(spark, sf_dir):
    path = folder_of(spark)
    counts = [{"table": t, "n_rows": spark.read.parquet(f"{sf_dir}/{t}.parquet").count()} for t in ("documents", "pages", "benchmark")]
    save_metrics(spark, counts, path)
    return spark.read.csv(path, header=True, schema="table string, n_rows bigint")


@query
def saved_jaccard_sample(spark, sf_dir):
    path = folder_of(spark)
    write_json(jaccard_sample(spark, sf_dir), path)
    return spark.read.schema("draw bigint, a_id bigint, b_id bigint, jaccard double").json(path)


@query
def word2vec_vocabulary(spark, sf_dir):
    """The words that training has kept, and how long their vectors are."""
    return word2vec_train(spark, sf_dir).select("word", F.size("vector").alias("dim"))


# names that would hide an imported function inside this module
for name in ("union_by_name_", "query_sample_"):
    QUERIES[name.rstrip("_")] = QUERIES.pop(name)
