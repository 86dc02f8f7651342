"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Arguments pick queries by name.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import catalog  # noqa: E402
from checks.catalog import QUERIES  # noqa: E402
from nearkin.functions.vectors import l2_normalize  # noqa: E402
from nearkin.operators import lsh, pq, search  # noqa: E402
from nearkin.operators.ranking import as_queries, query_sample, rows_of  # noqa: E402
from nearkin.plans.features import lsh_features  # noqa: E402
from nearkin.plans.scale import written  # noqa: E402
from nearkin.session import local_session  # noqa: E402

HEADLINE = (
    "tokenize", "shingles", "term_counts", "vocabulary", "tfidf", "mean_pool",
    "minhash_signature", "lsh_bands", "lsh_candidates", "lsh_topk", "lsh_candidate_stats",
    "hyperplane_signature", "hyperplane_topk", "pq_train", "pq_encode", "pq_topk", "ivf_topk",
    "cosine_topk", "inner_product_topk", "jaccard_topk", "jaccard_sample", "method_recall", "lsh_sweep",
    "lsi_embed", "pipeline_metrics",
)

WARM_UP = ("hyperplane_signature", "term_counts", "cosine_topk", "lsh_topk")


def throughput(spark, sf_dir: str) -> dict[str, float]:
    """Queries per second of one batch job in which every vector, or 2,000 documents, is a query."""
    vectors = written(catalog.vectors(spark, sf_dir))
    asked = vectors.withColumnRenamed("doc_id", "qid")
    unit = written(vectors.select("doc_id", l2_normalize(F.col("vector")).alias("vector")))
    books = written(catalog.codebooks(spark, sf_dir))
    codes = written(pq.encode(vectors, books))
    tokens = written(catalog.tokens(spark, sf_dir))
    corpus = written(lsh_features(tokens))
    text_queries = written(as_queries(rows_of(corpus, query_sample(tokens, 2_000))))
    words = corpus.select("doc_id", "words")
    # the size of the published figures: all documents as vectors of 200 numbers, 2,000 of them as queries
    latent = written(QUERIES["lsi_embed"](spark, sf_dir).withColumnRenamed("embedding", "vector"))
    latent_unit = written(latent.select("doc_id", l2_normalize(F.col("vector")).alias("vector")))
    drawn = query_sample(latent, 2_000)
    latent_asked = written(rows_of(latent, drawn).withColumnRenamed("doc_id", "qid"))
    unit_asked = written(rows_of(latent_unit, drawn).withColumnRenamed("doc_id", "qid"))
    latent_books = written(pq.train_codebooks(latent))
    latent_codes = written(pq.encode(latent, latent_books))
    jobs = {
        "flat_200": (latent_asked.count(), lambda: search.inner_product_topk(latent_unit, unit_asked)),
        "pq_200": (latent_asked.count(), lambda: pq.pq_topk(latent_codes, latent_books, latent_asked)),
        "flat": (vectors.count(), lambda: search.inner_product_topk(unit, unit.withColumnRenamed("doc_id", "qid"))),
        "pq": (vectors.count(), lambda: pq.pq_topk(codes, books, asked)),
        "lsh_candidates": (text_queries.count(), lambda: lsh.lsh_candidates(corpus, text_queries)),
        "lsh_reranked": (text_queries.count(), lambda: lsh.lsh_topk(corpus, text_queries)),
        "jaccard_exact": (text_queries.count(), lambda: search.jaccard_topk(
            words, text_queries.select("qid", F.col("q_words").alias("words")))),
    }
    rates = {}
    for name, (n, job) in jobs.items():
        start = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        rates[name] = round(n / (time.perf_counter() - start), 1)
        print(f"{name:24} {rates[name]:8.1f} queries/s", file=sys.stderr, flush=True)
    return rates


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    for name in WARM_UP:  # starts the workers and lets the JVM compile its hot paths; not counted
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, methods = {}, []
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name:24} {times[name]:8.2f}s", file=sys.stderr, flush=True)
        if name == "pipeline_metrics":
            methods = [row.asDict() for row in df.collect()]
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "queries_per_second": {} if sys.argv[1:] else throughput(spark, sf_dir),
        "pipeline_methods": methods,
    }))


if __name__ == "__main__":
    main()
