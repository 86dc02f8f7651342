"""MinHash signatures, band buckets, candidates and their statistics."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.functions.banding import band_keys, band_texts
from nearkin.functions.text import jaccard
from nearkin.operators.ranking import rank_topk
from nearkin.operators.search import NEIGHBORS, as_arrow, keep_best, whole
from nearkin.plans.scale import MAX_BROADCAST_BYTES, checked_join, collect_bounded, skew_join, written

HEAVY_BUCKET = 256
SET_BLOCK = 4_096
MAX_HOT_BANDS = 12
MAX_BAND_QUERIES = 65_536
PAIRS_AT_ONCE = 4_000_000


def minhash_signatures(corpus: DataFrame, num_perm: int = 128, shingle_n: int = 5, seed: int = 1) -> DataFrame:
    """Adds `signature`, the `num_perm` minima over the hashed shingles of `tokens`.

    Row by row, so nothing is shuffled; also fit for a stream. A document without tokens gets
    the largest value everywhere.
    """
    a, b = (np.array(part, np.uint64) for part in kernels.minhash_constants(num_perm, seed))
    at = corpus.columns.index("tokens")

    def sign(batches):
        for batch in batches:
            for part in kernels.pieces(batch, at):
                tokens = part.column(at)
                lengths = np.diff(np.asarray(tokens.offsets)).astype(np.int64)
                numbers, row = kernels.shingle_numbers(kernels.word_numbers(tokens.flatten()), lengths, shingle_n)
                signature = kernels.minhash(numbers, row, part.num_rows, a, b)
                yield pa.RecordBatch.from_arrays(
                    part.columns + [kernels.list_column(signature, pa.int32())],
                    names=part.schema.names + ["signature"],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in corpus.schema.fields)
    return corpus.mapInArrow(sign, f"{schema}, signature array<int>")


def with_keys(signatures: DataFrame, bands: int, rows: int) -> DataFrame:
    """Adds `keys`, one bucket key per band."""
    return signatures.withColumn("keys", band_keys(F.col("signature"), bands, rows))


def band_table(signatures: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, band, bucket): the index as a table, with the buckets spelled out."""
    texts = band_texts(F.col("signature"), bands, rows)
    return signatures.select("doc_id", F.posexplode(texts).alias("band", "bucket"))


def _first_shared_band(left: str, right: str):
    """Position of the first band in which two key arrays agree."""
    equal = F.zip_with(left, right, lambda x, y: x == y)
    return F.array_position(equal, F.lit(True)) - 1


def candidates(keyed: DataFrame, queries: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Pairs that share a bucket, each once: qid and the columns of `keyed`.

    `keyed` has doc_id and keys, `queries` has qid and q_keys; pairs must also agree on the
    columns `within`. Other columns of `keyed` ride along; `queries` is a written table. A pair is kept at its first shared
    band only, which makes a distinct over the pairs needless.
    """
    probes = queries.select("qid", "q_keys", *within, F.posexplode("q_keys").alias("band", "key"))
    # the outer form: keys are never empty, and Spark would compute them twice to test that
    buckets = keyed.select("*", F.posexplode_outer("keys").alias("band", "key"))
    # every probe row repeats the keys of its query
    met = checked_join(buckets, probes, [*within, "band", "key"], F.size("q_keys") * 8 + 64, "doc_id")
    return met.filter(F.col("band") == _first_shared_band("keys", "q_keys")).drop("band", "key", "keys", "q_keys")


def bounded_queries(queries: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> pa.Table | None:
    """The query set on its way to all tasks, or None if it is too large for that."""
    table = collect_bounded(queries, MAX_BAND_QUERIES, max_bytes)
    return None if table is None else table.combine_chunks()


def pairs_in_place(keyed: DataFrame, table: pa.Table) -> DataFrame:
    """(qid, doc_id) of all documents in a bucket of a query (qid, q_keys). Rows stay where they are: a task looks its
    rows' keys up in the sorted keys of the queries, so a hot bucket gives its pairs and nothing else."""
    shared = keyed.sparkSession.sparkContext.broadcast(table)

    def look_up(batches):
        asked = shared.value
        if not asked.num_rows:
            return
        qids, index = asked.column("qid").to_numpy(), kernels.BandIndex(kernels.matrix(asked.column("q_keys"), np.int64))
        step = max(1, PAIRS_AT_ONCE // len(qids))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                query, row = index.pairs(kernels.matrix(part.column(1), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(qids[query]), part.column(0).take(pa.array(row))], names=["qid", "doc_id"])

    return keyed.select("doc_id", "keys").mapInArrow(look_up, "qid bigint, doc_id bigint")


def lsh_candidates(keyed: DataFrame, queries: DataFrame) -> DataFrame:
    """(qid, doc_id) of all documents in a bucket of the query, the query itself included."""
    queries = queries.select("qid", "q_keys")
    table = bounded_queries(queries)
    if table is not None:
        return pairs_in_place(keyed, table)
    return candidates(keyed.select("doc_id", "keys"), written(queries)).select("qid", "doc_id")


def score_candidates(pairs: DataFrame, words: DataFrame, queries: DataFrame, exclude_self: bool = True) -> DataFrame:
    """Adds the Jaccard similarity of `words` (doc_id, words) and the query's `q_words` to candidate pairs.

    Words are fetched for the documents of a pair only. While candidates are looked for, nothing but keys is copied from
    band to band.
    """
    return score_pairs(written(pairs.filter("qid <> doc_id") if exclude_self else pairs), words, queries)


def score_pairs(pairs: DataFrame, words: DataFrame, queries: DataFrame) -> DataFrame:
    """The same for pairs that are a written table."""
    pairs = checked_join(words.select("doc_id", "words"), pairs, ["doc_id"], 32, "qid", skewed="small")
    asked = queries.select("qid", "q_words")
    row_bytes = F.length(F.array_join("q_words", " ")) + F.size("q_words") * 16 + 16
    met = checked_join(pairs, asked, ["qid"], row_bytes, "doc_id")
    return met.withColumn("score", jaccard(F.col("q_words"), F.col("words")))


def ranked_in_place(keyed: DataFrame, table: pa.Table, k: int, exclude_self: bool = True) -> DataFrame:
    """(qid, doc_id, score) of at most k candidates per query and task, for queries (qid, q_keys, q_words). Candidates are
    found and scored where they lie."""
    shared = keyed.sparkSession.sparkContext.broadcast(table)

    def rank(batches):
        asked = shared.value
        if not asked.num_rows:
            return
        qids, index = asked.column("qid").to_numpy(), kernels.BandIndex(kernels.matrix(asked.column("q_keys"), np.int64))
        scorer = kernels.PairJaccard(whole(asked.column("q_words")))
        step, best = max(1, PAIRS_AT_ONCE // len(qids)), None
        for batch in batches:
            for part in kernels.pieces(batch, 2, step):
                ids = part.column(0).to_numpy()
                query, row = index.pairs(kernels.matrix(part.column(1), np.int64))
                if exclude_self:
                    other = qids[query] != ids[row]
                    query, row = query[other], row[other]
                new = [qids[query], ids[row], scorer(query, row, part.column(2))]
                best = keep_best(new if best is None else best, [x[:0] for x in new] if best is None else new, k, None)
        if best is not None:
            yield as_arrow(best, pa.RecordBatch)

    return keyed.select("doc_id", "keys", "words").mapInArrow(rank, NEIGHBORS)


def lsh_topk(keyed: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = True) -> DataFrame:
    """Candidates re-ranked by Jaccard over `words`; may give fewer than k rows.

    Needs keys and words on the corpus, q_keys and q_words on the queries. A query set of measured size goes to all tasks;
    a larger one is joined on the buckets.
    """
    table = bounded_queries(queries.select("qid", "q_keys", "q_words"))
    if table is not None:
        return rank_topk(ranked_in_place(keyed, table, k, exclude_self), k)
    queries = written(queries.select("qid", "q_keys", "q_words"))
    pairs = candidates(keyed.select("doc_id", "keys"), queries.drop("q_words")).select("qid", "doc_id")
    return rank_topk(score_candidates(pairs, keyed, queries, exclude_self), k)


def _subset_weights(sets: DataFrame) -> DataFrame:
    """(hot, n_big): weight of all sets (hot, w) that agree with a set in a hot bucket, by inclusion and exclusion.

    A set gives a row for every choice of its hot bands. Sets that agree in all chosen bands are counted by the choice and its
    keys; with the sign of the choice's size these sums add up to the sets that agree in any. No two sets are compared.
    """
    places = F.filter(F.transform("hot", lambda key, band: F.when(key != 0, band)), lambda band: band.isNotNull())
    chosen = sets.select("hot", "w", places.alias("places")).withColumn(
        "choice", F.explode(F.expr("sequence(1L, shiftleft(1L, size(places)) - 1L)")))
    taken = F.expr("filter(transform(places, (band, at) -> IF(shiftright(choice, at) & 1L = 1L, struct(band, hot[band]), NULL)), x -> x IS NOT NULL)")
    chosen = written(chosen.withColumn("taken", taken).select(
        "hot", "w", F.xxhash64("taken").alias("key"), F.when(F.size("taken") % 2 == 1, 1).otherwise(-1).alias("sign")))
    together = chosen.groupBy("key").agg(F.sum("w").alias("n"))
    return skew_join(chosen.select("hot", "key", "sign"), together, ["key"], "hot").groupBy("hot").agg(F.sum(F.col("sign") * F.col("n")).alias("n_big"))


def _shared_weight(sets: DataFrame) -> DataFrame:
    """(hot, n_big): weight of all sets (hot, w) that agree with a set in a hot bucket.

    Blocks of sets meet in a cogroup and are compared there band by band; only sums come out.
    """
    blocks = max(1, math.ceil(sets.count() / SET_BLOCK))
    own = F.pmod(F.xxhash64("hot"), F.lit(blocks))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    left = sets.select("hot", own.alias("c"), every.alias("q"))
    right = sets.select("hot", "w", every.alias("c"), own.alias("q"))

    def compare(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        names = ["hot", "n"]
        if not ours.num_rows or not theirs.num_rows:
            return pa.table([pa.array([], pa.list_(pa.int64())), pa.array([], pa.int64())], names=names)
        a = kernels.matrix(ours.column("hot"), np.int64)
        b = kernels.matrix(theirs.column("hot"), np.int64)
        agree = np.zeros((len(a), len(b)), bool)
        for band in range(a.shape[1]):
            agree |= (a[:, band, None] == b[None, :, band]) & (a[:, band, None] != 0)
        weight = theirs.column("w").to_numpy()
        n = np.array([weight[row].sum() for row in agree], np.int64)
        return pa.table([kernels.list_column(a, pa.int64()), pa.array(n)], names=names)

    met = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(compare, "hot array<bigint>, n bigint")
    return met.groupBy("hot").agg(F.sum("n").alias("n_big"))


def candidate_counts(keyed: DataFrame, heavy: int = HEAVY_BUCKET) -> DataFrame:
    """(gid, weight, n_candidates): candidates of all documents at once, itself included.

    `weight` documents have the same keys in all bands and are folded into one row, so copies
    cost nothing. Buckets of more than `heavy` rows are never paired row by row: rows are folded
    again by the set of their hot buckets, and these sets are counted by inclusion and exclusion (or
    compared in blocks, where one has more than MAX_HOT_BANDS hot bands). Rows of small buckets are
    paired within them, leaving out what was counted before.
    """
    groups = keyed.groupBy("keys").agg(F.min("doc_id").alias("gid"), F.count("*").alias("weight"))
    groups = written(groups)
    places = F.transform("keys", lambda key, band: F.xxhash64(band, key))
    placed = groups.select("gid", "weight", places.alias("places"))
    rows = placed.select("gid", F.explode_outer("places").alias("at"))
    sizes = rows.groupBy("at").agg(F.count("*").alias("members")).filter("members > 1")
    shared = rows.join(sizes, "at")
    lists = shared.groupBy("gid").agg(
        F.sort_array(F.collect_list(F.when(F.col("members") > heavy, F.col("at")))).alias("big"),
        F.sort_array(F.collect_list(F.when(F.col("members") <= heavy, F.col("at")))).alias("small"),
    )
    hot = F.transform("places", lambda at: F.when(F.array_contains("big", at), at).otherwise(F.lit(0)))
    info = written(placed.join(lists, "gid").select("gid", "weight", "big", "small", hot.alias("hot")))

    sets = written(info.filter(F.size("big") > 0).groupBy("hot").agg(F.sum("weight").alias("w")))
    most = sets.agg(F.max(F.size(F.filter("hot", lambda key: key != 0)))).first()[0] or 0
    big_counts = _subset_weights(sets) if most <= MAX_HOT_BANDS else _shared_weight(sets)

    left = info.select("gid", "big", "small", F.explode("small").alias("at"))
    right = info.select(
        F.col("gid").alias("other"), F.col("weight").alias("w"),
        F.col("big").alias("o_big"), F.col("small").alias("o_small"), F.explode("small").alias("at"),
    )
    met = left.join(right, "at").filter(
        (F.col("gid") != F.col("other"))
        & ~F.arrays_overlap("big", "o_big")
        & (F.element_at(F.array_intersect("small", "o_small"), 1) == F.col("at"))
    )
    small_counts = met.groupBy("gid").agg(F.sum("w").alias("n_small"))

    return (
        groups.select("gid", "weight")
        .join(info.select("gid", "hot"), "gid", "left")
        .join(big_counts, "hot", "left")
        .join(small_counts, "gid", "left")
        .select(
            "gid", "weight",
            (F.coalesce("n_big", "weight") + F.coalesce("n_small", F.lit(0))).alias("n_candidates"),
        )
    )


def candidate_stats(counts: DataFrame) -> DataFrame:
    """One row: documents, mean, median, min, max, share with none, share with only themselves."""
    histogram = counts.groupBy("n_candidates").agg(F.sum("weight").alias("docs"))
    n, docs = F.col("n_candidates"), F.col("docs")
    total = F.sum("docs")
    return histogram.agg(
        total.alias("n_docs"),
        (F.sum(n * docs) / total).alias("mean_candidates"),
        F.percentile(n, 0.5, docs).alias("median_candidates"),
        F.min(n).alias("min_candidates"),
        F.max(n).alias("max_candidates"),
        (F.sum(F.when(n == 0, docs).otherwise(0)) / total).alias("share_none"),
        (F.sum(F.when(n == 1, docs).otherwise(0)) / total).alias("share_self_only"),
    )


def candidate_examples(keyed: DataFrame, show_first: int = 20, per_doc: int = 10) -> DataFrame:
    """The first documents with their smallest candidate ids."""
    first = keyed.select(F.col("doc_id").alias("qid"), F.col("keys").alias("q_keys"))
    first = first.orderBy("qid").limit(show_first)
    smallest = Window.partitionBy("qid").orderBy("doc_id")
    pairs = lsh_candidates(keyed, first).withColumn("at", F.row_number().over(smallest))
    return (
        pairs.filter(F.col("at") <= per_doc)
        .groupBy("qid")
        .agg(F.sort_array(F.collect_list("doc_id")).alias("candidates"))
        .withColumnRenamed("qid", "doc_id")
    )
