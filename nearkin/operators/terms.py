"""Term counts, vocabulary and TF-IDF as long tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearkin.functions import kernels
from nearkin.plans.scale import fits_broadcast


def _counted(batch: pa.RecordBatch, value_set: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, term number and count of the distinct terms of each row's token list, and the terms by number."""
    tokens = batch.column("tokens")
    flat = tokens.flatten()
    row = np.repeat(np.arange(len(tokens)), np.asarray(pc.fill_null(pc.list_value_length(tokens), 0)))
    if value_set is None:
        coded = flat.dictionary_encode()
        at, value_set = coded.indices, coded.dictionary
    else:
        at = pc.index_in(flat, value_set=value_set)
    there = np.asarray(at.is_valid())
    key, count = np.unique(row[there] * max(len(value_set), 1) + at.drop_null().to_numpy(), return_counts=True)
    row, term = np.divmod(key, max(len(value_set), 1))
    return row, term, count, value_set


def term_counts(tokens: DataFrame) -> DataFrame:
    """(doc_id, tokens) -> (doc_id, term, tf). A document is one row, so its terms are counted where it lies."""
    def count(batches):
        for batch in batches:
            for part in kernels.pieces(batch, "tokens"):
                row, term, tf, terms = _counted(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), terms.take(pa.array(term)), pa.array(tf, pa.int64())],
                    names=["doc_id", "term", "tf"])

    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.select("doc_id", "tokens").mapInArrow(count, f"doc_id {kind}, term string, tf bigint")


def vocabulary(counts: DataFrame, max_features: int = 50_000) -> DataFrame:
    """(term, total, df) of the most frequent terms of the corpus; equal totals by term."""
    return (
        counts.groupBy("term")
        .agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
    )


def _idf(n_docs: int):
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0


def _numbered(vocab: DataFrame, n_docs: int) -> pa.Table:
    """(term, idf) in the order of terms; the vocabulary was measured before."""
    return vocab.orderBy("term").select("term", _idf(n_docs).alias("idf")).toArrow().combine_chunks()


def _weights(tokens: DataFrame, listed: pa.Table, make, schema: str) -> DataFrame:
    """make(doc_ids, row, term number, weight, terms) on each batch; weights are scaled to length 1 per document."""
    shared = tokens.sparkSession.sparkContext.broadcast(listed)

    def weigh(batches):
        terms, idf = shared.value.column("term").combine_chunks(), shared.value.column("idf").to_numpy()
        terms = terms.chunk(0) if isinstance(terms, pa.ChunkedArray) and terms.num_chunks else terms
        for batch in batches:
            if not len(idf):
                return
            for part in kernels.pieces(batch, "tokens"):
                row, term, tf, _ = _counted(part, terms)
                weight = tf * idf[term]
                length = np.sqrt(np.bincount(row, weights=weight * weight, minlength=part.num_rows))
                yield make(part.column("doc_id"), row, term, weight / length[row], terms)

    return tokens.select("doc_id", "tokens").mapInArrow(weigh, schema)


def _joined_weights(tokens: DataFrame, vocab: DataFrame, n_docs: int) -> DataFrame:
    """The same weights for a vocabulary that does not fit a task, by a join on the term."""
    weighted = term_counts(tokens).join(vocab.select("term", _idf(n_docs).alias("idf")), "term")
    weighted = weighted.select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return weighted.select("doc_id", "term", (F.col("w") / length).alias("tfidf"))


def tfidf(tokens: DataFrame, vocab: DataFrame, n_docs: int) -> DataFrame:
    """(doc_id, tokens) -> (doc_id, term, tfidf): tf * (ln((1+n)/(1+df)) + 1), scaled to length 1 per document.

    A vocabulary of measured size goes to every task and documents stay where they are.
    """
    if not fits_broadcast(vocab, F.octet_length("term") + 16):
        return _joined_weights(tokens, vocab, n_docs)

    def rows(doc_ids, row, term, weight, terms):
        return pa.RecordBatch.from_arrays(
            [doc_ids.take(pa.array(row)), terms.take(pa.array(term)), pa.array(weight)], names=["doc_id", "term", "tfidf"])

    kind = dict(tokens.dtypes)["doc_id"]
    return _weights(tokens, _numbered(vocab, n_docs), rows, f"doc_id {kind}, term string, tfidf double")


def tfidf_rows(tokens: DataFrame, vocab: DataFrame, n_docs: int) -> tuple[DataFrame, list[str]]:
    """The same weights as one sparse row (doc_id, idx, val) per document with known terms, and the terms by number."""
    if not fits_broadcast(vocab, F.octet_length("term") + 16):
        raise ValueError("sparse rows number their terms on the driver; cut the vocabulary further")
    listed = _numbered(vocab, n_docs)

    def rows(doc_ids, row, term, weight, terms):
        own, first = np.unique(row, return_index=True)
        bound = pa.array(np.append(first, len(row)), pa.int32())
        return pa.RecordBatch.from_arrays([
            doc_ids.take(pa.array(own)), pa.ListArray.from_arrays(bound, pa.array(term, pa.int32())),
            pa.ListArray.from_arrays(bound, pa.array(weight))], names=["doc_id", "idx", "val"])

    kind = dict(tokens.dtypes)["doc_id"]
    schema = f"doc_id {kind}, idx array<int>, val array<double>"
    return _weights(tokens, listed, rows, schema), listed.column("term").to_pylist()
