"""Documents to tokens, words, signatures and keys in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearkin.functions import text as T
from nearkin.functions.banding import best_bands
from nearkin.operators.lsh import minhash_signatures, with_keys


def tokens_of(documents: DataFrame, text_col: str = "text", stop_words=T.ENGLISH_STOP_WORDS) -> DataFrame:
    """(doc_id, tokens)"""
    return documents.select("doc_id", T.tokenize(F.col(text_col), stop_words).alias("tokens"))


def words_of(tokens: DataFrame) -> DataFrame:
    """(doc_id, words): the token sets."""
    return tokens.select("doc_id", T.token_set(F.col("tokens")).alias("words"))


def lsh_features(
    tokens: DataFrame, num_perm: int = 128, threshold: float = 0.8, shingle_n: int = 5, basis: str = "token"
) -> DataFrame:
    """(doc_id, words, keys). `basis` picks what answers are re-ranked on: token or shingle sets."""
    if basis not in ("token", "shingle"):
        raise ValueError(f"unknown basis {basis!r}: token or shingle")
    bands, rows = best_bands(threshold, num_perm)
    signed = with_keys(minhash_signatures(tokens, num_perm, shingle_n), bands, rows)
    members = F.col("tokens") if basis == "token" else T.shingles(F.col("tokens"), shingle_n)
    return signed.select("doc_id", T.token_set(members).alias("words"), "keys")
