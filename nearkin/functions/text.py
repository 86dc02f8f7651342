"""Cleaning, tokenizing and shingling, all as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual English stop words, as far as they can survive the cleaning below
# (longer than one character, no apostrophe).
ENGLISH_STOP_WORDS: tuple[str, ...] = tuple(
    """
    me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very can will just don should now
    ll re ve ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn
    wasn weren won wouldn
    """.split()
)


def cleaned(text: Column) -> Column:
    """Lower-cased text in which every run of characters outside a-z and 0-9 is one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def tokenize(
    text: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS, min_length: int = 2
) -> Column:
    """Words of the cleaned text in order, without short words and stop words. NULL gives []."""
    stop = list(stop_words)

    def wanted(word: Column) -> Column:
        long_enough = F.length(word) >= min_length
        return long_enough & ~word.isin(stop) if stop else long_enough

    return F.filter(F.split(cleaned(text), " "), wanted)


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def token_set(tokens: Column) -> Column:
    return F.array_distinct(tokens)


def shingles(tokens: Column, n: int = 5) -> Column:
    """All runs of n words; a shorter document is one shingle, an empty one has none."""
    size = F.size(tokens)
    starts = F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1)))
    return (
        F.when(size == 0, F.array().cast("array<string>"))
        .when(size < n, F.array(F.array_join(tokens, " ")))
        .otherwise(F.transform(starts, lambda at: F.array_join(F.slice(tokens, at, n), " ")))
    )


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two duplicate-free arrays; 0 when both are empty."""
    shared = F.size(F.array_intersect(left, right))
    return F.coalesce(F.try_divide(shared.cast("double"), F.size(left) + F.size(right) - shared), F.lit(0.0))
