"""Quality rules as a short-circuit cascade of column expressions.

Each rule is a boolean column that is true where a document is rejected. On a sample every rule is run alone: its time
is its cost, the share it rejects its selectivity. The rules then stand in one CASE in the order of rejection per cost,
so that a document is tested until the first rule rejects it and no further. The order changes the time and the rule
that is named, never which documents are rejected.

Everything is built-in functions: no Python runs on the executors. Null texts count as texts without words, rows that
repeat are judged alike, a rule that gives null does not reject, and an empty table gives no rows.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with more columns, each computed once per row however often it is used later.

    A plain projection is merged into whatever reads it, and its expressions are repeated in filters; a generator of
    one row is not. A column of the same name is replaced.
    """
    new = {name.lower() for name in columns}
    old = [F.col(f"`{c}`") for c in df.columns if c.lower() not in new]
    return df.select(*old, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores put before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(NO_SPACE))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of every three words in a row; null below three words."""
    n = F.size(words)
    return F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))


def repeated_starts(hashes: Column) -> Column:
    """Places of the windows that occur twice or more; null where all differ, found without sorting."""
    placed = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    twice = let(placed, lambda p: F.filter(
        p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.transform(twice, lambda x: x["i"]))


def covered_words(starts: Column) -> Column:
    """How many words the windows of three words at these places cover."""
    later = F.array_union(F.transform(starts, lambda i: i + 1), F.transform(starts, lambda i: i + 2))
    return F.coalesce(F.size(F.array_union(starts, later)), F.lit(0))


def text_counts(text: Column, words: Column) -> dict[str, Column]:
    """The counts STATS as expressions of a text and its words.

    n_words; word_chars: code points in words; n_symbols; n_dup_lines; n_repeat_words: words in windows of three words
    that the text holds twice or more, windows compared by a 64-bit hash.
    """
    repeats = let(window_hashes(words), lambda h: let(repeated_starts(h), covered_words))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": dup_lines(text),
        "n_repeat_words": repeats,
    }


def text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with the counts STATS of each text as long columns, in place of columns of these names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, hashes, starts = (unused(df, x) for x in ("_words", "_hashes", "_starts"))
    df = once(df, **{words: words_of(text)})
    df = once(df, **{hashes: window_hashes(F.col(words))})
    df = once(df, **{starts: repeated_starts(F.col(hashes))})
    counts = text_counts(text, F.col(words)) | {"n_repeat_words": covered_words(F.col(starts))}
    return once(df, **{name: c.cast("bigint") for name, c in counts.items()}).drop(words, hashes, starts)


def base_rules(counts: Mapping[str, Column]) -> dict[str, Column]:
    return {
        "few_words": counts["n_words"] < 50,
        "repetition": 100 * counts["n_repeat_words"] > 50 * counts["n_words"],
    }


def more_rules(counts: Mapping[str, Column], text: Column) -> dict[str, Column]:
    """Symbols, capitals, odd word lengths and repeated lines, at limits that prose stays far from."""
    capitals = F.regexp_count(text, F.lit(r"\p{Lu}"))
    lines = F.size(F.split(text, "\n"))
    return {
        "symbols": counts["n_symbols"] * 10 > counts["n_words"],
        "capitals": capitals * 10 > counts["word_chars"] * 4,
        "short_words": counts["word_chars"] < counts["n_words"] * 2,
        "long_words": counts["word_chars"] > counts["n_words"] * 15,
        "dup_lines": (counts["n_dup_lines"] >= 4) & (counts["n_dup_lines"] * 2 > lines),
    }


def sample_rows(df: DataFrame, text_col: str, rows: int = 200, max_chars: int = 20_000) -> DataFrame:
    """At most `rows` rows whose texts have at most max_chars characters, as a table of their own.

    Only an order is estimated on them. They are taken from one in eight rows by the hash of the text, and reading
    ends as soon as there are enough.
    """
    some = df.where((F.pmod(F.xxhash64(text_col), F.lit(8)) == 0) & (F.length(text_col) <= max_chars)).limit(rows)
    return df.sparkSession.createDataFrame(some.collect(), df.schema)


def rule_order(sample: DataFrame, rules: Mapping[str, Column], copies: int = 20, repeats: int = 3) -> list[str]:
    """Rule names by rejected share per second, best first; ties keep the given order.

    The sample is read `copies` times over by each measurement, the least of `repeats` measurements counts, and that of a
    measurement without a rule is taken off. Times count as powers of two of a twentieth of the latter, the least that can be
    told from noise, so that the order does not change from run to run. An empty sample keeps the given order.
    """
    many = sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))

    def measured(rule: Column) -> tuple[float, float]:
        times = []
        for _ in range(repeats):
            began = time.perf_counter()
            share = many.agg(F.avg(F.coalesce(rule, F.lit(False)).cast("int"))).first()[0]
            times.append(time.perf_counter() - began)
        return min(times), share or 0.0

    nothing = F.col("_copy") < 0
    measured(nothing)
    overhead, _ = measured(nothing)
    return sorted(rules, key=worth_of({name: measured(rule) for name, rule in rules.items()}, overhead))


def worth_of(measures: Mapping[str, tuple[float, float]], overhead: float) -> Callable[[str], float]:
    """The sort key of rules with these (seconds, share): less is better."""
    unit = overhead / 20

    def key(name: str) -> float:
        seconds, share = measures[name]
        return -share / 2.0 ** round(math.log2(max((seconds - overhead) / unit, 1.0)))

    return key


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """The name of the first rule in this order that rejects, or null; later rules are not evaluated."""
    verdict = F
    for name in order:
        verdict = verdict.when(F.coalesce(rules[name], F.lit(False)), F.lit(name))
    return verdict


def quality_filter(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects. A text is cut into words once; each rule then does its own work, if it comes to it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, rule = unused(df, "_words"), unused(df, "_rule")
    counts = text_counts(text, F.col(words))
    rules = base_rules(counts) | more_rules(counts, text)
    order = rule_order(once(sample_rows(df.select(text_col), text_col), **{words: words_of(text)}), rules)
    judged = once(once(df, **{words: words_of(text)}), **{rule: cascade(rules, order)})
    return judged.where(F.col(rule).isNull()).drop(words, rule)
