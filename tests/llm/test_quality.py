from collections import Counter

from pyspark.sql import functions as F

from nearkin.llm import quality
from llm_helpers import frame, odd_rows, words


def counts(text):
    text = text or ""
    w = words(text)
    places = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    repeated = {i + j for i in range(len(w) - 2) if places[tuple(w[i: i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))


def test_counts_follow_the_definition(spark):
    rows = odd_rows()
    found = quality.text_stats(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[c] for c in quality.STATS) == counts(r.text)


def test_cascade_rejects_the_same_in_any_order(spark):
    df = quality.text_stats(frame(spark, odd_rows()).select("doc_id", "text"))
    c = {name: F.col(name) for name in quality.STATS}
    rules = quality.base_rules(c) | quality.more_rules(c, F.col("text"))
    names = list(rules)
    kept = [
        sorted(r.doc_id or -1 for r in df.where(quality.cascade(rules, order).isNull()).collect())
        for order in (names, names[::-1])
    ]
    assert kept[0] == kept[1]


def test_order_is_by_rejection_per_cost(spark):
    df = spark.range(200).select(F.col("id"), F.lit("a b").alias("text"))
    rules = {"never": F.col("id") < 0, "half": F.col("id") % 2 == 0, "all": F.col("id") >= 0}
    order = quality.rule_order(df, rules)
    assert order[-1] == "never"


def test_filter_keeps_columns_and_empty_tables(spark):
    df = frame(spark, odd_rows())
    kept = quality.quality_filter(df)
    assert kept.columns == df.columns
    fine = [r.text for r in kept.collect()]
    for text in fine:
        n, _, _, _, repeated = counts(text)
        assert n >= 50 and 2 * repeated <= n
    assert quality.quality_filter(df.where("false")).count() == 0


def test_order_by_rejection_per_cost_is_not_moved_by_noise():
    """Costs that differ by less than noise count as equal; the given order decides between equal rules."""
    for jitter in (0.0, 0.001, -0.001):
        measures = {"dear": (0.9 + jitter, 0.5), "cheap": (0.101 + jitter, 0.2), "cheap too": (0.1 - jitter, 0.2), "never": (0.1, 0.0), "strong": (0.102, 0.4)}
        assert sorted(measures, key=quality.worth_of(measures, 0.1)) == ["strong", "cheap", "cheap too", "dear", "never"]
