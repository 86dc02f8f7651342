import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_helpers import frame, odd_rows
from nearkin.llm import mixing


def table(spark):
    rows = [(i, s, 10 + i % 7) for i, s in enumerate(["big"] * 900 + ["mid"] * 200 + ["small"] * 40 + [None] * 10)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n bigint").repartition(4), rows


def exponent_for(shares, above):
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if above(mid) else (low, mid)
    return low


def test_repetition_limit_takes_everything_once(spark):
    df, rows = table(spark)
    mix = mixing.temperature_mix(df, "source", F.col("n"), repetition_limit=2.0, block_tokens=300)
    totals = defaultdict(int)
    for _, s, n in rows:
        totals[s] += n
    shares = [t / sum(totals.values()) for t in totals.values()]
    a = exponent_for(shares, lambda x: (max(shares) / min(shares)) ** (1 - x) > 2)
    assert mix.exponent == pytest.approx(a, abs=1e-6)
    found = mix.rows.collect()
    assert {r.doc_id for r in found} == {r[0] for r in rows}
    spent = defaultdict(int)
    for r in found:
        spent[r.source] += r.n
    norm = sum(s ** a for s in shares)
    for s, t in totals.items():
        goal = (t / sum(totals.values())) ** a / norm * mix.budget
        assert goal - 17 <= spent[s] <= goal + 1e-3
    copies = Counter((r.doc_id, r.mix_epoch) for r in found)
    assert set(copies.values()) == {1}


def test_entropy_target_and_budget(spark):
    df, rows = table(spark)
    mix = mixing.temperature_mix(df, "source", F.col("n"), entropy=1.0, budget=5000, block_tokens=100)
    weights = [r.weight for r in mix.weights.collect()]
    assert sum(weights) == pytest.approx(1) and -sum(w * math.log(w) for w in weights) == pytest.approx(1.0, abs=1e-5)
    assert 5000 - 4 * 17 <= sum(r.n for r in mix.rows.collect()) <= 5000
    blocks = {(r.source, r.mix_epoch, r.mix_block) for r in mix.rows.collect()}
    assert len(blocks) > 20
    flat = mixing.temperature_mix(df, "source", F.col("n"), entropy=9.0)  # more than there can be
    assert flat.exponent == pytest.approx(0, abs=1e-6)


def test_odd_rows_and_empty_table(spark):
    df = frame(spark, odd_rows()).withColumn("mix_epoch", F.lit("mine"))
    tokens = F.length("text")
    mix = mixing.temperature_mix(df, "source", tokens, repetition_limit=1.5)
    assert mix.rows.columns == [*df.columns, "_mix_epoch", "mix_block"]
    assert Counter(tuple(r[: len(df.columns)]) for r in mix.rows.collect()).keys() == {tuple(r) for r in df.collect()}
    for empty in (df.where("false"), df.where("text = ''")):
        assert mixing.temperature_mix(empty, "source", tokens, entropy=0.5).rows.count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_no_document_is_lost_to_rounding(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a"] * 30 + ["b"] * 9 + ["c"] * 3), rng.choice([0, 7, 11, 250])) for i in range(600)]
    rows += [(1000 + i, s, 0) for i, s in enumerate(["d", "d", "a", "b", "c"] * 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n bigint").repartition(4)
    for goal in ({"repetition_limit": 2.0}, {"repetition_limit": 1.5}, {"entropy": 0.9}):
        mix = mixing.temperature_mix(df, "source", F.col("n"), block_tokens=300, seed=seed, **goal)
        assert {r.doc_id for r in mix.rows.where("mix_epoch = 0").collect()} == {r[0] for r in rows}
        weights = mix.weights.collect()
        assert all(r.budget >= r.tokens and r.budget <= max(r.tokens, r.weight * mix.budget + 1e-3) for r in weights)
        assert mix.weights.schema["budget"].dataType.typeName() == "long"


def test_sources_without_tokens(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", None)], "doc_id bigint, source string, n bigint")
    assert {r.doc_id for r in mixing.temperature_mix(df, "source", F.col("n"), repetition_limit=2.0).rows.collect()} == {1, 2}
    assert mixing.temperature_mix(df, "source", F.col("n"), repetition_limit=2.0, budget=9).rows.count() == 0
