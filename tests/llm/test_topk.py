import math

import pytest
from pyspark.sql import functions as F

from nearkin.llm import topk


def brute_force(rows, asked, k):
    out = set()
    for q, a in asked:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in rows if v != q)[:k]
        out |= {(q, i + 1, v, -s) for i, (s, v) in enumerate(scored)}
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_like_brute_force_with_ties_and_repeats(spark, block):
    rows = [(i, [float((i * j) % 5 - 2) / 8 for j in range(6)]) for i in range(80)] + [(3, [0.0] * 6), (200, [1.0]), (201, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    coded = df.select("vec_id", topk.integer_codes(F.col("embedding")).alias("codes"), F.lit(1).alias("rank"))
    found = topk.topk(coded, coded.where("vec_id % 10 = 0"), "vec_id", "codes", k=7, block_queries=block)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    plain = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    assert {tuple(r) for r in found.collect()} == brute_force(plain, [(i, v) for i, v in plain if i % 10 == 0], 7)


def test_unsound_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 0.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (5, None), (6, [-0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    coded = df.select("vec_id", topk.integer_codes(F.col("embedding")).alias("codes"))
    assert [tuple(r) for r in topk.topk(coded, coded, "vec_id", "codes").orderBy("query_id").collect()] == [(0, 1, 6, 0), (6, 1, 0, 0)]
    assert topk.topk(coded, coded.where("false"), "vec_id", "codes").count() == 0
    assert topk.topk(coded.where("false"), coded, "vec_id", "codes").count() == 0


def test_large_components_take_part(spark):
    rows = [(0, [2e5, -2e5, 3.0]), (2, [1.0, -1.0, 3.0]), (3, [-131072.0, 131072.0, 0.0]),
            (4, [2.0 ** 45, 2.0 ** 45, 0.5]), (5, [-1.5, 1.5, 7.0])]  # lengths of 4 and 0 multiply to more than 2**63
    plain = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    expected = brute_force(plain, plain, 4)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(2)
    coded = df.select("vec_id", topk.integer_codes(F.col("embedding")).alias("codes"))
    assert {tuple(r) for r in topk.topk(coded, coded, "vec_id", "codes", k=4).collect()} == expected


def test_a_score_beyond_a_long_is_an_error(spark):
    df = spark.createDataFrame([(0, [2.0 ** 30]), (1, [2.0 ** 23])], "vec_id bigint, embedding array<double>")
    coded = df.select("vec_id", topk.integer_codes(F.col("embedding")).alias("codes"))
    with pytest.raises(Exception, match="do not fit a long"):
        topk.topk(coded, coded, "vec_id", "codes").collect()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_a_component_beyond_a_code_is_an_error(spark, kind):
    df = spark.createDataFrame([(0, [1e30, 0.0]), (1, [1.0, 0.0])], f"vec_id bigint, embedding array<{kind}>")
    coded = df.select("vec_id", topk.integer_codes(F.col("embedding")).alias("codes"))
    with pytest.raises(Exception, match="too large for an integer code"):
        topk.topk(coded, coded, "vec_id", "codes").collect()


def test_blocks_of_few_bytes(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 40)
    rows = [(i, [float(i % 7), 1.0 / (i + 1)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    coded = df.select("vec_id", topk.integer_codes(F.col("embedding")).alias("codes"))
    plain = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    assert {tuple(r) for r in topk.topk(coded, coded, "vec_id", "codes", k=3).collect()} == brute_force(plain, plain, 3)
