from collections import Counter

from pyspark.sql import functions as F

from llm_helpers import frame, odd_rows
from nearkin.llm import sharding
from nearkin.plans.scale import written


def test_every_row_once_and_shards_even(spark):
    rows = odd_rows()
    df = written(frame(spark, rows))
    out = sharding.shuffled_shards(df, sharding.size_of(F.col("text")), shards=4, bucket_bytes=1 << 12)
    assert out.columns == [*df.columns, "_shard", "slot"]  # the table has a column shard
    found = out.collect()
    assert Counter(tuple(r[: len(df.columns)]) for r in found) == Counter(tuple(r) for r in df.collect())
    slots = {s: sorted(r.slot for r in found if r["_shard"] == s) for s in range(4)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_same_seed_same_order_other_seed_another(spark, tmp_path):
    spark.range(0, 3000, 1, 4).selectExpr("id", "repeat('x', 50) AS text").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))

    def order(seed):
        out = sharding.shuffled_shards(df, sharding.size_of(F.col("text")), shards=3, seed=seed, bucket_bytes=20_000)
        return [r.id for r in out.orderBy("shard", "slot").collect()]

    first = order(1)
    assert first == order(1) and first != order(2) and first != sorted(first)
    out = sharding.shuffled_shards(df, sharding.size_of(F.col("text")), shards=3)
    sharding.write_shards(out, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 3000 and back.select("shard").distinct().count() == 3


def test_repeated_rows_spread_and_empty_table(spark):
    df = written(spark.range(0, 900, 1, 3).selectExpr("1L AS doc_id", "'same' AS text"))
    out = sharding.shuffled_shards(df, sharding.size_of(F.col("text")), shards=8)
    assert {r["count"] for r in out.groupBy("shard").count().collect()} <= {112, 113}
    assert sharding.shuffled_shards(df.where("false"), F.lit(1)).count() == 0
