"""Random order of a table in two passes: scatter into buckets that fit in memory, then shuffle each bucket.

Pass one deals every row by a seeded hash to one of so many buckets that each holds about bucket_bytes. Pass two
gathers a bucket as an array, which Spark's shuffle() permutes by Fisher-Yates with a seed, and writes it. The written
places, behind the sizes of the earlier buckets, are a random order of all rows, dealt out to the shards in turn.
Only built-in functions are used.

Null texts have no bytes; rows that repeat are rows of their own; an empty table gives no rows. Columns keep their names,
those added get underscores in front where a name is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.llm.quality import unused
from nearkin.plans.scale import written

MAX_BROADCAST_BUCKETS = 1_000_000


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def shuffled_shards(
    df: DataFrame, size: Column, shards: int = 8, seed: int = 17, bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """The rows with `shard` and `slot`, gapless from 0 in each shard; shards differ by one row at most.

    The hash takes in all columns of simple type and the row's place in its input split, so that neither repeated ids nor
    repeated rows fill one bucket. A task that runs again reads the same split, so rows keep their bucket as long as df
    reads files. Shards are final only with the written buckets, whose sizes are counted as written.
    """
    bucket, order, rows, place, start = (unused(df, n) for n in ("_bucket", "_order", "_rows", "_place", "_start"))
    shard, slot = unused(df, "shard"), unused(df, "slot")
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    buckets = max(1, -(-int(total) // bucket_bytes))
    simple = [F.col(f"`{n}`") for n, kind in df.dtypes if kind.split("(")[0] in ("bigint", "int", "string", "double", "date")]
    mark = F.xxhash64(F.lit(seed), *simple, F.monotonically_increasing_id())
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-buckets // 2))
    scattered = (
        df.withColumn(order, mark).withColumn(bucket, F.pmod(order, F.lit(buckets)))
        .repartition(parts, bucket).sortWithinPartitions(bucket, order)
    )
    gathered = scattered.groupBy(bucket).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(rows))
    dealt = gathered.select(bucket, F.posexplode(F.shuffle(rows, F.lit(seed))).alias(place, rows))
    stored = written(dealt.select(bucket, place, F.col(f"{rows}.*")))
    counts = stored.groupBy(bucket).agg(F.count("*").alias(rows))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(bucket, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(start))  # one row per bucket
    if buckets <= MAX_BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    number = F.col(start) + F.col(place)
    return stored.join(starts, bucket).select(
        *[F.col(f"`{c}`") for c in df.columns],
        (number % shards).cast("int").alias(shard), F.floor(number / shards).cast("bigint").alias(slot))


def write_shards(sharded: DataFrame, folder: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder of Parquet files per shard, each file a stretch of its shard in slot order."""
    sharded.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)
