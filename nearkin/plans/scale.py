"""Size checks, scratch tables and joins that hold up when one key is hot."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 256 << 20
MAX_BROADCAST_ROWS = 4_000_000
HEAVY_ROWS = 1_000_000

BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_folder: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. A folder of our own only where driver and executors are one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="nearkin-")
    return _own_folder[app]


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the queries run meanwhile; then it is put back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_batches(spark: SparkSession):
    """Queries run meanwhile send rows to Python in batches of some megabytes (64 MB is Spark's bound), unless the session has a bound
    of its own. Wide rows fill a batch, and a task holds it twice or more: outside the executor's heap, where buffers double as they
    grow, and in the worker."""
    return setting(spark, BATCH_SIZE, spark.conf.get(BATCH_SIZE, None) or str(BATCH_BYTES))


def shuffles_freed(spark: SparkSession):
    """Shuffle files of the queries run meanwhile go when each of them ends, not when the driver next collects garbage."""
    return setting(spark, SHUFFLE_CLEANUP, "true")


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the scratch folder.

    Cuts the lineage, survives lost executors, and later readers still prune its columns.
    """
    path = f"{scratch_folder(df.sparkSession)}/nearkin-{uuid.uuid4().hex}"
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, id_col: str) -> DataFrame:
    """Spreads an input with fewer splits than task slots; a large input is left as it was read."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots, id_col) if df.rdd.getNumPartitions() < slots else df


def fits_broadcast(df: DataFrame, row_bytes: Column | int) -> bool:
    """Measures a written table: do its rows stay within the broadcast bound?"""
    size = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    rows, total = df.agg(F.count("*"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()
    return rows <= MAX_BROADCAST_ROWS and total <= MAX_BROADCAST_BYTES


def collect_bounded(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> pa.Table | None:
    """The rows on the driver, or None when there are more than the bounds allow.

    One task counts the bytes and stops passing rows on once there are too many, so the driver
    never receives more than the bound.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def pass_on(batches):
        total = 0
        for batch in batches:
            total += batch.nbytes
            over = total > max_bytes
            rows = batch.slice(0, 1) if over else batch
            flag = pa.array([over] * rows.num_rows, pa.bool_())
            yield pa.RecordBatch.from_arrays(rows.columns + [flag], names=rows.schema.names + ["_over"])
            if over:
                return

    table = df.limit(max_rows + 1).mapInArrow(pass_on, f"{schema}, _over boolean").toArrow()
    if table.num_rows > max_rows or pc.any(table.column("_over")).as_py():
        return None
    return table.drop_columns("_over")


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], salt_from: str) -> DataFrame:
    """Inner join in which a key with very many rows on the left is spread over as many tasks as it needs.

    Keys are counted first. One with more than HEAVY_ROWS rows is cut into slices by the column `salt_from`, and the right
    rows of this key alone are sent to all of its slices; other keys are joined as they are.
    """
    heavy = left.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > HEAVY_ROWS)
    heavy = written(heavy.select(*keys, F.ceil(F.col("_n") / HEAVY_ROWS).cast("int").alias("_slices")))
    if heavy.isEmpty():
        return left.join(right, keys)
    named = F.broadcast(heavy) if fits_broadcast(heavy, 16 * len(keys) + 16) else heavy
    slices = F.coalesce("_slices", F.lit(1))
    sliced = left.join(named, keys, "left").withColumn("_slice", F.pmod(F.xxhash64(salt_from), slices).cast("int")).drop("_slices")
    copied = right.join(named, keys, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("_slices")
    return sliced.join(copied, [*keys, "_slice"]).drop("_slice")


def checked_join(
    large: DataFrame, small: DataFrame, keys: list[str], row_bytes: Column | int, salt_from: str, skewed: str = "large"
) -> DataFrame:
    """Inner join that broadcasts `small` when its measured size allows, and spreads heavy keys if not.

    `small` should be a written table, since it is read once for the measurement. `skewed` says which side can have
    many rows of one key; `salt_from` is a column of that side.
    """
    if fits_broadcast(small, row_bytes):
        return large.join(F.broadcast(small), keys)
    return skew_join(large, small, keys, salt_from) if skewed == "large" else skew_join(small, large, keys, salt_from)
