"""Text tables from CSV or Parquet, and tokenized corpora."""

from __future__ import annotations

import csv
import functools
from concurrent.futures import ThreadPoolExecutor
from io import TextIOWrapper

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.plans.scale import small_batches

# The strings a CSV reader of the Python data world takes as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

HEAD_BYTES = 1 << 16
PATHS_AT_ONCE = 16


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found; available: {df.columns}")
    return df


def read_csv(spark: SparkSession, path: str | list[str], missing: tuple[str, ...] = MISSING, multiline: bool = True) -> DataFrame:
    """One CSV with a header, or several with the same, all columns as strings, missing values as NULL.

    A quoted value may hold line breaks. Files without such values should be read with
    multiline=False: Spark can then split a large file.
    """
    df = spark.read.csv(path, header=True, multiLine=multiline, quote='"', escape='"')
    return df.select([F.when(~F.col(f"`{c}`").isin(list(missing)), F.col(f"`{c}`")).alias(c) for c in df.columns])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows; columns are matched by name and missing ones are NULL."""
    if not frames:
        raise ValueError("nothing to unite")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_csv(spark: SparkSession, pattern: str, target: str | None = None, **options) -> DataFrame:
    """Unites all CSV files that match a path pattern, leaving out the file or folder `target`.

    `target` is a path; a relative one also names what ends in all of its parts. Files with the same header are
    read together, so the plan has one branch for each header and not for each file. Of every file the first record is read
    to sort the files by it, and then the whole file once.
    """
    listed = spark.read.format("binaryFile").load(pattern).select("path")
    if target:
        parts = [x for x in target.split("://")[-1].split("/") if x]
        own = F.split(F.regexp_replace(F.col("path"), r"^[A-Za-z][A-Za-z0-9+.-]*:/*", ""), "/+")
        n = len(parts)
        at = F.transform(F.sequence(F.lit(1), F.size(own)), lambda i: F.slice(own, i, n))
        named = F.array(*[F.lit(x) for x in parts])
        absolute = target.startswith("/") or "://" in target
        listed = listed.where(F.slice(own, 1, n) != named if absolute else ~F.exists(at, lambda x: x == named))
    headers = headers_of(listed)
    rows = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()  # file names, by header
    found = [(row["header"], row["paths"]) for row in rows if row["header"] is not None]
    unread = [path for row in rows if row["header"] is None for path in row["paths"]]
    with ThreadPoolExecutor(PATHS_AT_ONCE) as pool:  # in stores that only Spark reads, Spark looks at the heads one by one
        heads = list(pool.map(lambda path: spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').columns, unread))
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, paths in [*found, *((head, [path]) for head, path in zip(heads, unread))]:
        groups.setdefault(tuple(header), []).extend(paths)
    if not groups:
        raise FileNotFoundError(f"no CSV files match {pattern}")
    return union_by_name([read_csv(spark, sorted(paths), **options) for paths in sorted(groups.values(), key=min)])


def headers_of(files: DataFrame) -> DataFrame:
    """(path, header): the first record of each CSV file, parsed as CSV: a name may hold commas, quotes and line breaks.

    Tasks open the files and read no further than that record. Null where a file is in a store that only Spark reads.
    """
    def read(batches):
        for batch in batches:
            headers = []
            for path in batch.column(0).to_pylist():
                try:
                    store, name = FileSystem.from_uri(path)
                except (pa.ArrowException, ValueError, OSError):
                    headers.append(None)
                    continue
                with TextIOWrapper(store.open_input_stream(name, buffer_size=HEAD_BYTES), "utf-8-sig", newline="") as head:
                    headers.append(next((record for record in csv.reader(head) if record), []))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(headers, pa.list_(pa.string()))], names=["path", "header"])

    parts = files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").repartition(parts, "path").mapInArrow(read, "path string, header array<string>")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_documents(
    spark: SparkSession, path: str, text_col: str = "text", id_col: str | None = "doc_id", format: str = "parquet"
) -> DataFrame:
    """(doc_id, text) from a table; fails when the text column is not there.

    Without an id column a row's id is a hash of its text and its place among the rows of that text, so it does not
    depend on how the input is split.
    """
    df = read_csv(spark, path) if format == "csv" else spark.read.format(format).load(path)
    require_columns(df, text_col, *([id_col] if id_col else []))
    if id_col:
        return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    plain = df.select(F.col(text_col).cast("string").alias("text"))
    folded = plain.groupBy("text").count()  # rows of one text are alike: a number for each is all that tells them apart
    numbered = folded.select("text", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("count"))).alias("copy"))
    return numbered.select(F.xxhash64("text", "copy").alias("doc_id"), "text")


def write_tokens(tokens: DataFrame, path: str) -> None:
    """(doc_id, tokens, joined) as Parquet."""
    with small_batches(tokens.sparkSession):
        listed = tokens.select("doc_id", "tokens", F.array_join("tokens", " ").alias("joined"))
        listed.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(spark.read.parquet(path), "doc_id", "tokens", "joined")
