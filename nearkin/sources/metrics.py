"""Metrics and samples as JSON or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_json(df: DataFrame, path: str) -> None:
    """Metrics rows, or a Jaccard sample, as JSON lines."""
    df.write.mode("overwrite").json(path)


def save_metrics(spark: SparkSession, metrics: dict | list[dict], path: str) -> None:
    """One dict or a list of dicts as CSV with a header; columns in order of first appearance."""
    rows = [metrics] if isinstance(metrics, dict) else list(metrics)
    names = list(dict.fromkeys(name for row in rows for name in row))
    values = [[None if row.get(n) is None else str(row[n]) for n in names] for row in rows]
    schema = ", ".join(f"`{n}` string" for n in names)
    spark.createDataFrame(values, schema).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
