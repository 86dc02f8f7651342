"""Runs queries in Spark and their SQL in DuckDB and compares the rows.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

from checks.catalog import QUERIES
from checks.oracles import oracles
from nearkin.session import local_session

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    spark = local_session(8)
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    sql, bad = oracles(), 0
    for name in wanted:
        start = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        ours = rows(df.columns, df.collect())
        spark_time = time.perf_counter() - start
        if name not in sql:
            print(f"{name:26} rows {len(ours):8} spark {spark_time:6.1f}s  no SQL", flush=True)
            continue
        start = time.perf_counter()
        result = db.sql(sql[name])
        names, types = list(result.columns), [str(t) for t in result.types]
        theirs = rows(names, result.fetchall())
        sql_time = time.perf_counter() - start
        same = sorted(names) == sorted(df.columns) and ours == theirs
        bad += not same
        print(f"{name:26} rows {len(ours):8} spark {spark_time:6.1f}s  sql {sql_time:6.1f}s  {'ok' if same else 'DIFFERENT'}", flush=True)
        if not same:
            print("  spark", df.dtypes, len(ours))
            print("  sql  ", list(zip(names, types)), len(theirs))
            odd = [(a, b) for a, b in zip(ours, theirs) if a != b]
            print("  rows that differ:", len(odd), str(odd[:1])[:600])
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
