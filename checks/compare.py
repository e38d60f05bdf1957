"""Run queries and their oracle side by side: `python -m checks.compare [sf_dir] [names...]`."""

from __future__ import annotations

import math
import sys
import time
from collections.abc import Iterable

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.registry import QUERIES
from shipflux.session import build_session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def normal(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows: Iterable) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, connection, sf_dir: str, name: str, sql: str) -> str:
    """'ok' or what differs."""
    cursor = connection.execute(sql)
    wanted_columns = [item[0] for item in cursor.description]
    wanted = rows_of(wanted_columns, cursor.fetchall())
    df = QUERIES[name](spark, sf_dir)
    found = rows_of(df.columns, df.collect())
    if sorted(df.columns) != sorted(wanted_columns):
        return f"columns differ: {sorted(set(df.columns) ^ set(wanted_columns))}"
    if len(found) != len(wanted):
        return f"rows differ: {len(found)} found, {len(wanted)} wanted"
    # Only the rows that differ are shown: a value counts as equal when both engines give the same one.
    differing = [(a, b) for a, b in zip(found, wanted) if a != b]
    if differing:
        names = sorted(df.columns)
        a, b = differing[0]
        parts = [f"{n}: {x!r} / {y!r}" for n, x, y in zip(names, a, b) if x != y]
        return f"{len(differing)} of {len(found)} rows differ, first: {'; '.join(parts[:6])}"
    return f"ok {len(found)}"


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    texts = oracle_sql()
    names = arguments[1:] or list(texts)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            result = compare(spark, connection, sf_dir, name, texts[name])
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            result = f"error {str(error)[:600]}"
        failed += not result.startswith("ok")
        print(f"{name}: {result} ({time.time() - start:.1f} s)", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
