"""Compare queries with their SQL on one scale factor: ``python tests/oracle.py [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, (datetime.datetime, datetime.date, decimal.Decimal)):
        return str(value)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(spark, connection, name, run, sql, sf_dir) -> str | None:
    frame = run(spark, sf_dir)
    columns, rows = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    expected_columns, expected = _sorted([d[0] for d in result.description], result.fetchall())
    if columns != expected_columns:
        return f"{name}: columns {columns}, expected {expected_columns}"
    if len(rows) != len(expected):
        return f"{name}: {len(rows)} rows, expected {len(expected)}"
    for got, wanted in zip(rows, expected):
        if repr(got) != repr(wanted):
            return f"{name}: {got!r:.300}, expected {wanted!r:.300}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entries

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection, sql, failed = connect(sf_dir), entries.oracle_sql(), 0
    for name, run in entries.queries().items():
        if name not in sql or sys.argv[1:] and name not in sys.argv[1:]:
            continue
        started = time.time()
        try:
            problem = differences(spark, connection, name, run, sql[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{name}: {type(error).__name__} {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - started:5.1f}s {problem or name}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
