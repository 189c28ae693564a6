"""Compare every registered query with its SQL oracle on one data folder.

    python tests/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(spark, connection, name: str, sf_dir: str) -> list[str]:
    df = spark_entry.queries()[name](spark, sf_dir)
    ours_columns, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(spark_entry.oracle_sql()[name])
    theirs_columns, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours_columns != theirs_columns:
        return [f"columns {ours_columns} != {theirs_columns}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)} rows"]
    found = []
    for a, b in zip(ours, theirs):
        for c, x, y in zip(ours_columns, a, b):
            if x != y or type(x) is not type(y):
                found.append(f"{c}: {x!r} != {y!r}")
    return found


def main() -> int:
    from conftest import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    connection = duck(sf_dir)
    failed = 0
    for name in sys.argv[2:] or list(spark_entry.queries()):
        started = time.time()
        if name not in spark_entry.oracle_sql():
            n = len(spark_entry.queries()[name](spark, sf_dir).collect())
            print(f"rows  {name} {n} {time.time() - started:.2f}s", flush=True)
            continue
        found = differences(spark, connection, name, sf_dir)
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '}  {name} {time.time() - started:.2f}s {found[:4]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
