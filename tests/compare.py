"""Run registered queries in Spark and their SQL in DuckDB and compare every value.

    python tests/compare.py [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def differences(spark, connection, sf_dir: str, name: str) -> str | None:
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    got_columns, got = _rows(df.columns, df.collect())
    result = connection.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want_columns, want = _rows(columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:2] if len(got) < 300_000 else []
        only_want = [r for r in want if r not in set(got)][:2] if len(want) < 300_000 else []
        return f"{len(got)} rows against {len(want)}; only Spark {only_got}; only SQL {only_want}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from addrspark.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(args.sf)
    failed = 0
    for name in args.names or list(queries()):
        if name not in oracle_sql():
            print(f"{name:30} no SQL")
            continue
        started = time.time()
        try:
            problem = differences(spark, connection, args.sf, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:30} {'ok' if problem is None else 'FAIL ' + problem} {time.time() - started:.1f}s", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
