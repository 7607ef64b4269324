"""Compares a query with its SQL twin, value by value.

Run as ``python -m tests.oracle [sf_dir] [query ...]`` for a report with timings.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from reviewloom.queries import oracle_sql, queries
from reviewloom.queries.views import TABLES
from reviewloom.session import local_session

DEFAULT_DIR = "/root/testdata/sf0.01"
# Spark type -> checking engine type; others must have the same name.
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[list[str], int, float]:
    """Differences found, number of rows and seconds of the Spark side."""
    start = time.time()
    df = queries()[name](spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return ([] if got else ["no rows"]), len(got), seconds
    wanted = con.sql(sql)
    problems = []
    kinds = dict(zip(wanted.columns, map(str, wanted.types)))
    for column, kind in df.dtypes:
        if column not in kinds:
            problems.append(f"column {column} is not in the SQL")
        elif TYPES.get(kind, kind.upper()) != kinds[column]:
            problems.append(f"type of {column}: {kind} against {kinds[column]}")
    if len(kinds) != len(df.columns):
        problems.append(f"columns {sorted(df.columns)} against {sorted(kinds)}")
        return problems, len(got), seconds
    left = _rows(got, df.columns)
    right = _rows(wanted.fetchall(), list(kinds))
    if left != right:
        extra, missing = left - right, right - left
        problems.append(
            f"{sum(extra.values())} rows too many, {sum(missing.values())} missing of {sum(right.values())}; "
            f"e.g. {str(sorted(extra, key=str)[:2])[:400]} against {str(sorted(missing, key=str)[:2])[:400]}"
        )
    return problems, len(got), seconds


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else DEFAULT_DIR
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in args or queries():
        try:
            problems, n, seconds = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problems, n, seconds = [f"{type(error).__name__}: {str(error)[:1500]}"], -1, 0.0
        failures += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={n} {seconds:.2f}s", *problems, sep="\n       ", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(main())
