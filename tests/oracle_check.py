"""Compare queries() with oracle_sql() at one scale factor: names, types, rows, values.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from tenure.session import build_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, (datetime.date, decimal.Decimal, bool, int)):
        return str(value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=lambda r: tuple((v is not None, str(v)) for v in r))


FAMILY = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def compare(spark, con, sf_dir: str, name: str) -> list[str]:
    df = entry.queries()[name](spark, sf_dir)
    columns, rows = table(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    expected_columns, expected = table([d[0] for d in result.description], result.fetchall())
    problems = []
    if columns != expected_columns:
        problems.append(f"columns {columns} != {expected_columns}")
    for column, kind in df.dtypes:
        if column in types and FAMILY.get(kind, kind) != types[column]:
            problems.append(f"type of {column}: {kind} != {types[column]}")
    if len(rows) != len(expected):
        problems.append(f"rows {len(rows)} != {len(expected)}")
    if rows != expected:
        left, right = set(rows), set(expected)
        problems.append(f"only here {sorted(left - right, key=str)[:2]}, only in SQL {sorted(right - left, key=str)[:2]}")
    return problems


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    spark = build_session("oracle-check", "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            problems = compare(spark, con, sf_dir, name)
        except Exception as error:  # report every query, then fail
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name} {time.time() - started:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
