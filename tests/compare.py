"""Order-free comparison of a Spark result with SQL run by DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return db


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, db, sql):
    """Column names of both sides, the rows only one side has, and the number of expected rows."""
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    found = rows_of(df.columns, (tuple(r) for r in df.collect()))
    return sorted(df.columns), sorted(names), found - expected, expected - found, expected.total()
