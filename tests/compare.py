"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    df = query(spark, sf_dir)
    found = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    if not expected:
        problems.append("no rows")
    problems += [f"only in spark: {row}" for row in list((found - expected))[:3]]
    problems += [f"only in sql:   {row}" for row in list((expected - found))[:3]]
    return problems
