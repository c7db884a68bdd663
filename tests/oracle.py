"""Compare a Spark result with the SQL of its query in DuckDB."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, (bytes, bytearray, memoryview)):
        return bytes(value).hex()
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def from_spark(df):
    return rows_of(df.columns, df.collect())


def from_sql(folder, sql):
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())
