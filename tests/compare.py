"""Side-by-side comparison of a query with its SQL in DuckDB."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normal = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(normal, key=lambda row: [(v is None, str(type(v)), v) for v in row])


def spark_rows(df):
    return _normal(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _normal([d[0] for d in result.description], result.fetchall())


def differences(left, right, limit=5):
    (columns, rows), (other_columns, other_rows) = left, right
    if columns != other_columns:
        return [f"columns {columns} and {other_columns}"]
    if len(rows) != len(other_rows):
        return [f"{len(rows)} and {len(other_rows)} rows"]
    found = []
    for a, b in zip(rows, other_rows):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            found.append(f"{a} and {b}")
    return found[:limit] + ([f"{len(found)} rows differ"] if found else [])
