"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    try:
        return f"{float(value):.9f}" if not isinstance(value, str) else value
    except (TypeError, ValueError):
        return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str):
    """Empty text if both sides agree, else what differs first."""
    left_columns, left = _rows(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    right_columns, right = _rows([d[0] for d in result.description], result.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} / {right_columns}"
    if len(left) != len(right):
        return f"{len(left)} / {len(right)} rows; e.g. {[r for r in left if r not in set(right)][:3]}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ: {wrong[:3]}" if wrong else ""
