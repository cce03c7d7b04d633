"""Runs a query on Spark and its SQL on DuckDB, and compares the two."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _table(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns, kinds of type and rows."""
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    theirs = cursor.fetchall()
    ours = df.collect()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    a, b = _table(df.columns, ours), _table(columns, theirs)
    if len(a) != len(b):
        return f"{len(a)} rows / {len(b)} rows"
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{x} / {y}"
        if [type(p) for p in x] != [type(p) for p in y]:
            return f"types {[type(p).__name__ for p in x]} / {[type(p).__name__ for p in y]}"
    return None
