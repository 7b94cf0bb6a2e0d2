"""Compare a Spark result with the same query on DuckDB, ignoring row order."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date", "HUGEINT": "hugeint",
}


def difference(con, df, sql: str) -> str | None:
    """None if both agree in columns, types and rows, else what differs."""
    left_columns, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names, kinds = [d[0] for d in cursor.description], [str(d[1]) for d in cursor.description]
    right_columns, right = rows_of(names, cursor.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} <> {right_columns}"
    spark_kinds = dict(df.dtypes)
    types = [
        f"{n}: {spark_kinds[n]} <> {k}" for n, k in zip(names, kinds)
        if not k.startswith("DECIMAL") and KINDS.get(k, k) != spark_kinds[n]
    ]
    if types:
        return "types " + "; ".join(types)
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"{sum(left.values())} <> {sum(right.values())} rows, {sum(only_left.values())} only in Spark, e.g. "
            f"{list(only_left)[:3]}, {sum(only_right.values())} only in SQL, e.g. {list(only_right)[:3]}"
        )
    return None
