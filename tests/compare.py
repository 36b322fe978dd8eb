"""Spark result against DuckDB result, as order-free bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("customer", "events", "lineitem")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return sorted(df.columns), bag(df.columns, df.collect())


def duck_bag(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), bag(columns, result.fetchall())


def difference(df, con, sql) -> str | None:
    """None if equal, else a short description."""
    left_columns, left = spark_bag(df)
    right_columns, right = duck_bag(con, sql)
    if left_columns != right_columns:
        return f"columns {left_columns} vs {right_columns}"
    if left != right:
        return (
            f"rows {sum(left.values())} vs {sum(right.values())}; "
            f"only Spark {list((left - right).items())[:3]}; "
            f"only DuckDB {list((right - left).items())[:3]}"
        )
    return None
