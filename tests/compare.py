"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return f"dec {value}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    left_names, left = spark_rows(df)
    right_names, right = duck_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"{sum(left.values())} vs {sum(right.values())} rows; only Spark {sum(only_left.values())}: "
            f"{list(only_left)[:3]}; only SQL {sum(only_right.values())}: {list(only_right)[:3]}"
        )
    return None
