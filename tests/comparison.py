"""Order-insensitive comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, Decimal):
        return float(f"{float(value):.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def multiset(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_multiset(df):
    return multiset(df.columns, df.collect())


def sql_multiset(connection, sql):
    result = connection.execute(sql)
    return multiset([d[0] for d in result.description], result.fetchall())


def kinds(df) -> list[tuple[str, str]]:
    return sorted(df.dtypes)


def sql_kinds(connection, sql) -> list[tuple[str, str]]:
    result = connection.execute(sql)
    return sorted((d[0], str(d[1])) for d in result.description)
