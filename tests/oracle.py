"""Run registered queries against their SQL twins."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def plain(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, decimal.Decimal)):
        return repr(float(value)) if isinstance(value, decimal.Decimal) else str(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def spark_rows(df):
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    names = [df.columns[i] for i in order]
    return names, sorted(tuple(plain(row[i]) for i in order) for row in df.collect())


def duck_rows(connection, sql):
    relation = connection.execute(sql)
    columns = [d[0] for d in relation.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(plain(row[i]) for i in order) for row in relation.fetchall())


def difference(spark, connection, build, sql, sf_dir) -> str | None:
    """None when both sides give exactly the same columns and values, else what differs."""
    names, rows = spark_rows(build(spark, sf_dir))
    other_names, other_rows = duck_rows(connection, sql)
    if names != other_names:
        return f"columns {names} against {other_names}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows against {len(other_rows)}"
    for left, right in zip(rows, other_rows):
        if left != right:
            return f"first difference: {left} against {right}"
    return None
