"""Run a registered query and its oracle side by side."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_by_name(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """Number of rows and a description of the first difference, if any."""
    spark_rows = df.collect()
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    oracle_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return len(spark_rows), f"columns differ: {sorted(set(df.columns) ^ set(columns))}"
    ours, theirs = rows_by_name(df.columns, spark_rows), rows_by_name(columns, oracle_rows)
    if ours != theirs:
        extra, lacking = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        return len(spark_rows), f"{len(spark_rows)} rows against {len(oracle_rows)}; only ours {extra}; only oracle {lacking}"
    return len(spark_rows), None
