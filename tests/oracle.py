"""Run a registered query and its SQL over the same folder and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}") + 0.0
    return value


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, query, sql, folder):
    """None if equal, else a short description of the first difference."""
    df = query(spark, folder)
    names, rows = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    oracle_names, oracle_rows = rows_by_name(
        [d[0] for d in result.description], result.fetchall())
    if names != oracle_names:
        return f"columns {names} != {oracle_names}"
    if len(rows) != len(oracle_rows):
        return f"{len(rows)} rows != {len(oracle_rows)}"
    for row, oracle_row in zip(rows, oracle_rows):
        if row != oracle_row:
            return f"{row} != {oracle_row}"
    return None
