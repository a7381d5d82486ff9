"""Comparison of a Spark result with the result of a DuckDB query, ignoring row order."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def spark_rows(result):
    names = sorted(result.columns)
    return names, _ordered(tuple(row[name] for name in names) for row in result.collect())


def oracle_rows(connection, sql: str):
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = _ordered(tuple(row[i] for i in order) for row in result.fetchall())
    return sorted(columns), rows


def _ordered(rows):
    return sorted((tuple(map(_plain, row)) for row in rows), key=repr)


def _plain(value):
    return value.normalize() if isinstance(value, Decimal) else value
