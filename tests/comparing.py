"""Runs a registered query and its oracle and compares rows, whatever their order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = Path("/root/testdata")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return value


def rows_by_name(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_rows(frame) -> tuple[list[str], Counter]:
    return sorted(frame.columns), rows_by_name(frame.columns, frame.collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return sorted(names), rows_by_name(names, result.fetchall())
