"""Run queries beside their SQL and compare whole results."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _cell(value):
    if isinstance(value, dt.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(round(value, 9)))
    return (type(value).__name__, str(value))


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def types(frame, con, sql: str):
    """(spark, sql) column types by name."""
    described = con.execute(f"describe {sql}").fetchall()
    return {name: DUCK_TYPES.get(kind, kind) for name, kind in frame.dtypes}, {row[0]: row[1] for row in described}


def compare(frame, con, sql: str):
    """(spark, sql) results, normalised; equal when the query is right."""
    spark_side = _normal(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    sql_side = _normal([d[0] for d in cursor.description], cursor.fetchall())
    return spark_side, sql_side
