"""Comparison of a Spark result with DuckDB running the checking SQL."""

from __future__ import annotations

import math
import pathlib
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as from read_parquet('{file}')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, date):
        return v.isoformat()
    return v


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    return _sorted_rows([d[0] for d in result.description], result.fetchall())


KINDS = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def spark_types(df):
    return {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields}


def duck_types(con, sql):
    rows = con.execute(f"describe {sql}").fetchall()
    return {name: kind for name, kind, *_ in rows}
