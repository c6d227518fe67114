"""Compare a registered query with its SQL in DuckDB, value by value."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime) and value.time() == datetime.time(0):
        return str(value.date())
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def sort_key(row):
    return tuple((v is None, type(v).__name__, str(v)) for v in row)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=sort_key)


def spark_rows(df):
    return normal(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(db, sql):
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    return normal(columns, result.fetchall())


TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "double": "DOUBLE",
    "float": "FLOAT",
    "int": "INTEGER",
    "string": "VARCHAR",
}


def spark_types(df):
    return {name: TYPES[kind] for name, kind in df.dtypes}


def duck_types(db, sql):
    return {row[0]: row[1] for row in db.execute(f"DESCRIBE {sql}").fetchall()}
