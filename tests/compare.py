"""Spark and DuckDB results as comparable rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

# The names of the given tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {name} AS FROM '{path}'")
    return db


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _order(row):
    return [(value is None, str(type(value)), str(value)) for value in row]


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(v) for v in row) for row in df.select(*names).collect()]
    return names, sorted(rows, key=_order)


def duck_rows(db, sql: str) -> tuple[list[str], list[tuple]]:
    relation = db.sql(sql)
    names = sorted(relation.columns)
    picked = ", ".join(f'"{name}"' for name in names)
    rows = [tuple(_plain(v) for v in row) for row in relation.select(picked).fetchall()]
    return names, sorted(rows, key=_order)


_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def duck_types(db, sql: str) -> dict[str, str]:
    relation = db.sql(sql)
    return {
        name: _TYPES.get(str(kind), str(kind))
        for name, kind in zip(relation.columns, relation.types, strict=True)
    }


def spark_types(df) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in df.schema.fields}
