"""Running a query on Spark and its SQL on DuckDB, and comparing names, types and rows."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of rows of the Spark result, and everything in which DuckDB disagrees."""
    relation = connection.sql(sql)
    expected = dict(zip(relation.columns, map(str, relation.types)))
    found = {name: TYPES.get(kind, kind) for name, kind in result.dtypes}
    problems = []
    if expected != found:
        problems.append(f"columns: spark {found}, duckdb {expected}")
        if set(expected) != set(found):
            return -1, problems
    ours = canonical(result.columns, result.collect())
    theirs = canonical(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows: spark {len(ours)}, duckdb {len(theirs)}")
    if ours != theirs:
        missing, extra = sorted(set(theirs) - set(ours)), sorted(set(ours) - set(theirs))
        problems.append(f"only duckdb ({len(missing)}): {missing[:2]}; only spark ({len(extra)}): {extra[:2]}")
    return len(ours), problems
