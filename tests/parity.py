"""Run a query in Spark and its oracle in DuckDB and compare rows, names and types."""

from __future__ import annotations

import glob
import os

import duckdb

TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def spark_rows(df) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(df.columns)
    types = {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}
    return types, _sorted([tuple(row[name] for name in names) for row in df.collect()])


def duckdb_rows(connection, sql: str) -> tuple[dict[str, str], list[tuple]]:
    result = connection.sql(sql)
    names, kinds = result.columns, [str(kind) for kind in result.types]
    order = [names.index(name) for name in sorted(names)]
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return dict(zip(names, kinds)), _sorted(rows)
