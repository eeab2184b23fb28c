"""Compares a query's result with its SQL statement, as multisets of rows with columns ordered by name."""

from __future__ import annotations

import datetime
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


KINDS = {
    "TIMESTAMP": "timestamp_ntz", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean",
}


def normal(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(spark_df, connection, sql: str) -> list[str]:
    """What differs between both results; empty when they are the same."""
    relation = connection.sql(sql)
    expected_names = sorted(relation.columns)
    names = sorted(spark_df.columns)
    if names != expected_names:
        return [f"columns {set(names) ^ set(expected_names)}"]
    kinds = dict(zip(relation.columns, [str(t) for t in relation.types]))
    types = dict(spark_df.dtypes)
    found = [f"{c}: {types[c]} against {kinds[c]}" for c in names if KINDS.get(kinds[c], kinds[c]) != types[c]]
    place = [relation.columns.index(c) for c in names]
    expected = Counter(tuple(normal(row[i]) for i in place) for row in relation.fetchall())
    actual = Counter(tuple(normal(v) for v in row) for row in spark_df.select(*names).collect())
    if actual != expected:
        found.append(
            f"{sum(actual.values())} rows against {sum(expected.values())}; only here "
            f"{list((actual - expected).items())[:2]}; only there {list((expected - actual).items())[:2]}; columns {names}"
        )
    return found
