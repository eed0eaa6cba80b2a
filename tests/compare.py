"""Running a registered query and its SQL twin side by side."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.sql(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def differences(df, connection, sql: str) -> list[str]:
    """What differs between the two results: names, types, row counts, values."""
    twin = connection.sql(sql)
    found = []
    types = {n: SPARK_TYPES.get(t, t) for n, t in df.dtypes}
    twin_types = {n: str(t) for n, t in zip(twin.columns, twin.types)}
    if set(types) != set(twin_types):
        return [f"columns {sorted(types)} against {sorted(twin_types)}"]
    for name, kind in types.items():
        if kind != twin_types[name]:
            found.append(f"type of {name}: {kind} against {twin_types[name]}")
    mine = _sorted([tuple(r) for r in df.collect()], df.columns)
    theirs = _sorted(twin.fetchall(), twin.columns)
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows against {len(theirs)}")
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[0][0]} against {bad[0][1]}")
    return found
