"""Compare a Spark result with SQL over the same Parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _value(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


# Spark and DuckDB names of the same type.
_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when columns, types and rows agree."""
    found = con.sql(sql)
    theirs = dict(zip(found.columns, (str(t) for t in found.types)))
    ours = {c: _TYPES.get(t, t) for c, t in df.dtypes}
    if ours != theirs:
        return f"columns: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    mine, other = _rows(df.columns, map(tuple, df.collect())), _rows(found.columns, found.fetchall())
    if mine != other:
        return f"{sum(mine.values())} / {sum(other.values())} rows; only ours {list((mine - other))[:2]}, only SQL {list((other - mine))[:2]}"
    return ""
