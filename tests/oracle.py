"""Compare a Spark result with DuckDB's answer: columns by name, rows as a multiset."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from sparkmart.workload.base import DRIVER_TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def types_of(df):
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return {name: _TYPES.get(kind, kind.upper()) for name, kind in kinds.items()}


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    want_types = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if types_of(df) != want_types:
        return f"types {types_of(df)} != {want_types}"
    answer = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in answer.description], answer.fetchall())
    got_cols, got = rows_of(df.columns, df.collect())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference {dict(zip(got_cols, g))} != {dict(zip(got_cols, w))}"
    return None
