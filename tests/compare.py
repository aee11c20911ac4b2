"""Order-insensitive comparison of a Spark frame and a DuckDB result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return float(value)
    if hasattr(value, "as_tuple"):
        return float(value)
    return str(value)


def _normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None if both agree, else a short account of the first difference."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = _normal(columns, cursor.fetchall())
    got = _normal(df.columns, df.collect())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None


# DuckDB type to the Spark type the driver may expect for it
_KINDS = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def type_differences(df, con, sql: str) -> list[str]:
    want = {r[0]: _KINDS.get(r[1], r[1]) for r in con.execute("DESCRIBE " + sql).fetchall()}
    return [f"{n}: {t}, twin {want.get(n)}" for n, t in df.dtypes if t != want.get(n)]
