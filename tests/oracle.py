"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def _key(row):
    return tuple((v is None, str(type(v)) if isinstance(v, (list, tuple)) else "", round(v, 4) if isinstance(v, float) else str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, _key(r))))


# Spark type and the database types it is compared with.
TYPES = {
    "int": ("INTEGER",), "bigint": ("BIGINT",), "double": ("DOUBLE",), "string": ("VARCHAR",), "boolean": ("BOOLEAN",),
    "timestamp": ("TIMESTAMP", "TIMESTAMP WITH TIME ZONE"),
}


def type_differences(df, described) -> list[str]:
    want = {d[0]: str(d[1]) for d in described}
    return [f"{c}: {t} against {want[c]}" for c, t in df.dtypes if want[c] not in TYPES.get(t, (t,))]


def compare(df, con, sql) -> str | None:
    """None when both results hold the same columns and values, else what differs."""
    got_rows = [tuple(r) for r in df.collect()]
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    want_rows = want.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    types = type_differences(df, want.description)
    if types:
        return f"types {types}"
    if len(got_rows) != len(want_rows):
        return f"rows {len(got_rows)} against {len(want_rows)}"
    bad = [(a, b) for a, b in zip(rows_of(df.columns, got_rows), rows_of(names, want_rows), strict=True) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
