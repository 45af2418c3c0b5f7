"""Order-insensitive comparison of a Spark result with DuckDB on the same files."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return (2, "nan")
        return (3, f"{float(value):.6f}".replace("-0.000000", "0.000000"))
    if isinstance(value, (list, tuple)):
        return (4, str([_cell(v) for v in value]))
    return (5, str(value))


def table(columns: list[str], rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": {"BIGINT", "HUGEINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree in columns, types, row count and values."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    want_rows = found.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    for name, kind in df.dtypes:
        if kinds[name] not in KINDS.get(kind, {kinds[name]}):
            return f"type of {name}: {kind} against {kinds[name]}"
    got = table(df.columns, df.collect())
    want = table(names, want_rows)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            order = sorted(names)
            pairs = [(n, x[1], y[1]) for n, x, y in zip(order, a, b) if x != y]
            return f"first difference {pairs} in {[x[1][:60] for x in a]}"
    return None
