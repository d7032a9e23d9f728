"""Side-by-side comparison of a registered query and its SQL."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and values agree."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    want = _rows(names, expected.fetchall())
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
             "BOOLEAN": "boolean", "DATE": "date"}
    typed = dict(df.dtypes)
    for name, kind in zip(names, (str(d[1]) for d in expected.description)):
        if typed.get(name) != kinds.get(kind, kind):
            found.append(f"{name}: {typed.get(name)} != {kind}")
    if len(got) != len(want):
        found.append(f"{len(got)} rows != {len(want)}")
    if got != want:
        only_got, only_want = set(got) - set(want), set(want) - set(got)
        found.append(f"{sorted(only_got)[:3]} != {sorted(only_want)[:3]} ({len(only_got)}, {len(only_want)})")
    return found
