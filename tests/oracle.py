"""Comparison of a registered query with its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) for v in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=_key)


def differences(df, sql: str, con) -> list[str]:
    """What differs between a DataFrame and the SQL's result, values and types of values included."""
    relation = con.execute(sql)
    want_columns = [d[0] for d in relation.description]
    want_columns, want = rows_of(want_columns, relation.fetchall())
    got_columns, got = rows_of(df.columns, df.collect())
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    found = []
    if len(got) != len(want):
        found.append(f"{len(got)} rows != {len(want)}")
    found += [f"{a} != {b}" for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return found
