"""Compare a query's Spark result with its SQL run by DuckDB on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb

KINDS = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "int": "INTEGER",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _row(values) -> tuple:
    return tuple(repr(v) for v in values)


def differences(df, con, sql: str) -> list[str]:
    """Problems found; empty when names, types and rows agree."""
    problems = []
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {name: kind for name, kind, *_ in described}
    columns = sorted(df.columns)
    if columns != sorted(expected_types):
        return [f"columns {columns} != {sorted(expected_types)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind) != expected_types[name]:
            problems.append(f"type of {name}: {kind} != {expected_types[name]}")
    names = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(_row(r) for r in con.execute(f"SELECT {names} FROM ({sql})").fetchall())
    actual = sorted(_row(r) for r in df.select(*columns).collect())
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    if actual != expected:
        only_here = [r for r in actual if r not in set(expected)][:2]
        only_there = [r for r in expected if r not in set(actual)][:2]
        problems.append(f"{columns}: spark {only_here} sql {only_there}")
    return problems
