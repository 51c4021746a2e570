"""Run a query in Spark and its SQL in DuckDB and compare types and rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "date": "DATE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, repr(value + 0.0))
    return (1, str(value))


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, con, sql: str) -> list[str]:
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    expected = _table(list(described), cursor.fetchall())
    found_types = dict(frame.dtypes)
    problems = []
    if sorted(found_types) != sorted(described):
        return [f"columns {sorted(found_types)} != {sorted(described)}"]
    for name, kind in found_types.items():
        if TYPES.get(kind, kind) != described[name]:
            problems.append(f"{name}: {kind} != {described[name]}")
    names = frame.columns
    found = _table(names, [tuple(r) for r in frame.collect()])
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    bad = [(a, b) for a, b in zip(found, expected, strict=False) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    return problems
