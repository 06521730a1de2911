"""Run a query and its SQL, and compare columns, types, and rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

# Spark type -> the SQL engine's type for the same values.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _row(values):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in values)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def mismatch(df, sql: str, con) -> str | None:
    """None if they agree, else what differs."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} vs {sorted(relation.columns)}"
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for n in names:
        if TYPES.get(types[n]) != theirs[n]:
            return f"column {n}: {types[n]} vs {theirs[n]}"
    mine = _sorted(_row(r) for r in df.select(*names).toLocalIterator())
    other = _sorted(_row(r) for r in relation.project(", ".join(f'"{n}"' for n in names)).fetchall())
    if len(mine) != len(other):
        return f"{len(mine)} rows vs {len(other)}"
    for a, b in zip(mine, other):
        if a != b:
            return f"row {a} vs {b}"
    return None
