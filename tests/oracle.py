"""Comparing a Spark result with DuckDB's answer to the oracle SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(folder: Path):
    con = duckdb.connect()
    for file in sorted(folder.glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None when types, row count and every value agree exactly."""
    names = sorted(df.columns)
    theirs = con.sql(f"SELECT {', '.join(names)} FROM ({sql})")
    want_types = [str(t) for t in theirs.types]
    have_types = [TYPES[df.schema[n].dataType.simpleString()] for n in names]
    if want_types != have_types:
        return f"types: {list(zip(names, have_types, want_types))}"
    have = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    want = sorted(theirs.fetchall(), key=_key)
    if len(have) != len(want):
        return f"rows: {len(have)} against {len(want)}"
    wrong = [(a, b) for a, b in zip(have, want) if repr(a) != repr(b)]
    return f"{len(wrong)} of {len(have)} rows, first {wrong[0]}" if wrong else None
