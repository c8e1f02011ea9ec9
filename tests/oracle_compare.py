"""Run a named query on Spark and its SQL on DuckDB and compare names, types and values."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def difference(con, frame, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    result = con.execute(sql)
    expected_types = {d[0]: TYPE_NAMES.get(str(d[1]), str(d[1])) for d in result.description}
    names = sorted(expected_types)
    if sorted(frame.columns) != names:
        return f"columns {sorted(frame.columns)} != {names}"
    order = [d[0] for d in result.description]
    places = [order.index(n) for n in names]
    expected = sorted((tuple(row[p] for p in places) for row in result.fetchall()), key=_key)
    types = dict(frame.dtypes)
    wrong = {n: (types[n], expected_types[n]) for n in names if types[n] != expected_types[n]}
    if wrong:
        return f"types {wrong}"
    actual = sorted((tuple(row) for row in frame.select(*names).collect()), key=_key)
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(bad)} rows differ, first {bad[0]} in {names}" if bad else None
