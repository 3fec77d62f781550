"""Run a query and its checking SQL and compare all values."""

from __future__ import annotations

import datetime as dt
import math
import pathlib

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = pathlib.Path(sf_dir) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(out, key=repr)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """(rows, difference or None)."""
    names, ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    their_names, theirs = _sorted_rows([d[0] for d in cur.description], cur.fetchall())
    if names != their_names:
        return len(ours), f"columns {names} != {their_names}"
    if len(ours) != len(theirs):
        return len(ours), f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return len(ours), f"first difference\n  spark {a}\n  sql   {b}"
    # types, as the two engines name them
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN",
             "double": "DOUBLE", "date": "DATE"}
    got = {d[0]: str(d[1]) for d in cur.description}
    for name, kind in df.dtypes:
        if kinds.get(kind) != got[name]:
            return len(ours), f"type of {name}: {kind} != {got[name]}"
    return len(ours), None
