"""Run registered queries and their SQL on the same tables and compare the rows."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return (type(value).__name__, str(value))
    if isinstance(value, (int, float)):
        return ("number", f"{round(float(value), 4) + 0.0:.4f}")
    return (type(value).__name__, str(value))


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results hold the same rows, else what differs."""
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} / {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            cells = [(n, x[1], y[1]) for n, x, y in zip(mine[0], a, b) if x != y]
            return f"first differing row: {cells[:4]}"
    return None if mine[1] else "empty"
