"""Run a registered query and its SQL twin and compare the rows exactly."""

from __future__ import annotations

import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _cell(value):
    if isinstance(value, float):
        return "NaN" if value != value else repr(value)
    return value if value is None or isinstance(value, (str, bool)) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, db, sql):
    """None when equal, else a short description of the first difference."""
    mine_columns, mine = rows_of(df.columns, df.collect())
    result = db.execute(sql)
    columns, twin = rows_of([c[0] for c in result.description], result.fetchall())
    if mine_columns != columns:
        return f"columns {mine_columns} against {columns}"
    if len(mine) != len(twin):
        return f"{len(mine)} rows against {len(twin)}"
    off = [(a, b) for a, b in zip(mine, twin) if a != b]
    return f"{len(off)} of {len(mine)} rows differ, such as {off[0]}" if off else None
