"""Runs a registered query on Spark and its SQL counterpart on DuckDB, and compares the rows."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    """(message or None, Spark seconds, DuckDB seconds, rows)."""
    t0 = time.time()
    df = fn(spark, sf_dir)
    got, got_columns = rows_of(df.columns, df.collect())
    t1 = time.time()
    if sql is None:
        return None, t1 - t0, 0.0, len(got)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want, want_columns = rows_of(columns, result.fetchall())
    t2 = time.time()
    message = None
    if got_columns != want_columns:
        message = f"columns {got_columns} != {want_columns}"
    elif got != want:
        mine, theirs = set(got) - set(want), set(want) - set(got)
        message = (f"{len(got)} rows against {len(want)}; only Spark {len(mine)}: {sorted(mine)[:3]}; "
                   f"only SQL {len(theirs)}: {sorted(theirs)[:3]}")
    return message, t1 - t0, t2 - t1, len(got)
