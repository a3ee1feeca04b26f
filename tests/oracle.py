"""Side-by-side run of a query and its SQL on the same parquet tables."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import date, datetime

import duckdb

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, name: str, query, sql: str, con, sf_dir: str = DATA) -> str | None:
    """None when both sides agree on columns and rows, else a short description."""
    df = query(spark, sf_dir)
    ours_columns = list(df.columns)
    ours = as_bag(ours_columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs_columns = [c[0] for c in result.description]
    theirs = as_bag(theirs_columns, result.fetchall())
    if sorted(ours_columns) != sorted(theirs_columns):
        return f"{name}: columns {sorted(ours_columns)} != {sorted(theirs_columns)}"
    if not ours:
        return f"{name}: no rows"
    if ours != theirs:
        more, less = ours - theirs, theirs - ours
        return (
            f"{name}: {sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only here {list(more.items())[:3]}; only in SQL {list(less.items())[:3]}"
        )
    return None
