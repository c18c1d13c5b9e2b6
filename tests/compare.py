"""Run a query and its SQL on the same tables and report how they differ."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from paddock.plans.views import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0  # -0.0 becomes 0.0
    return value


def differences(spark_df, con, sql: str) -> str | None:
    """None if both sides hold the same rows, whatever their order."""
    names = sorted(spark_df.columns)
    mine = [tuple(plain(r[c]) for c in names) for r in spark_df.select(*[f"`{c}`" for c in names]).collect()]
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    index = [columns.index(c) for c in names]
    theirs = [tuple(plain(r[i]) for i in index) for r in relation.fetchall()]
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    if not mine:
        return "no rows"
    for a, b in zip(mine[:50], theirs[:50]):
        kinds = [(n, type(x), type(y)) for n, x, y in zip(names, a, b)
                 if x is not None and y is not None and type(x) is not type(y)]
        if kinds:
            return f"types {kinds}"
    left = Counter(mine) - Counter(theirs)
    if left:
        right = Counter(theirs) - Counter(mine)
        return f"{sum(left.values())} rows differ, such as {names}: {list(left)[:2]} against {list(right)[:2]}"
    return None
