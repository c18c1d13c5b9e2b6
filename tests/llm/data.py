"""The smallest given tables."""

import duckdb

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "conversations")


def connect() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def rows(sql: str) -> list[tuple]:
    return connect().execute(sql).fetchall()


def documents() -> list[tuple]:
    return rows("SELECT doc_id, text FROM documents ORDER BY doc_id")
