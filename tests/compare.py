"""Compare a Spark result with the same query in DuckDB, row by row."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Rows as comparable tuples, in value order, columns in name order."""
    columns = sorted(frame.columns)
    return sorted(
        (tuple(_plain(v) for v in row) for row in frame[columns].itertuples(index=False, name=None)),
        key=repr,
    )


def _plain(value):
    if value is None or (not isinstance(value, str) and pd.isna(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.date().isoformat()
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if hasattr(value, "item"):
        value = value.item()
    return value + 0.0 if isinstance(value, float) else value


# Column types that mean the same in both engines.
_SAME_TYPE = {"DOUBLE": "double", "BIGINT": "bigint", "INTEGER": "int", "DATE": "date",
              "VARCHAR": "string", "BOOLEAN": "boolean"}


def types_of(db: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    described = db.execute(f"DESCRIBE {sql}").fetchall()
    return {name: _SAME_TYPE.get(kind, kind) for name, kind, *_ in described}
