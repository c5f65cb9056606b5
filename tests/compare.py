"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns and rows are equal, value by value."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    wanted = _sorted_rows(names, result.fetchall())
    found = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(wanted) != len(found):
        return [f"rows: spark {len(found)}, sql {len(wanted)}"]
    return [f"spark {a} != sql {b}" for a, b in zip(found, wanted) if a != b][:3]
