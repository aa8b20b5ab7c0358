"""Compare Spark results with DuckDB on the same Parquet tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def difference(frame, connection, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    names = sorted(frame.columns)
    spark_rows = [tuple(row[name] for name in names) for row in frame.collect()]
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    places = [columns.index(name) for name in names]
    duck_rows = [tuple(row[place] for place in places) for row in result.fetchall()]
    left, right = Counter(spark_rows), Counter(duck_rows)
    if left == right:
        return None
    only_spark = list((left - right).items())[:3]
    only_duck = list((right - left).items())[:3]
    return f"{len(spark_rows)} rows against {len(duck_rows)}; {names}: {only_spark} / {only_duck}"
