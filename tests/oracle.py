"""Run a registered query and its SQL check, and compare rows irrespective of order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def _bag(rows, order):
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a description of the difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    actual = [tuple(r) for r in spark_df.collect()]
    left = _bag(actual, [spark_df.columns.index(c) for c in sorted(names)])
    right = _bag(expected, [names.index(c) for c in sorted(names)])
    if not expected:
        return "no rows to compare"
    if left != right:
        extra, lost = left - right, right - left
        return (
            f"rows {len(actual)} vs {len(expected)}; {sum(extra.values())} differ; columns {sorted(names)}; "
            f"spark {sorted(extra, key=str)[:3]}; sql {sorted(lost, key=str)[:3]}"
        )
    return None
