"""Spark result against DuckDB result: columns by name, values exact, rows in any order."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None or value is pd.NA:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0 if value else 0.0
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """NULL when equal, else what differs first."""
    ours = spark_df.collect()
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    left = bag(spark_df.columns, ours)
    right = bag(names, theirs.fetchall())
    if left == right:
        return None
    return (
        f"rows {sum(left.values())} vs {sum(right.values())}; "
        f"only ours {list((left - right).items())[:3]}; only theirs {list((right - left).items())[:3]}"
    )
