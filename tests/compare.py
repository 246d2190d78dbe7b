"""Compare a Spark result with its SQL oracle, ignoring row order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return str(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    actual = rows_of(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"rows {sum(actual.values())} vs {sum(expected.values())}; "
        f"only Spark {list(extra.items())[:3]}; only SQL {list(missing.items())[:3]}"
    )
