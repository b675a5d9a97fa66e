"""Side-by-side comparison of a Spark result with the SQL engine's."""

from __future__ import annotations

import decimal
import math

import duckdb

from catalogue.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r),
    )


def differences(spark_df, con, sql: str) -> str | None:
    """None when names and values agree, else a short description."""
    left = _sorted(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    relation = con.execute(sql)
    right = _sorted([d[0] for d in relation.description], relation.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows vs {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{a} vs {b}"
    return None
