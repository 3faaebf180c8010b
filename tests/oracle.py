"""Compare a query with its SQL twin: same columns, same rows in any order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    expected, got = rows_of(names, result.fetchall()), rows_of(df.columns, df.collect())
    if expected == got:
        return None
    missing, extra = expected - got, got - expected
    return (
        f"{sum(got.values())} vs {sum(expected.values())} rows; "
        f"missing {missing.total()}: {str(list(missing.elements())[:2])[:600]}; "
        f"extra {extra.total()}: {str(list(extra.elements())[:2])[:600]}"
    )
