"""Comparing a query with its SQL: the same bag of rows under the same column names."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("set TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p if p.is_file() else str(p) + '/*.parquet'}'")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "item"):
        v = v.item()
    return round(v, 9) if isinstance(v, float) else v


def bag(df):
    df = df[sorted(df.columns)]
    return list(df.columns), Counter(tuple(plain(v) for v in r) for r in df.itertuples(index=False))


def same(spark_df, connection, sql):
    a, b = bag(spark_df.toPandas()), bag(connection.execute(sql).fetchdf())
    assert a[0] == b[0]
    assert a[1] == b[1], (list((a[1] - b[1]).items())[:3], list((b[1] - a[1]).items())[:3])
    return sum(a[1].values())
