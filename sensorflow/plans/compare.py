"""Spark-vs-oracle comparison used by the tests (order-insensitive, columns by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

from pyspark.sql import DataFrame

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of_spark(df: DataFrame):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in data]


def compare(df: DataFrame, con, sql: str) -> dict:
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    out = {"spark_cols": sc, "oracle_cols": dc, "spark_rows": len(sr), "oracle_rows": len(dr)}
    out["cols_match"] = sc == dc
    cs, cd = Counter(sr), Counter(dr)
    out["values_match"] = cs == cd
    if cs != cd:
        out["only_spark"] = list((cs - cd).elements())[:5]
        out["only_oracle"] = list((cd - cs).elements())[:5]
    return out
