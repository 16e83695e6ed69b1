"""Comparison of a query with its SQL in DuckDB."""

import datetime
import glob
import math
import os

import duckdb


def views(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(p)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
