"""Rows of a query and of its SQL in DuckDB, in one normal form."""

import math
import os

import duckdb


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def both(spark, query, sql, folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"create view {f[:-8]} as select * from read_parquet('{folder}/{f}')")
    df = query(spark, folder)
    names = sorted(df.columns)
    a = sorted(tuple(norm(r[c]) for c in names) for r in df.collect())
    cur = con.execute(sql)
    own = [x[0] for x in cur.description]
    assert sorted(own) == names
    b = sorted(tuple(norm(r[own.index(c)]) for c in names) for r in cur.fetchall())
    return a, b
