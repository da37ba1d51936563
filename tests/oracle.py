"""Runs a query and its DuckDB statement on the same tables and compares the rows."""

import datetime
import decimal
import glob
import os

import duckdb


def _plain(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def connect(folder):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def same(spark, con, folder, query, sql):
    df = query(spark, folder)
    rows = [r.asDict() for r in df.collect()]
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    a = sorted(repr(tuple(_plain(r[c]) for c in order)) for r in rows)
    b = sorted(repr(tuple(_plain(r[names.index(c)]) for c in order)) for r in got.fetchall())
    assert a == b
