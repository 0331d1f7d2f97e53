"""Compares a query's rows with those of its SQL in DuckDB, whatever their order."""

import datetime
import decimal
import glob
import os

import duckdb


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if x != x else f"{x:.9g}"
    if isinstance(x, int) and not isinstance(x, bool):
        return f"{float(x):.15g}" if abs(x) < 2**53 else str(x)
    if isinstance(x, datetime.datetime):
        return str(x.replace(tzinfo=None))
    if isinstance(x, dict):
        return str({k: plain(v) for k, v in x.items()})
    if isinstance(x, list | tuple):
        return str([plain(v) for v in x])
    return str(x)


def rows(found):
    return sorted(tuple(plain(r[k]) for k in sorted(r)) for r in found)


def connect(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def same(spark, con, query, sql, sf_dir):
    got = query(spark, sf_dir).toArrow().to_pylist()
    want = con.sql(sql)
    names = want.columns
    want = [dict(zip(names, r, strict=True)) for r in want.fetchall()]
    assert want, "the query shows nothing here"
    assert sorted(got[0]) == sorted(names)
    assert rows(got) == rows(want)
