"""Rows of a Spark query against those of its SQL in DuckDB."""

import glob
import math
import os

import duckdb


def plain(v):
    if v is None or isinstance(v, str | bytes | bool | int):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return plain(v.item()) if hasattr(v, "item") else str(v)


def duck(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def assert_same(df, connection, sql):
    names = sorted(df.columns)
    found = connection.sql(sql)
    assert sorted(found.columns) == names
    at = [found.columns.index(n) for n in names]
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*(f"`{n}`" for n in names)).collect()), key=str)
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=str)
    assert len(got) == len(want)
    assert got == want
