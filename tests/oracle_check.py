"""Spark and DuckDB results side by side; used by the tests of both folders."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def same(df, con, sql):
    cols = sorted(df.columns)
    mine = _sorted(tuple(_plain(r[c]) for c in cols) for r in df.select(cols).collect())
    c = con.execute(sql)
    names = [d[0] for d in c.description]
    assert sorted(names) == cols
    at = [names.index(k) for k in cols]
    theirs = _sorted(tuple(_plain(r[i]) for i in at) for r in c.fetchall())
    assert mine == theirs
    return len(mine)
