"""Compares a registered query with its SQL on the same tables."""

import datetime
import glob
import os

import duckdb

_DUCK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def compare(spark, con, query, sql, sf_dir):
    """None when equal, else a text about the first difference."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    types = {d[0]: _DUCK.get(str(d[1]), str(d[1])) for d in result.description}
    if dict(df.dtypes) != types:
        return f"schema {dict(df.dtypes)} / {types}"
    cols = sorted(types)
    names = [d[0] for d in result.description]
    want = sorted(tuple(_normal(r[names.index(c)]) for c in cols) for r in result.fetchall())
    got = sorted(tuple(_normal(r[c]) for c in cols) for r in df.collect())
    if len(want) != len(got):
        return f"{len(got)} rows, {len(want)} expected"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(want)} rows differ, first {wrong[0]}" if wrong else None
