"""Spark result vs DuckDB oracle: same columns, same multiset of rows."""

import math

import duckdb

from tickloom.sources.tables import TABLES


def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, recs):
    out = [tuple(_norm(r[c]) for c in cols) for r in recs]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, fn, sql, sf):
    sdf = fn(spark, sf)
    srecs = [r.asDict(recursive=True) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drecs = [dict(zip(dcols, r)) for r in res.fetchall()]
    assert sorted(dcols) == sorted(sdf.columns)
    cols = sorted(dcols)
    a, b = _rows(cols, srecs), _rows(cols, drecs)
    assert len(a) == len(b)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    assert not bad, bad[:2]
