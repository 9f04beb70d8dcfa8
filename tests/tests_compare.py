"""Comparison of a registered query with its SQL."""

from __future__ import annotations

import math
from pathlib import Path


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, list):
        return tuple(map(plain, v))
    return v


def compare(spark, folder, name, registry):
    import duckdb

    q, sql = registry[name]
    df = q(spark, folder)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=repr)
    if sql is None:
        assert got and all(len(r) == len(cols) for r in got)
        return
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
