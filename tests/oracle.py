"""Spark rows against DuckDB rows, columns by name, rows in any order."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    if isinstance(v, bool):
        return v
    try:
        f = float(v)
    except (TypeError, ValueError):
        return str(v)
    return str(v) if isinstance(v, str) else float(f"{f:.10g}")


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(df, con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want, got = rows(names, cur.fetchall()), rows(df.columns, df.collect())
    assert len(want) == len(got)
    for a, b in zip(want, got):
        assert a == b
    return len(got)
