"""Compares registered queries with their DuckDB SQL on one folder of tables."""

import math

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels pages conversations embeddings".split()


def rows_of_sql(sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    rel = con.execute(sql)
    return sorted(c[0] for c in rel.description), [c[0] for c in rel.description], rel.fetchall()


def norm(v):
    return float(f"{v:.6g}") if isinstance(v, float) and not math.isnan(v) else v


def same(df, sql, sf=SF):
    names, order, rows = rows_of_sql(sql, sf)
    assert sorted(df.columns) == names
    want = sorted(tuple(repr(norm(r[order.index(n)])) for n in names) for r in rows)
    got = sorted(tuple(repr(norm(r[n])) for n in names) for r in df.collect())
    assert len(want) == len(got)
    bad = [(a, b) for a, b in zip(want, got) if a != b]
    assert not bad, bad[:3]
