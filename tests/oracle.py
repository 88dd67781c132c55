"""Compares a Spark result with DuckDB SQL on one folder of tables."""

import math

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def show(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def same(df, sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(tuple(show(r[names.index(c)]) for c in sorted(names)) for r in rel.fetchall())
    got = sorted(tuple(show(r[c]) for c in sorted(names)) for r in df.collect())
    assert got == want
