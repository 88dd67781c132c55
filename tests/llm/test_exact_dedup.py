import hashlib
import random
import re

import pytest

from evalyard.llm import exact_dedup, queries

from .oracle import SF, same


def test_matches_sql(spark):
    same(queries.QUERIES["op5_exact_dedup"](spark, SF), queries.SQL["op5_exact_dedup"])


@pytest.mark.parametrize("hot", [1000, 3])
def test_small_blocks_and_edges(spark, monkeypatch, hot):
    monkeypatch.setattr(exact_dedup, "HOT", hot)
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab ", k=rng.randint(0, 9))) for _ in range(60)]
    texts += ["", None, " ", "\n\t", "x\ny", "x \x0b y", "x\xa0y", "abcd" * 40, "abcd" * 40, "abcd" * 39, "é" * 33 + "z", "é" * 33 + "y", "é" * 33 + "z"] + ["hot text here"] * 20
    df = spark.createDataFrame([(i * 7 % 1009, t, 0, "q") for i, t in enumerate(texts)], "doc_id bigint, text string, idx int, name string")
    got = {r[0]: tuple(r)[1:] for r in exact_dedup.exact_groups(df, block_bytes=4).collect()}
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i * 7 % 1009)
    want = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert got == want
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {min(g) for g in groups.values()}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.exact_groups(df).count() == 0


def test_no_python_in_plan(spark):
    plan = queries.QUERIES["op5_exact_dedup"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_and_null_ids(spark):
    long = "abcde fgh " * 1000  # three blocks of the standard size
    rows = [(5, "a b"), (5, "a b"), (5, "a  b"), (9, "a b"), (None, "a b"), (7, long), (7, long), (7, "other"), (8, long + "z"), (None, "n"), (None, "n"), (None, long), (None, None), (3, "")]
    df = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id bigint, text string, row_key int")
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    want = []
    for t, own in groups.items():
        keep = min((d for d in own if d is not None), default=None)
        want += [(d, keep, len(own), None if d is None else d == keep, hashlib.sha256(t.encode()).hexdigest()) for d in own]
    for size in (exact_dedup.BLOCK_BYTES, 4):
        got = exact_dedup.exact_groups(df, block_bytes=size).collect()
        assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns
    least = {t: min((d for d in own if d is not None), default=None) for t, own in groups.items()}
    left = [(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r.doc_id) for r in kept.collect()]
    assert sorted(map(repr, left)) == sorted(map(repr, least.items()))
