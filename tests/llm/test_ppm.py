import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evalyard.llm import ppm, queries

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), ""]


def brute(rows, held, order=ppm.ORDER):
    counts, trie = Counter(), ppm.Trie(order)
    for (_, t), h in zip(rows, held):
        if not h:
            counts.update(toks(t))
            data = bytes([ppm.START] * order) + (t or "").encode() + bytes([ppm.END])
            for i in range(order, len(data)):
                trie.update(data[i - order : i], data[i])
    n, v = sum(counts.values()), len(counts)
    out = []
    for (d, t), h in zip(rows, held):
        w = toks(t)
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((d, h, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6), round(ppm.code_length(t, order, trie, learn=False), 6)))
    return out


@pytest.mark.parametrize("head", [1 << 20, 7])
def test_against_brute_force(spark, monkeypatch, tmp_path, head):
    monkeypatch.setattr(ppm, "HEAD_GRAMS", head)
    monkeypatch.setattr(ppm, "HEAD_WORDS", head)
    rng = random.Random(6)
    syl = ["ti", "on", "THE", "é", "漢", "a", "b ", " "]
    texts = [None, "", " ", "new zq%", "x" * 300] + ["".join(rng.choices(syl, k=rng.randint(1, 40))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again")]
    spark.createDataFrame([(*r, 5, 1.0) for r in rows], "doc_id bigint, text string, n bigint, score double").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in queries.QUERIES["op1_ppm"](spark, str(tmp_path)).collect()]
    want = brute(rows, [zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows])
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_probabilities_sum_to_one():
    trie = ppm.Trie(2)
    ppm.code_length("abracadabra", 2, trie)
    for context in (b"ab", b"ra", b"zz", b"\xfe\xfe"):
        assert abs(sum(10 ** trie.cost(context, s) for s in range(256)) - 1) < 1e-9


def test_no_training_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id bigint, text string")
    row = ppm.score_corpus(df, F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (2, 0, 0) and abs(row.score + 3 * math.log10(256)) < 1e-9
    assert ppm.score_corpus(df.limit(0), F.lit(False)).count() == 0


def test_adaptive_learns(spark):
    df = spark.createDataFrame([(1, "ab" * 50), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in ppm.score_adaptive(df).collect()}
    assert got[1] > -40 and abs(got[2] + math.log10(256)) < 1e-9


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, 5000))
    t = ppm.Lookup(keys)
    assert (t.find(keys) == np.arange(len(keys))).all() and (t.find(keys + 1) == -1).all()
    assert len(ppm.Lookup(np.zeros(0, np.int64)).find(keys)) == len(keys)


def test_grams_of_slices():
    arr = pa.array(["zz", "ab", None, "é"])
    row, g = ppm.grams(arr.slice(1, 3), 2)
    want = [b"\xfe\xfea", b"\xfeab", b"ab\xff", b"\xfe\xfe\xff", b"\xfe\xfe\xc3", b"\xfe\xc3\xa9", b"\xc3\xa9\xff"]
    assert row.tolist() == [0, 0, 0, 1, 2, 2, 2] and g.tolist() == [int.from_bytes(w, "big") for w in want]
