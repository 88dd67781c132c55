import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from evalyard.llm import _text, queries, resampling

from .oracle import SF, same


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def features(text):
    w = words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute(docs, target, buckets=10000, least=20, percent=25):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t = Counter(bucket(f) for x in target for f in features(x))
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (ns + buckets) / ((s[b] + 1.0) * (nt + buckets))))
    rows, pool = [], []
    for k, (i, text) in enumerate(docs):
        g = [gain(bucket(f)) for f in features(text)]
        weight = sum(g) // len(g) if g else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words(text)) >= least:
                pool.append((-score, i, weight, len(g), k))
        rows.append([i, len(g), weight, score, None])
    pool.sort()
    for r, x in enumerate(pool[: percent * len(pool) // 100]):
        rows[x[-1]][-1] = r + 1
    return rows


def test_matches_sql(spark):
    same(queries.QUERIES["op11_resampling"](spark, SF), queries.SQL["op11_resampling"])


@pytest.mark.parametrize("hot", [1000, 3])
def test_edges_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(_text, "HOT", hot)
    long = " ".join(f"w{k % 37} Ünï{k % 11}" for k in range(3000))
    texts = [None, "", " \n", "--- ...", "one", "A b C", "tie tie " * 12, "x" * 5000, long] + [f"word{k % 7} other{k % 5} " * (8 + k % 9) for k in range(40)] + ["hot text of many rows " * 6] * 30
    docs = [(k * 13 % 1009, t) for k, t in enumerate(texts)] + [(5, "again " * 25), (5, "again " * 25), (5, "twice " * 30), (None, long), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id bigint, text string, copies int, digest string")
    target = ["hot text", None, "", "other1 other1 word3"]
    aims = spark.createDataFrame([(str(k), t) for k, t in enumerate(target)], "item_id string, text string")
    got = resampling.resample(df, aims).collect()
    assert sorted(map(repr, brute(docs, target))) == sorted(repr(list(r)) for r in got)
    drawn = resampling.draw(df, aims)
    ids = {r.doc_id for r in got if r.rank}
    assert drawn.columns == df.columns and sorted(r.doc_id for r in drawn.collect()) == sorted(i for i, _ in docs if i in ids)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(1, "a b " * 20)], "doc_id bigint, text string")
    assert resampling.resample(none, some).count() == 0
    assert [tuple(r) for r in resampling.resample(some, none).collect()] == [tuple(r) for r in brute([(1, "a b " * 20)], [])]


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("order", [1, 2, 3])
def test_pieces_change_nothing(monkeypatch, piece, order):
    text = "the quick brown fox " * 20 + "x" * 300 + " end of it"
    w = words(text)
    want = sorted(zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in range(1, order + 1) for i in range(len(w) - k + 1))
    monkeypatch.setattr(resampling, "PIECE", piece)
    n, got = resampling.features(text, order=order)
    assert n == len(w) and sorted(got.tolist()) == want
