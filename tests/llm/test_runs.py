import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from evalyard.llm import _text, queries, runs

from .oracle import SF, same


def brute(words, min_length=6, min_exponent=4):
    """All maximal stretches of each period, the smallest period of each only."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= 2 * q:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items() if n >= max(min_length, min_exponent * q))


def collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (6, 3), (9, 2)])
@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_of_random_sequences(letters, limits):
    rng = random.Random(letters)
    texts = []
    for k in range(120):
        text = [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
        if k % 3 == 0 and text:
            p = rng.randint(1, len(text))
            text = [text[i % p] for i in range(rng.randint(0, 4) + len(text))]
        texts.append(text)
    code = np.array([c for t in texts for c in t], np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = [tuple(int(x) for x in r) for r in zip(*runs.find_runs(code, row, len(texts), *limits))]
    assert got == [(d, *r) for d, t in enumerate(texts) for r in brute(t, *limits)]


def test_suffix_ranks_and_extensions():
    rng = random.Random(3)
    seq = np.array([rng.choice([1, 1, 2]) for _ in range(200)] + [0])
    rank = runs.suffix_ranks(seq)
    assert [list(seq[i:]) for i in np.argsort(rank)] == sorted(list(seq[i:]) for i in range(len(seq)))
    i, j = np.array([rng.sample(range(201), 2) for _ in range(500)]).T
    same_for = lambda a, b: next(k for k in range(202) if a + k > 200 or b + k > 200 or seq[a + k] != seq[b + k])
    assert runs.Extensions(seq, rank)(i, j).tolist() == [same_for(a, b) for a, b in zip(i, j)]


@pytest.mark.parametrize("limit", [_text.SLICE_BYTES, 50])
def test_edges_through_spark(spark, monkeypatch, limit):
    monkeypatch.setattr(_text, "SLICE_BYTES", limit)
    texts = [None, "", " \n\t", "a", "A a " * 9, "x\ty\x0bz " * 40, "no repeats in this one", "b " * 5, "b " * 6, "é\xa0é " * 7, "a b a b a b a b a c a c a c a c", " ".join(f"w{k % 50}" for k in range(5000)), "a b " * 30 + "c " * 30]
    rows = [(k, t) for k, t in enumerate(texts)] + [(4, "q r " * 8), (4, "q r " * 8), (None, "n " * 20), (None, None)]
    df = spark.createDataFrame([(i, t, "z", 3) for i, t in rows], "doc_id int, text string, runs string, start int")
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    want = [(i, len(w), [(*r,) for r in brute(w)], collapsed(w, brute(w))) for (i, _), w in zip(rows, words)]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(df, min_exponent=1)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, text in docs:
        w = re.findall("[^\x20\x09-\x0d]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        found = brute(w)
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        text = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(found, key=lambda r: (r[0], r[2])))
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(text), sha(collapsed(w, found))))
    got = [tuple(r) for r in queries.QUERIES["op13_runs"](spark, SF).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and sum(r[1] > 0 for r in want) > 5


def test_matches_sql(spark):
    same(queries.QUERIES["op13_runs"](spark, SF), queries.SQL["op13_runs"])
