import hashlib
import random

import numpy as np
import pytest

from evalyard.llm import _text, queries, repeats

from .oracle import SF, same


def brute(rows, length):
    """rows: (id, text) in document order. For each the removed runs of bytes and the kept bytes."""
    seen, out = set(), []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        runs, at = [], 0
        while (s := gone.find(1, at)) >= 0:
            at = gone.find(0, s) if gone.find(0, s) >= 0 else len(gone)
            runs.append((s, at))
        out.append((i, len(raw), runs, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def run(df, **options):
    return [(r.doc_id, r.n_bytes, [tuple(x) for x in r.removed], bytes(r.kept)) for r in repeats.remove_repeats(df, **options).collect()]


def test_matches_sql(spark):
    same(queries.QUERIES["op12_repeats"](spark, SF), queries.SQL["op12_repeats"])


@pytest.mark.parametrize("length", [3, 6, 13, 40])
def test_refined_pointers(length):
    rng = random.Random(length)
    spans = ["".join(rng.choices("ab", k=rng.randint(1, 4 * length))).encode() for _ in range(30)]
    spans += [spans[0], spans[1] + spans[2], b"\0" * 3 * length]
    size = np.array([len(s) for s in spans])
    left = np.repeat(np.cumsum(size), size) - np.arange(size.sum())
    data = b"".join(spans)
    pointer = repeats.refine(np.frombuffer(data, np.uint8), left, length)
    by_string = {}
    for i, p in enumerate(pointer):
        assert (p < 0) == (left[i] < length)
        if p >= 0:
            by_string.setdefault(data[i : i + length], set()).add(int(p))
    assert all(len(p) == 1 for p in by_string.values()) and len(set.union(*by_string.values())) == len(by_string)


@pytest.mark.parametrize("setting", ["plain", "split", "hot"])
@pytest.mark.parametrize("length", [3, 8, 20])
def test_random_texts_against_brute_force(spark, monkeypatch, length, setting):
    if setting == "split":
        monkeypatch.setattr(repeats, "PIECE", 17)
        monkeypatch.setattr(_text, "SLICE_BYTES", 60)
    if setting == "hot":  # all joins by shuffle, hot keys by broadcast, big buckets string by string
        monkeypatch.setattr(repeats, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(_text, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(_text, "HOT", 20)
        monkeypatch.setattr(repeats, "LIMIT", 2)
    rng = random.Random(length)
    pool = ["".join(rng.choices("abcé ", k=rng.randint(1, 5 * length))) for _ in range(12)]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 4))) for _ in range(60)] + [None, "", "a" * 7 * length, "ab" * 4 * length, "a" * 3 * length] + [pool[0] * 3] * 8
    rng.shuffle(texts)
    rows = [(k * 3, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in reversed(rows)], "doc_id bigint, text string, key int, at string")
    assert sorted(run(df, length=length)) == brute(rows, length)


def test_repeated_null_and_other_ids(spark):
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    rows = [(7, "x" * 9 + "abcdefghijkl"), (7, "abcdefghijkl"), (7, "abcdefghijkl"), (-5, "q abcdefgh q"), (None, "abcdefghijkl" * 2), (None, None), (2**40, "abcdefghij")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, sha(r[1]))), 8)
    assert sorted(map(repr, run(df, length=8))) == sorted(map(repr, want))
    named = spark.createDataFrame([("b", "abcdefgh"), ("a", "abcdefgh"), ("c", "xabcdefg")], "id string, body string")
    assert sorted(run(named, id_col="id", text_col="body", length=8)) == [("a", 8, [], b"abcdefgh"), ("b", 8, [(0, 8)], b""), ("c", 8, [], b"xabcdefg")]
    assert run(df.limit(0)) == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(df, length=2)


def test_shared_passages_and_near_copies(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(n))
    passage, base = prose(60), prose(200)
    rows = [(k, f"{prose(40)} {passage} {prose(40)}") for k in range(20)]
    rows += [(20 + k, base[: 50 * k] + "!" + base[50 * k :]) for k in range(20)] + [(40, passage[:99]), (41, passage[:100]), (42, prose(300) + " " + base)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(run(df)) == brute(rows, 100)
