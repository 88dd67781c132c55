import hashlib
import random
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from evalyard.llm import decontaminate as D
from evalyard.llm import queries

from .oracle import SF, same

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, items, size=13):
    w = WORD.findall((text or "").translate(LOW))
    hit, ids = set(), set()
    for item, t in items:
        v = WORD.findall((t or "").translate(LOW))
        k = min(size, len(v))
        for j in range(len(v) - k + 1) if v else ():
            for i in range(len(w) - k + 1):
                if w[i : i + k] == v[j : j + k]:
                    hit |= set(range(i, i + k))
                    ids.add(item and str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids - {None})).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_matches_sql(spark):
    same(queries.QUERIES["op3_decontaminate"](spark, SF), queries.SQL["op3_decontaminate"])


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_brute_force_and_edges(spark, block_bytes):
    rng = random.Random(3)
    vocab = ["a", "B", "cc", "é", "d-d", "x1", "the"]
    long = " ".join(f"w{i}" for i in range(40))
    items = [(None, "no id cc"), (None, long[40:]), (1, long), (2, "The answer"), (3, None), (4, "..."), (10, "B a"), (2, "the answer"), (7, " ".join(rng.choices(vocab, k=20)))]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 60)))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "!!!"), (103, "x " * 50 + long + " the ANSWER"), (103, long), (None, "the answer"), (None, "b A and more words that nobody knows"), (None, None), (104, (long + " ") * 400), (105, items[-1][1].upper())]
    d = spark.createDataFrame([(i, t, "zz") for i, t in docs], "doc_id bigint, text string, n_words string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = D.contamination(D.find_benchmark(d, b, block_bytes=block_bytes)).collect()
    want = [(i, *brute(t, items)) for i, t in docs]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    kept = D.decontaminate(d.withColumn("found_hits", F.lit(1)).withColumn("c0", F.lit("c")), b, block_bytes=block_bytes)
    assert kept.columns == ["doc_id", "text", "n_words", "found_hits", "c0"]
    assert sorted(map(repr, [(i, t) for i, t in docs if not brute(t, items)[4]])) == sorted(repr(tuple(r)[:2]) for r in kept.collect())


def test_tables_against_plain_search_and_memory():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(300)]
    items = [(str(k % 90), " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 13, 20, 60])))) for k in range(100)]
    searcher = D.Searcher(items)
    for k in range(3):
        parts = [" ".join(rng.choices(words, k=10)), items[k][1][:400], items[-k][1][50:200], " ".join(rng.choices(words, k=30))]
        text = " ".join(parts)
        n, hits, found = searcher.search(text)
        want = brute(text, items)
        assert (n, sum(e - s for s, e in hits), len(found)) == want[:3]
    for n in (12, 17, 160):  # 72 KB, 100 KB, 1 MB
        big = [(str(k), " ".join(rng.choices(words, k=1000))) for k in range(n)]
        tracemalloc.start()
        D.Searcher(big)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 30 * sum(len(t) for _, t in big)


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    b = spark.createDataFrame([], "item_id bigint, text string")
    assert D.contamination(D.find_benchmark(d, b)).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert tuple(D.contamination(D.find_benchmark(one, b)).first())[:4] == (1, 2, 0, 0)
    assert D.decontaminate(one, b).collect() == one.collect()
