import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evalyard.llm import components as link_components
from evalyard.llm import ngram_join, queries
from evalyard.llm.components import components

from .oracle import SF, same

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_matches_sql(spark):
    same(queries.QUERIES["op4_ngram_join"](spark, SF), queries.SQL["op4_ngram_join"])


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: (len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)}


def test_brute_force_near_copies_and_edges(spark):
    rng = random.Random(5)
    texts = [None, "", " \n", "one", "One", "a b c", "a b  C", "a b d", "a\xa0b c"]
    for base in range(4):
        words = [rng.choice("abcdefghij") * rng.randint(1, 6) + str(rng.randint(0, 99)) for _ in range(rng.choice([8, 60, 150]))]
        for _ in range(40):
            w = list(words)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(["zz", "qq%d" % rng.randint(0, 999)])
            texts.append(" ".join(w))
    passage = " ".join(f"p{i}" for i in range(55))
    texts += [f"{passage} " + " ".join(f"u{k}x{i}" for i in range(rng.choice([3, 10, 400]))) for k in range(40)]
    texts.append("w " * 4000)
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, n int, token string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got == brute(rows)
    assert any(g[1] != d for d, g in got.items())
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns and kept.count() == len({c for _, c in got.values()})


def pages(n, lines=30, took=22, ordered=False, seed=4):
    """Pages that take some of a few common lines."""
    rng = random.Random(seed)
    common = [" ".join(f"l{k}w{i}" for i in range(8)) for k in range(lines)]
    pick = lambda: rng.sample(common, took)
    return [(k, "\n".join(sorted(pick(), key=common.index) if ordered else pick())) for k in range(n)]


@pytest.mark.parametrize("long, depth", [(0, 1), (0, 2), (0, 4), (5, 3), (10**6, 1)])
def test_long_lists_go_deeper(spark, monkeypatch, long, depth):
    monkeypatch.setattr(ngram_join, "LONG", long)
    monkeypatch.setattr(ngram_join, "DEPTH", depth)
    monkeypatch.setattr(ngram_join, "PAYS", 0 if long == 0 else ngram_join.PAYS)
    rng = random.Random(3)
    rows = pages(40) + [(100 + k, t) for k, t in pages(40, 30, 28, True)]
    body = [f"b{i}" for i in range(60)]
    rows += [(200 + k, " ".join(body + [f"t{k % 7}x{i}" for i in range(rng.randint(3, 14))])) for k in range(30)]
    rows += [(300 + k, " ".join(body[rng.randint(0, 9) :] + ["e"] * rng.randint(0, 3))) for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = brute(rows)
    assert got == want and 10 < len({c for _, c in want.values()}) < len(want)


def test_template_pages_without_links(spark):
    shared = [f"s{i}" for i in range(108)]
    rows = [(k, " ".join(shared + [f"u{k}x{i}" for i in range(15)])) for k in range(600)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k for k, _ in rows}


def test_empty(spark):
    assert ngram_join.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9)), st.dictionaries(st.integers(0, 60), st.integers(1, 9)), st.integers(0, 20), st.integers(0, 20))
def test_linked_by_weights(a, b, own_a, own_b):
    b = {k: a.get(k, w) for k, w in b.items()}  # a token weighs the same everywhere
    side = lambda x, own: (sum(x.values()) + own, np.array(sorted(x, key=lambda k: (k * 7 % 61, k)), np.int64), np.array([x[k] for k in sorted(x, key=lambda k: (k * 7 % 61, k))], np.int64))
    shared = sum(w for k, w in a.items() if k in b)
    union = sum(a.values()) + own_a + sum(b.values()) + own_b - shared
    assert ngram_join.linked(*side(a, own_a), *side(b, own_b)) == (shared > 0 and 100 * shared >= 80 * union)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
def test_suffix_bound_never_exceeds_the_difference(a, b):
    x, y = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    bound = ngram_join.hamming_bound(x, y, 10)
    assert bound <= len(a ^ b)


@pytest.mark.parametrize("small", [0, 1 << 17])
def test_components_of_a_path_and_a_star(spark, monkeypatch, small):
    monkeypatch.setattr(link_components, "SMALL", small)
    edges = [(i, i + 1) for i in range(100, 130)] + [(5, k) for k in range(200, 230)] + [(7, 7)]
    rng = random.Random(2)
    rng.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame([e[:: rng.choice([1, -1])] for e in edges], "a bigint, b bigint")).collect()))
    assert got == {i: 100 for i in range(100, 131)} | {k: 5 for k in (5, *range(200, 230))}


def test_one_of_each_with_repeated_rows_and_null_ids(spark):
    base = [f"w{i}" for i in range(80)]
    near = " ".join([*base[:-1], "zz"])
    text = " ".join(base)
    rows = [(5, text), (5, text), (9, near), (None, near), (7, "one two"), (7, "one two"), (7, "three"), (None, "n n"), (None, "n n"), (2, ""), (2, None), (4, " "), (None, ""), (None, "")]
    df = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id bigint, text string, gone int")
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(repr((r.doc_id, (r.text or "").strip())) for r in kept.collect())
    assert got == sorted(map(repr, [(5, text), (7, "one two"), (7, "three"), (None, "n n"), (2, ""), (4, ""), (None, ""), (None, "")]))
