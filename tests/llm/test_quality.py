import math
import re
import zlib

import numpy as np
import pyarrow as pa

from evalyard.llm import quality, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES["op2_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in got.items())
    held = [(got[d].score, q) for d, q in labels.items() if got[d].held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert len(bad) > 5 and auc > 0.95
    assert np.mean([s >= 0.5 for s in good]) > 0.97


def test_features_edges():
    x = quality.features(pa.array([None, "", "AB ab ab!", "é"]))
    named = [dict(zip(quality.FEATURES, r)) for r in x]
    assert not x[0].any() and not x[1].any()
    assert named[2]["upper"] == 2 / 9 and named[2]["repeat"] == 1 / 3 and named[2]["exclaim"] == 1 / 9
    assert named[3]["high"] == 1.0
    assert quality.features(pa.array([], pa.string())).shape == (0, len(quality.FEATURES))


def plain_features(text):
    """One text at a time, one character and word at a time."""
    text = text or ""
    raw, low = text.encode(), "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    kind = lambda b: next((k for k, chars in quality._CLASS.items() if b in chars), "other")
    kinds = [kind(b) for b in raw]
    size, n = max(1, len(raw)), max(1, len(words))
    out = {"log_bytes": math.log1p(len(raw))} | {k: kinds.count(k) / size for k in quality._CLASS}
    out["word_bytes"] = sum(len(w.encode()) for w in words) / n
    out["distinct"] = len(set(words)) / n
    out["repeat"] = sum(a == b for a, b in zip(words, words[1:])) / n
    out["top_word"] = max((words.count(w) for w in set(words)), default=0) / n
    out["shape_change"] = sum(a != b for a, b in zip(kinds, kinds[1:])) / size
    return [out[f] for f in quality.FEATURES]


def plain_score(model, x):
    def cell(edges, v):
        return sum(e <= v for e in edges)

    total = model.intercept + sum(t[cell(e, v)] for e, t, v in zip(model.edges, model.tables, x))
    total += sum(t[cell(model.pair_edges[a], x[a])][cell(model.pair_edges[b], x[b])] for (a, b), t in zip(model.pairs, model.pair_tables))
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_scores_against_plain_lookups(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.score for r in quality.score(docs, "text", model, ["doc_id"]).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        x = plain_features(t)
        assert np.allclose(x, quality.features(pa.array([t]))[0])
        assert abs(got[d] - plain_score(model, x)) < 1e-9


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.train(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.9
    assert (quality.train(x[:0], y[:0]).score(x[:5]) == 0.5).all()


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "x y", "s"), (3, "dup", "s"), (3, "dup", "s")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id bigint, quality int")
    assert quality.classify(docs, labels).count() == 5
    assert quality.classify(docs, labels.limit(0)).select("predicted").distinct().collect()[0][0] == 1
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality.classify(docs.limit(0), labels).count() == 0
