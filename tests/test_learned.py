"""Models learned from a corpus: languages and sentence boundaries, measured apart from what they learned from."""

import random

import pytest
from pyspark.sql import functions as F

from evalyard.functions import language, sentences
from evalyard.operators import ifeval

from .oracle import SF

SHORT = {"Dr.": "NAME", "Mr.": "NAME", "Mrs.": "NAME", "Prof.": "NAME", "approx.": "nine two", "e.g.": "one two plants", "St.": "near in", "Inc.": "in was", "fig.": "one two", "vol.": "one two"}
NAMES = "Smith Jones Brown White Green Elm Acme".split()
COMMON = "plan park plants home late good short full sold over there text talk firm no yes said saw came left stayed nine two one was had the a in near".split()


def prose(rng, n):
    """Sentences of a small language in which every common word may end one."""
    out = []
    for _ in range(n):
        words = [rng.choice(["They", "It", "She", "He", "We", "The", "Did"])]
        for _ in range(rng.randint(3, 8)):
            if rng.random() < 0.15:
                short = rng.choice(list(SHORT))
                words += [*([rng.choice(NAMES)] if short in ("St.", "Inc.") else []), short, rng.choice(NAMES if SHORT[short] == "NAME" else SHORT[short].split())]
            else:
                words.append(rng.choice(COMMON) if rng.random() < 0.9 else rng.choice(NAMES))
        if words[-1].endswith("."):
            words.append("home")
        out.append(" ".join(words) + rng.choice("...!?"))
    return " ".join(out)


#: Hand-marked: | stands where a sentence ends and another begins.
MARKED = [
    "Dr. White saw Mrs. Green.|They spoke.",
    "Mr. Brown works for Acme Inc. in the park.|He is late.",
    "It rained!|Did Prof. Smith come?|He did.",
    "The firm has approx. nine plants, e.g. two near Elm St. and one here.|The rest was sold.",
    "See vol. two, fig. one.|It is short.",
    "J. Jones said so.|We agree.",
    "He waited... then left.|She stayed.",
    "No.|Yes.|They agree.",
    'She said "no."|It was over.',
    "He works for Acme Inc.|They pay well.",
    "One sentence only",
]


def test_boundaries_on_marked_sentences(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(prose(rng, 20),) for _ in range(300)] + [(None,), ("",)], "text string")
    model = sentences.learn(docs)
    assert {"dr", "mr", "mrs", "prof", "inc", "st", "fig", "vol", "approx", "e.g"} <= model.abbreviations and not {"no", "plan", "nine", "home", "park"} & model.abbreviations
    assert {"they", "it", "she"} <= model.starters
    df = spark.createDataFrame([(m.replace("|", " "), m.count("|")) for m in MARKED], "t string, want int")
    got = [(r.t, r.n) for r in df.where(model.ends(F.col("t")) != F.col("want")).select("t", model.ends(F.col("t")).alias("n")).collect()]
    assert not got
    plain = sentences.Boundaries()
    assert df.where(plain.ends(F.col("t")) != F.col("want")).count() >= 5  # nothing learned: abbreviations end sentences
    assert ifeval.follows(ifeval.SENTENCES, F.lit("x"), sentences=model, relation="less than", num_sentences="2") is not None
    flags = df.select(ifeval.follows(ifeval.SENTENCES, F.col("t"), sentences=model, relation="at least", num_sentences="2").alias("f"), "want").collect()
    assert all(r.f == (r.want >= 1) for r in flags)
    assert sentences.learn(docs.limit(0)) == plain


def pieces(text, n):
    """Stretches of some n words."""
    w = (text or "").split()
    return [" ".join(w[i : i + n]) for i in range(0, len(w) - n + 1, n)]


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    model = language.learn(docs.where("doc_id % 5 <> 0"))
    held = [(r.text, r.lang) for r in docs.where("doc_id % 5 = 0 and text is not null and lang is not null").collect()]
    rng = random.Random(2)
    for n, least in ((None, 0.97), (40, 0.97), (12, 0.95)):
        cases = [(t, lang) for text, lang in held for t in ([text] if n is None else pieces(text, n)[:3])]
        cases = [(t.upper() if rng.random() < 0.3 else t, lang) for t, lang in cases]
        df = spark.createDataFrame(cases, "t string, lang string").select("lang", model.of(F.col("t")).alias("got"), model.of(F.col("t"), 0.0).alias("any"))
        rows = df.collect()
        decided = [r for r in rows if r.got is not None]
        print(n, len(rows), sum(r.any == r.lang for r in rows) / len(rows), len(decided) / len(rows), sum(r.got == r.lang for r in decided) / len(decided))
        assert sum(r.any == r.lang for r in rows) / len(rows) >= least
        assert len(decided) / len(rows) >= 0.9 and sum(r.got == r.lang for r in decided) / len(decided) >= least
    odd = spark.createDataFrame([(None,), ("",), (" 12, 13!",)], "t string")
    assert [r[0] for r in odd.select(model.of(F.col("t"))).collect()] == [None] * 3
    assert language.learn(docs.limit(0)).detect(["a text"]) == [None]


def test_language_rules(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    model = language.learn(docs)
    text = {r.lang: r.t for r in docs.where("length(text) between 300 and 900").groupBy("lang").agg(F.max_by("text", "doc_id").alias("t")).collect()}
    other = next(k for k in text if k != "en")
    rules = [("language:response_language", {"language": other}), ("change_case:english_capital", {}), ("change_case:english_lowercase", {})]
    cases = [(text[other], [True, False, False]), (text["en"], [False, False, False]), (text["en"].upper(), [False, True, False]), (text["en"].lower(), [False, False, True]), (text[other].lower(), [True, False, False]), (None, [False] * 3), ("12", [False, False, False])]
    df = spark.createDataFrame([(t, [r for r, _ in rules], [a for _, a in rules]) for t, _ in cases], "response string, instruction_ids array<string>, kwargs array<map<string,string>>")
    got = [r.strict for r in ifeval.grade(df, languages=model).collect()]
    assert [g for g in got[:6]] == [w for _, w in cases[:6]] and got[6] == [None, False, False]
    assert ifeval.grade(df).collect()[0].strict == [None, False, False]


def test_language_work_is_bounded(spark):
    """Scoring and learning hold some megabytes beside the texts, and long texts in pieces score as whole ones."""
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(3)
    model = language.Languages(("a", "b"), rng.normal(size=(language.BUCKETS, 2)))
    texts = ["".join(map(chr, rng.integers(97, 123, n))) for n in (0, 1, 900_000, 2_000_000, 5)] + ["é" * 400_000, None]
    tracemalloc.start()
    got = model.detect(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    for t, g in zip(texts, got):
        raw = np.frombuffer(b" %s " % (t or "").encode(), np.uint8).astype(np.int64)
        total = model.weights[(raw[:-2] * 65536 + raw[1:-1] * 256 + raw[2:]) % language.BUCKETS].sum(axis=0) / language.OVERLAP
        assert g is None if not t else (g[0] == "ab"[total.argmax()] and g[1] == pytest.approx(1 / np.exp(total - total.max()).sum()))
    docs = spark.createDataFrame([("ab" * 700_000, "x"), ("cd", "y"), (None, "x"), ("", None)], "text string, lang string")
    counts = language.learn(docs)
    want = np.full(language.BUCKETS, language.SMOOTH)
    for g, n in ((" ab", 1), ("aba", 699_999), ("bab", 699_999), ("ab ", 1)):
        want[int.from_bytes(g.encode()) % language.BUCKETS] += n
    assert counts.names == ("x", "y") and np.allclose(counts.weights[:, 0], np.log(want / want.sum()))
