import hashlib

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from evalyard.llm import quality

from .oracle import SF
from .test_decontaminate import brute as contaminated
from .test_ngram_join import brute as near


def test_stages_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    rows = [r for r in rows if r[0] in good]
    first = {}
    for d, t in sorted(rows):
        first.setdefault(" ".join(__import__("re").split(r"[\x20\x09-\x0D]+", t)), d)
    rows = [r for r in rows if r[0] in set(first.values())]
    groups = near(rows)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not contaminated(r[1], items)[4]]
    ref = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {d: (len(i := ref.encode(t, add_special_tokens=False).ids), sha(",".join(map(str, i))), sha(t)) for d, t in rows}
    got = {r[0]: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 50 < len(got) < docs.count()


def test_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_stages_with_nulls_repeats_and_clashing_columns(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, base), (2, base.replace("w5 ", "zz ")), (None, base), (None, None), (3, None), (4, ""), (5, " \n"), (6, "x " * 3000), (None, "only this")]
    docs = spark.createDataFrame([(d, t, "en", "s", k, "c") for k, (d, t) in enumerate(rows)], "doc_id bigint, text string, lang string, score string, gone int, c0 string")
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).count() == 0
    # chained: each stage on what the one before kept
    left, kept_of = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.columns == docs.columns
        left = spark.createDataFrame(out.collect(), docs.schema)
        kept_of.append({r.gone for r in left.collect()})
    model = quality.fit(docs, labels)
    scores = {r.gone: r.score for r in quality.score(docs.drop("score"), "text", model, ["gone"]).collect()}
    assert kept_of[0] == {k for k, p in scores.items() if p >= 0.5}
    text = {k: t or "" for k, (_, t) in enumerate(rows)}
    blank = {k: " ".join(__import__("re").split(r"[\x20\x09-\x0D]+", t)) for k, t in text.items()}
    assert len(kept_of[1]) == len({blank[k] for k in kept_of[0]}) and {blank[k] for k in kept_of[1]} == {blank[k] for k in kept_of[0]}
    assert kept_of[3] == {k for k in kept_of[2] if not contaminated(text[k], items)[4]}
    # and each on all rows
    planted = spark.createDataFrame([(None, items[0][1], "en", "s", 0, "c"), (1, items[0][1], "en", "s", 1, "c"), (1, None, "en", "s", 2, "c"), (2, base, "en", "s", 3, "c")], docs.schema)
    assert {r.gone for r in corpus_pipeline.drop_contaminated(spark, planted, SF).collect()} == {2, 3}
    assert {r.gone for r in corpus_pipeline.keep_quality(spark, planted, SF).collect()} == {r.gone for r in quality.score(planted.drop("score"), "text", quality.fit(planted, labels), ["gone"]).where("score >= 0.5").collect()}
    kept = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_exact_copies(spark, docs, SF), SF).collect()
    assert sorted(r.gone for r in kept if r.text and r.text.startswith("w0")) in ([0], [1])
    assert sum(not (r.text or "").strip() for r in kept) == 2 and len(kept) == 5
    assert corpus_pipeline.encode(spark, docs, SF).count() == len(rows)
