"""Numbering in groups, half samples, VARIANT records, result tables, pairs without hot keys."""

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from evalyard.operators import metrics, rows
from evalyard.plans import planning
from evalyard.sources import readers


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_numbers_within_groups(spark, monkeypatch, limit):
    monkeypatch.setattr(rows, "BROADCAST_BYTES", limit)
    rng = random.Random(1)
    data = [(rng.choice(["hot"] * 20 + ["a", "b", None]), k) for k in rng.sample(range(10_000), 3000)]
    df = spark.createDataFrame(data, "g string, k int").repartition(7)
    got = rows.group_numbers(df, "g", ["k"], "nth", "total").collect()
    want = []
    for g in {g for g, _ in data}:
        own = sorted(k for x, k in data if x == g)
        want += [(g, k, i, len(own)) for i, k in enumerate(own)]
    assert sorted(map(repr, want)) == sorted(repr((r.g, r.k, r.nth, r.total)) for r in got)
    assert rows.group_numbers(df.limit(0), "g", ["k"]).count() == 0


def test_one_group_is_numbered_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        _one_group(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _one_group(spark):
    df = spark.range(20_000).select(F.lit("one").alias("g"), "id")
    ranged = df.repartitionByRange("g", "id")
    assert ranged.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    got = rows.group_numbers(df, "g", ["id"])
    assert got.where("nth <> id").count() == 0
    bar = planning.progress_bars(planning.progress(df.withColumn("done", F.col("id") < 15_000), "g", "id", "done"), "g").first().bar
    assert bar == "█" * 15 + " " * 5


def test_stretches_of_small_groups(spark):
    df = spark.createDataFrame([("a", k, k < 2) for k in range(3)] + [("b", k, True) for k in range(7)], "g string, k int, d boolean")
    got = sorted((r.g, r.stretch, r.share) for r in planning.progress(df, "g", "k", "d", 4).collect())
    assert got == [("a", 0, 1.0), ("a", 1, 1.0), ("a", 2, 0.0)] + [("b", k, 1.0) for k in range(4)]
    assert planning.progress_bars(planning.progress(df, "g", "k", "d", 4), "g").where("g = 'a'").first().bar == "██ "
    names = spark.createDataFrame([("short", None), ("a rather long name", "x")], "m string, d string")
    widths = planning.name_widths(names, "m", "d")
    assert tuple(widths.first()) == (18, 10) and planning.listing_names(names, widths, "m", "d").where("d is null").first().label == "short" + " " * 13 + " | " + " " * 10
    assert tuple(planning.name_widths(names.limit(0), "m", "d").first()) == (10, 10)


@pytest.mark.parametrize("block", [4096, 16])
def test_half_samples_of_unequal_rows(spark, monkeypatch, block):
    monkeypatch.setattr(metrics, "BLOCK_ROWS", block)
    rng = random.Random(7)
    data = [[int(rng.random() < 0.3 + 0.5 * (n > 3)) for _ in range(n)] for n in (rng.choice([1, 2, 9]) for _ in range(151))]
    df = spark.createDataFrame([(x,) for x in data], "correct array<int>")
    each = metrics.half_samples(df, replicates=400).collect()
    assert len(each) == 400 and {r.members for r in each} == {75}
    draws = []
    for _ in range(4000):
        part = rng.sample(data, 75)
        draws.append(sum(map(sum, part)) / sum(map(len, part)))
    want = statistics.pstdev(draws)
    got = metrics.half_sample_spread(df).first().value
    assert abs(got - want) < 0.1 * want
    limit = df.agg(metrics.half_sample_std(F.col("correct"), 9).alias("v")).first().v
    assert abs(limit - want) > 0.1 * want  # the closed form is for rows of equal flags
    assert metrics.half_sample_spread(df, seed=0).first().value == got and metrics.half_sample_spread(df, seed=1).first().value != got
    ones = spark.createDataFrame([([1, 0, 1],), ([0, 0, 1],)] * 40, "correct array<int>")
    closed = ones.agg(metrics.half_sample_std(F.col("correct"), 3).alias("v")).first().v
    assert abs(metrics.half_sample_spread(ones, 3).first().value - closed) < 0.1 * closed
    assert metrics.half_sample_spread(ones.limit(1)).first().value == 0 and metrics.half_sample_spread(ones.limit(0)).first().value == 0


def test_records_with_absent_and_null_keys(spark, tmp_path):
    lines = [
        {"row": 9, "completion_input": "c", "chat_input": [{"role": "user", "content": "h"}], "ground_truth": "A"},
        {"prompt": "p", "label": "B"},
        {"prompt": [{"role": "system", "content": None}, {"role": "user", "content": "u"}], "label": ["x", "y"]},
        {"completion_input": "c", "ground_truth": None, "label": "X"},
        {"completion_input": None, "prompt": "p", "label": 0},
        {"chat_input": [{"role": "user", "content": "x"}]},
    ]
    (tmp_path / "a.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines) + "{bad\n\n[1]\n")
    got = sorted(map(tuple, rows.records_of(readers.read_variants(spark, str(tmp_path))).select("row", "completion_input", F.to_json("chat_input"), F.to_json("ground_truth")).collect()))
    said = lambda role, text: json.dumps([{"role": role, "content": text}], separators=(",", ":"))
    assert got == [
        (1, "p", said("user", "p"), '"B"'),
        (2, "u", '[{"role":"system"},{"role":"user","content":"u"}]', '["x","y"]'),
        (3, "c", said("user", "c"), "null"),
        (4, None, said("user", "p"), "0"),
        (5, "x", said("user", "x"), None),
        (6, None, None, None),
        (7, None, None, None),
        (9, "c", said("user", "h"), '"A"'),
    ]


def test_result_tables(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Model,Overall Acc,Multi-Turn,Odd,Rank\nm,50.5%,N/A,x%,1\nn,1%,2%,3%,2\n")
    df = readers.read_csv(spark, f"{tmp_path}/r.csv", ["Model"])
    assert [tuple(r) for r in readers.result_scores(df).collect()] == [("bfcl_overall_acc", 0.505)]
    assert sorted(tuple(r) for r in readers.result_scores(df, order="Model").collect()) == [("bfcl_overall_acc", 0.505)]
    assert readers.result_scores(df.limit(0)).count() == 0
    texts = spark.createDataFrame([("<think>a</think><think>",), (None,), ("</think>",)], "text string")
    assert sorted(map(tuple, readers.tag_fractions(texts, ["<think>", "<none>"]).collect())) == [("bfcl_think_tag_think_frac", 1.0)]
    assert readers.tag_fractions(texts.limit(0), ["<think>"]).count() == 0


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_pairs_without_hot_keys(spark, monkeypatch, limit):
    monkeypatch.setattr(planning, "BROADCAST_BYTES", limit)
    models = spark.createDataFrame([(f"m{k}", t) for k, t in enumerate(["any", "x", "y", None, "X"])], "model string, model_tag string")
    tasks = spark.createDataFrame([(k, t) for k, t in enumerate(["any", "x", "y", "z", "", "x"])], "task int, task_tag string")
    tag = lambda t: "any" if t in (None, "", "any") else t
    want = sorted((m.model, t.task) for m in models.collect() for t in tasks.collect() if "any" in (tag(m.model_tag), tag(t.task_tag)) or tag(m.model_tag) == tag(t.task_tag))
    got = planning.tag_pairs(models, tasks)
    assert sorted((r.model, r.task) for r in got.collect()) == want and got.columns == ["model", "model_tag", "task", "task_tag"]
    assert planning.every_pair(models.union(models), tasks).count() == 30


def test_a_finished_stage_leaves_only_its_result(spark):
    import os

    from evalyard import session

    def make():
        first = session.materialize(spark.range(5), "first")
        return session.materialize(first.where("id > 1"), "second").where("id > 2")

    before = list(session._made)
    out = session.materialize_stage(make, "result")
    new = [p for p in session._made if p not in before]
    assert sorted(r.id for r in out.collect()) == [3, 4] and len(new) == 1
    folder = os.path.dirname(new[0].removeprefix("file:"))
    assert not [n for n in os.listdir(folder) if n.startswith(("first-", "second-"))]
