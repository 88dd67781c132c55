"""Continuous evaluation: ends of streams, merged sources with a restart, a sink that repeats nothing."""

import json

import pytest
from pyspark.sql import functions as F

from evalyard.operators import graders
from evalyard.streaming import completion, pipeline

GRADED = "event string, row bigint, ts timestamp, num_generations int, correct array<int>"


@pytest.fixture
def store(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    yield completion.with_state_store(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def graded(event, row, minute, ok, wanted=3):
    return {"event": event, "row": row, "ts": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z", "num_generations": wanted, "correct": [ok]}


def test_scores_come_once_at_the_end(store, tmp_path):
    src, got = tmp_path / "src", []

    def go(name, rows):
        put(src, name, rows)
        stream = completion.scores_at_end(pipeline.watch(store, str(src), GRADED), patience_ms=3_600_000)
        pipeline.run_available(stream, lambda df, _: got.extend(map(tuple, df.collect())), f"{tmp_path}/ck")
        out, got[:] = sorted(got), []
        return out

    assert go("a.json", [graded("e", 0, 0, 1), graded("f", 0, 0, 1, 2), graded("g", 0, 0, 1)]) == []
    assert go("b.json", [graded("e", 1, 1, 0), graded("f", 1, 1, 0, 2), graded("f", 1, 1, 0, 2)]) == [("f", True, 2, 2, 0.5)]  # a repeated row counts once
    assert go("c.json", [graded("e", 2, 2, 1), graded("f", 9, 2, 1, 2)]) == [("e", True, 3, 3, 2 / 3)]  # f's late row changes nothing
    assert go("d.json", [graded("z", 0, 300, 1, 5)]) == [("g", False, 1, 3, 1.0)]  # g waited an hour in vain; the others' state is gone
    assert go("e.json", [graded("e", 0, 301, 1), graded("e", 1, 301, 1), graded("e", 2, 301, 1)]) == [("e", True, 3, 3, 1.0)]  # the event runs anew


UPDATES = "id bigint, event string, seq bigint, to int, ts timestamp"


def test_three_sources_with_a_restart(store, tmp_path):
    names, got = ("fs", "jobs", "grading"), []
    update = lambda i, e, seq, to: {"id": i, "event": e, "seq": seq, "to": to, "ts": f"2024-01-01T00:{seq:02d}:00Z"}

    def go():
        sources = {n: pipeline.watch(store, str(tmp_path / n), UPDATES) for n in names}
        stream = completion.phases(completion.merged(sources, {"fs": "1 minute", "jobs": "30 minutes"}))
        pipeline.run_available(stream, lambda df, _: got.extend(map(tuple, df.collect())), f"{tmp_path}/ck")

    put(tmp_path / "fs", "a.json", [update(1, "x", 1, 1), update(2, "y", 1, 1)])
    put(tmp_path / "jobs", "a.json", [update(1, "x", 2, 0), update(1, "x", 2, 0)])
    put(tmp_path / "grading", "a.json", [update(1, "y", 3, 2)])
    go()
    assert sorted(got) == [("x", 1, 1, 2), ("y", 2, 2, 2)]
    got.clear()
    put(tmp_path / "grading", "b.json", [update(2, "x", 4, 2), update(1, "y", 3, 2), update(3, "w", 5, -1)])
    put(tmp_path / "fs", "b.json", [update(1, "x", 1, 1)])
    go()  # after a restart: what was handled isn't handled again
    assert sorted(got) == [("w", -1, 1, 1), ("x", 2, 2, 1)]
    got.clear()
    go()
    assert got == []


ROWS = "row bigint, generations array<string>, ground_truth string"


def test_a_killed_batch_replaces_itself(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", "a.json", [{"row": k, "generations": ["Answer: A"], "ground_truth": None if k == 2 else "AB"[k % 2]} for k in range(4)] + [{"row": 4, "ground_truth": "A"}])
    sink = completion.GradeSink(f"{tmp_path}/out", "multiple-choice")
    assert sink.read(spark) is None
    stream = lambda: pipeline.watch(spark, str(tmp_path / "in"), ROWS)
    commit = completion.GradeSink._commit

    def killed(self, s, batch):
        raise RuntimeError("killed")

    monkeypatch.setattr(completion.GradeSink, "_commit", killed)
    with pytest.raises(Exception, match="killed"):
        completion.grade_continuously(stream(), "multiple-choice", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert sink.read(spark) is None and spark.read.json(f"{tmp_path}/out/batch-*").count() == 5  # written, not committed
    monkeypatch.setattr(completion.GradeSink, "_commit", commit)
    completion.grade_continuously(stream(), "multiple-choice", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    sink(spark.createDataFrame([(9, ["A"], "A")], ROWS), 0)  # a committed batch isn't written again
    put(tmp_path / "in", "b.json", [{"row": 5, "generations": ["Answer: B"], "ground_truth": "B"}])
    completion.grade_continuously(stream(), "multiple-choice", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = {r.row: (r.correct, r.exception) for r in sink.read(spark).collect()}
    assert got == {0: ([1], None), 1: ([0], None), 2: (None, "no ground_truth"), 3: ([0], None), 4: (None, "no generations"), 5: ([1], None)} and sink.read(spark).count() == 6
    scores = {r.name: r.value for r in graders.score(sink.read(spark), "multiple-choice").collect()}
    assert scores["accuracy (avg over 1)"] == 0.5


def test_rows_that_graders_refuse(spark):
    df = spark.createDataFrame([("niah_single_1", ["x"], ["x"]), ("odd", ["x"], ["x"]), (None, ["x"], ["x"])], "ruler_task string, ground_truth array<string>, generations array<string>")
    got = graders.grade_or_report(df, "ruler").collect()
    assert [(r.correct, r.exception) for r in got] == [([1], None), (None, "unknown ruler_task"), (None, "unknown ruler_task")]
    df = spark.createDataFrame([(["no:rule"], [{}]), (["punctuation:no_comma"], []), (["punctuation:no_comma"], [{}])], "instruction_ids array<string>, kwargs array<map<string,string>>").withColumn("generations", F.array(F.lit("a")))
    assert sorted(str(r.exception) for r in graders.grade_or_report(df, "ifeval").collect()) == ["None", "instructions and arguments differ in number", "unknown instruction"]
    assert {r.n for r in spark.range(1).select(completion.wanted_by(F.lit("a"), {"a": 3}).alias("n")).collect()} == {3}
