import json

import pytest
from pyspark.sql import types as T

from evalyard.sources import readers, writers
from evalyard.streaming import pipeline

SCHEMA = T.StructType([T.StructField("row", T.LongType()), T.StructField("t", T.StringType())])


def test_prefix_and_lenient_scans(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"row": 1, "t": "x"}\n\n{"row": 2, "t": "y"}\n')
    (tmp_path / "b.jsonl").write_text('{"row": 3, "t": "z"}\n{bad\n{"row": 4, "t": "w"}\n')
    (tmp_path / "c.jsonl").write_text('{"row": 5, "t": "v"}\n')
    path = f"{tmp_path}/*.jsonl"
    assert sorted(tuple(r) for r in readers.read_prefix(spark, path, SCHEMA).collect()) == [(0, 1, "x"), (1, 2, "y"), (2, 3, "z")]
    assert sorted(r.row for r in readers.read_records(spark, path, SCHEMA).collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.row for r in readers.completed_ids(spark, path).collect()) == [1, 2, 3, 4, 5]
    assert readers.count_records(spark, path) == 6


def test_prefix_over_splits_repair_and_unreadable_files(spark, tmp_path, monkeypatch):
    src = tmp_path / "src"
    src.mkdir()
    line = '{"row": %d, "t": "x"}\n'
    (src / "a.jsonl").write_text("".join(line % i + "\n" * (i % 3) for i in range(900)))
    (src / "b.jsonl").write_text("".join(line % i for i in range(900, 1200)) + "{bad\n" + line % 7)
    (src / "c.jsonl").write_text(line % 8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert sorted((r.row_index, r.row) for r in readers.read_prefix(spark, f"{src}/*.jsonl", SCHEMA).collect()) == [(i, i) for i in range(1200)]
        assert readers.repair(spark, f"{src}/*.jsonl", SCHEMA, f"{tmp_path}/out") == 1200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.row for r in readers.read_records(spark, f"{tmp_path}/out", SCHEMA).collect()) == list(range(1200))
    assert readers.read_prefix(spark, f"{tmp_path}/out", SCHEMA).count() == 1200
    assert [n.rsplit("/", 1)[1] for n in readers.readable_files(spark, f"{src}/*.jsonl")] == ["a.jsonl", "b.jsonl", "c.jsonl"]
    with pytest.raises(FileNotFoundError):
        readers.count_records(spark, f"{src}/*.none")
    names = readers.unreadable_files(spark, f"{src}/*.jsonl")[0]
    monkeypatch.setattr(readers, "unreadable_files", lambda s, p: (names, names[:1]))
    assert readers.count_records(spark, f"{src}/*.jsonl") == 303
    monkeypatch.setattr(readers, "unreadable_files", lambda s, p: (names, names))
    with pytest.raises(PermissionError):
        readers.count_records(spark, f"{src}/*.jsonl")


def test_csv_results_and_uri(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Model,Overall Acc,Multi-Turn,Rank\nm,50.5%,10%,1\nn,1%,2%,2\n")
    df = readers.read_csv(spark, f"{tmp_path}/r.csv", ["Model"])
    assert sorted(tuple(r) for r in readers.result_scores(df.limit(1)).collect()) == [("bfcl_multi_turn", 0.1), ("bfcl_overall_acc", 0.505)]
    with pytest.raises(ValueError, match="missing"):
        readers.read_csv(spark, f"{tmp_path}/r.csv", ["Nope"])
    from pyspark.sql import functions as F

    u = spark.range(1).select(readers.hub_uri(F.lit("hf://o/r/a/b/f.jsonl@v1")).alias("u")).first().u
    assert tuple(u) == ("o/r", "f.jsonl", "a/b", "v1")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(150)], "row int, t string")
    writers.write_full_and_small(df, f"{tmp_path}/full", f"{tmp_path}/small")
    assert spark.read.json(f"{tmp_path}/full").count() == 150 and spark.read.json(f"{tmp_path}/small").count() == 100
    with pytest.raises(Exception, match="already exists"):
        writers.write_dataset(df, f"{tmp_path}/full")
    writers.append_records(df, f"{tmp_path}/full")
    assert spark.read.json(f"{tmp_path}/full").count() == 300
    scores = spark.createDataFrame([("b", 0.5), ("a", float("nan"))], "name string, value double")
    writers.write_scores(scores, f"{tmp_path}/s.yaml")
    assert (tmp_path / "s.yaml").read_text() == '"a": .nan\n"b": 0.5\n'
    writers.check_manifest(f"{tmp_path}/m", {"b": 1, "a": 2})
    writers.check_manifest(f"{tmp_path}/m", {"a": 2, "b": 1})
    with pytest.raises(ValueError):
        writers.check_manifest(f"{tmp_path}/m", {"a": 3})
    assert writers.canonical_json({"b": 1, "a": "é"}) == '{"a":"é","b":1}\n'


def test_stream_resumes_without_repeats(spark, tmp_path):
    src, out, ck = (str(tmp_path / k) for k in ("src", "out", "ck"))
    (tmp_path / "src").mkdir()
    put = lambda name, ids: (tmp_path / "src" / name).write_text("".join(json.dumps({"row": i, "completion_input": "q" * i, "ground_truth": "A"}) + "\n" for i in ids))
    put("a.json", range(4))
    go = lambda: pipeline.grade_stream(pipeline.watch(spark, src, "row bigint, completion_input string, ground_truth string"), "multiple-choice", 2, out, ck).awaitTermination()
    go()
    put("b.json", range(2, 7))
    go()
    rows = {r.row: r.correct for r in spark.read.json(out).collect()}
    assert spark.read.json(out).count() == 7 and rows[4] == [1, 0] and rows[3] == [0, 1]
    assert pipeline.running_accuracy(spark.read.json(out), "ground_truth").first().n == 14


def test_phase_machine(spark, tmp_path):
    (tmp_path / "in").mkdir()
    ups = [("e", 1, 1), ("e", 2, 2), ("e", 3, 1), ("f", 1, 2), ("f", 2, -1), ("g", 1, 1)]
    (tmp_path / "in" / "a.json").write_text("".join(json.dumps({"event": e, "seq": s, "to": t}) + "\n" for e, s, t in ups))
    got = {}
    stream = pipeline.phases(pipeline.watch(spark, f"{tmp_path}/in", "event string, seq int, to int"))
    pipeline.run_available(stream, lambda df, _: got.update({r.event: (r.phase, r.moves) for r in df.collect()}), f"{tmp_path}/ck")
    assert got == {"e": (2, 2), "f": (-1, 1), "g": (1, 1)}


def test_files_that_are_missing_or_closed(spark, tmp_path, monkeypatch):
    assert readers.completed_ids(spark, str(tmp_path / "none.jsonl")).count() == 0 and not readers.exists(spark, f"{tmp_path}/*.jsonl")
    assert readers.read_prefix(spark, f"{tmp_path}/*.jsonl", SCHEMA).count() == 0
    for name in "ab":
        (tmp_path / f"{name}.jsonl").write_text('{"row": 1, "text": "%s"}\n' % name)
    found = readers.unreadable_files
    monkeypatch.setattr(readers, "unreadable_files", lambda s, p: (found(s, p)[0], [n for n in found(s, p)[0] if n.endswith("a.jsonl")]))
    assert [r.row_index for r in readers.read_prefix(spark, f"{tmp_path}/*.jsonl", SCHEMA).collect()] == [0]
