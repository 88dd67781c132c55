import json

import pytest

from evalyard import cli, configs


def test_score_and_resume(spark, tmp_path):
    task = tmp_path / "t.yaml"
    task.write_text("name: t\ndata_path: x\ngrader: multiple-choice\nparser: mc_answer\nnum_generations: 2\naverage_over: [2]\npass_at: [1, 2]\nby: [kind]\n")
    gens = tmp_path / "g.jsonl"
    line = lambda i, a, k: json.dumps({"row": i, "generations": [f"Answer: {x}" for x in a], "ground_truth": "A", "kind": k}) + "\n"
    gens.write_text(line(0, "AB", "u") + line(1, "AA", "v"))
    go = lambda: cli.run(spark, configs.load_task(str(task)), str(gens), str(tmp_path / "grades"), str(tmp_path / "s.yaml"))
    go()
    gens.write_text(gens.read_text() + line(2, "BB", "u"))
    go()
    assert spark.read.json(str(tmp_path / "grades")).count() == 3
    got = dict(x.rsplit(": ", 1) for x in (tmp_path / "s.yaml").read_text().splitlines())
    assert float(got['"accuracy (avg over 2)"']) == 0.5 and float(got['"v accuracy (pass@1)"']) == 1.0 and float(got['"u accuracy (pass@2)"']) == 0.5


def test_check(tmp_path, capsys):
    bad = tmp_path / "b.yaml"
    bad.write_text("name: t\ngrader: nope\npass_at: [3]\nodd: 1\n")
    assert cli.main(["check", str(bad)]) == 1
    said = capsys.readouterr().err
    assert "missing data_path" in said and "unknown grader" in said and "pass_at" in said and "unknown key odd" in said
    with pytest.raises(ValueError):
        configs.load_task(str(bad))


def test_describe(spark, tmp_path):
    import yaml

    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "a.jsonl").write_text('{"row": 1}\n\n{"row": 2}\n')
    out = tmp_path / "c.yaml"
    assert cli.main(["describe", str(tmp_path / "data"), "näme", "ifeval", str(out), "--average-over", "1", "4"]) == 0
    got = yaml.safe_load(out.read_text())
    assert list(got)[1:] == ["grader", "average_over", "pass_at", "dataset_name", "data_path", "semantic_version", "num_generations"]
    assert got["num_generations"] == 2 and got["average_over"] == [1, 4] and got["dataset_name"] == "näme" and got["data_path"].endswith("/data/*.jsonl")
    with pytest.raises(FileNotFoundError):
        configs.describe_dataset(spark, str(tmp_path / "none"), "x", "ifeval", [1], [1])
