"""Graders by name: rows, their own scores, entry points, budgets, raw responses."""

import importlib.metadata
import json
import math

import pytest
from pyspark.sql import functions as F

from evalyard import cli, configs
from evalyard.operators import choice, graders


def scores(df, name, **options):
    return {r.name: r.value for r in graders.score(df, name, graders.Options(**options)).collect()}


def test_instructions_by_name_through_the_command_line(spark, tmp_path):
    task = tmp_path / "t.yaml"
    task.write_text("name: t\ndata_path: x\ngrader: ifeval\n")
    rows = [
        {"row": 0, "generations": ["one two three four five"], "instruction_id_list": ["punctuation:no_comma", "length_constraints:number_words"], "kwargs": [{}, {"relation": "at least", "num_words": 5}]},
        {"row": 1, "generations": ["one, two"], "instruction_id_list": ["punctuation:no_comma", "length_constraints:number_words"], "kwargs": [{}, {"relation": "less than", "num_words": 5}]},
        {"row": 2, "generations": [""], "error": "no reply", "instruction_id_list": ["punctuation:no_comma"], "kwargs": [{}]},
    ]
    (tmp_path / "g.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    cli.run(spark, configs.load_task(str(task)), str(tmp_path / "g.jsonl"), str(tmp_path / "grades"), str(tmp_path / "s.yaml"))
    got = {k.strip('"'): float(v) for k, v in (x.rsplit(": ", 1) for x in (tmp_path / "s.yaml").read_text().splitlines())}
    assert got == pytest.approx({"strict_prompt_accuracy": 1 / 3, "loose_prompt_accuracy": 1 / 3, "strict_instruction_accuracy": 3 / 5, "loose_instruction_accuracy": 3 / 5})


def test_choices_by_name_through_the_command_line(spark, tmp_path):
    task = tmp_path / "t.yaml"
    task.write_text("name: t\ndata_path: x\ngrader: multiple_choice_nll\n")
    payload = lambda p, x: {"token_logprobs": [None, x, -9.0], "text_offset": [0, p, p + 2]}
    rows = [{"row": k, "completion_input": "Q:", "scoring_completions": ["A", "B"], "ground_truth": t, "choice_group": g, choice.FULL: [payload(2, -0.5), payload(2, -1.0)], choice.ALONE: [payload(7, -0.25), payload(7, -2.0)]} for k, (t, g) in enumerate([("A", "u"), ("B", "v"), ("A", "u")])]
    (tmp_path / "g.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    cli.run(spark, configs.load_task(str(task)), str(tmp_path / "g.jsonl"), str(tmp_path / "grades"), str(tmp_path / "s.yaml"))
    got = dict(x.rsplit(": ", 1) for x in (tmp_path / "s.yaml").read_text().splitlines())
    assert float(got['"micro_avg/acc"']) == pytest.approx(200 / 3) and float(got['"macro_avg/acc"']) == 50 and float(got['"micro_avg/acc_compl"']) == pytest.approx(100 / 3) and float(got['"micro_avg/nll"']) == 0.5


def test_what_no_rows_give(spark):
    none = spark.createDataFrame([], "correct array<int>, ruler_task string, difficulty string")
    assert all(math.isnan(v) for v in scores(none, "exact-match").values())
    wrong = spark.createDataFrame([([0, 0],), ([0],)], "correct array<int>")
    assert scores(wrong, "exact-match") == {"accuracy (avg over 1)": 0, "accuracy (pass@1)": 0}
    assert all(math.isnan(v) for v in scores(wrong, "humaneval").values())  # a sandbox that never ran gives only zeros
    flags = spark.createDataFrame([], "strict array<boolean>, loose array<boolean>")
    assert len(scores(flags, "if_eval")) == 4 and all(math.isnan(v) for v in scores(flags, "if_eval").values())


def test_groups_in_one_pass(spark):
    df = spark.createDataFrame([([1, 0], "a", 1), ([0, 0], "a", 2), ([1, 1], None, 1)], "correct array<int>, kind string, level int")
    got = scores(df, "math-verify", average_over=(2,), by=("kind", "level"))
    want = {"": 0.5, "a ": 0.25, "unknown ": 1.0, "1 ": 0.75, "2 ": 0.0}
    assert {k: got[f"{k}accuracy (avg over 2)"] for k in want} == want and len(got) == 15


def test_subtasks_domains_and_categories(spark):
    rows = [("env_setup/plan", "B", "B) so"), ("issue_fix/locate", "A", "C) no"), ("deepresearch/openend_plan_en", "A", "A)"), ("deepresearch/summ_ans_en", "red fox", "red fox. ] x"), ("odd", "A", "A)")]
    df = spark.createDataFrame([(d, t, [g], "extract_answer_summ_ans" if "summ" in d else "extract_answer") for d, t, g in rows], "difficulty string, ground_truth string, generations array<string>, extractor string")
    got = scores(graders.grade(df, "aptbench"), "aptbench")
    acc = {k.removesuffix(" accuracy (avg over 1)"): v for k, v in got.items() if k.endswith("(avg over 1)")}
    assert acc == pytest.approx({"overall": 0.6, "SWE": 0.5, "DR": 0.5, "unknown": 1, "EnvSetup": 1, "IssueFix": 0, "Open-ended": 1, "Closed-ended": 0, **{d: float(d in ("env_setup/plan", "deepresearch/openend_plan_en", "odd")) for d, _, _ in rows}})
    assert got["deepresearch/summ_ans_en rouge-1"] == pytest.approx(100, abs=1e-3)


def test_token_budgets(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    late = "word " * 200 + "needle"
    df = spark.createDataFrame([("niah_single_1", ["needle"], [late]), ("niah_single_1", ["needle"], ["needle " + late]), ("ruler_qa_squad", ["needle"], [late]), ("ruler_vt", ["needle"], ["word " * 40 + "needle"])], "ruler_task string, ground_truth array<string>, generations array<string>")
    assert [r.correct for r in graders.grade(df, "ruler").collect()] == [[1]] * 4
    assert [r.correct for r in graders.grade(graders.within_budgets(df, path), "ruler").collect()] == [[0], [1], [1], [0]]
    got = scores(graders.grade(df, "ruler"), "ruler")
    assert got["accuracy/niah_single_1"] == 1 and got["accuracy (pass@1)"] == 1


def test_entry_points(monkeypatch):
    def load_points(group):
        assert group == graders.GROUP
        point = lambda name, value: importlib.metadata.EntryPoint(name, value, group)
        return [point("mine", "tests.test_graders:MINE"), point("lost", "no_such_module:x"), point("ruler", "no_such_module:y")]

    monkeypatch.setattr(graders, "entry_points", load_points)
    monkeypatch.setattr(graders, "_GRADERS", dict(graders._GRADERS))
    monkeypatch.setattr(graders, "_UNAVAILABLE", dict(graders._UNAVAILABLE))
    assert {"mine", "lost", "ruler", "ifeval"} <= set(graders.list_graders())
    assert graders.get_grader("mine") is MINE
    with pytest.raises(RuntimeError, match="no_such_module"):
        graders.get_grader("lost")
    with pytest.raises(KeyError):
        graders.get_grader("nowhere")
    with pytest.raises(ValueError):
        graders.register(MINE, "ruler")


MINE = graders.Grader(lambda df: df.withColumn("correct", F.array(F.lit(1))))


SUFFIXES = [  # payload, count, start, prompt, (total, tokens) or what the problem says
    (([None, -0.5, -0.125], [0, 6, 7], 0), None, 7, "answer: B", (-0.125, 1)),
    (([None, -0.5, -0.125], [0, 6, 7], 0), None, 6, "answer: B", (-0.625, 2)),
    (([None, -1.0, -0.25, -7.0], [0, 4, 8, 9], 0), 3, 8, "answer: B", (-0.25, 1)),
    (([None, -1.0, -0.25, -7.0], None, 1), 1, 8, "answer: B", (-0.25, 1)),
    (([None, -1.0, -0.25, -7.0], [], 1), 2, 8, "answer: B", (-1.25, 2)),
    (([None, -1.0], [], 0), None, 8, "answer: B", "neither"),
    (([None, -1.0], None, 0), 3, 8, "answer: B", "fewer"),
    (([None, -1.0], None, 0), 2, 8, "answer: B", "missing"),
    (([None, float("-inf")], None, 0), 1, 8, "answer: B", "finite"),
    (([None, -1.0], [0], 0), 1, 8, "answer: B", "differ"),
    (([None, -1.0], [4, 2], 0), 1, 2, "answer: B", "ordered"),
    (([None, -1.0], [-1, 2], 0), 1, 2, "answer: B", "ordered"),
    (([None, -1.0], [0, 9], 0), 1, 9, "answer: B", "no token"),
    ((None, [0, 9], 0), 1, 9, "answer: B", "no token log"),
    (([None, -1.0], None, 0), 0, 9, "answer: B", "positive"),
]


def test_suffixes_of_payloads(spark):
    df = spark.createDataFrame([(k, *x[:4]) for k, x in enumerate(SUFFIXES)], f"k int, payload {choice.PAYLOAD}, n int, start int, prompt string")
    got = df.orderBy("k").select(choice.suffix_of(F.col("payload"), F.col("n"), F.col("start"), F.col("prompt")).alias("s")).collect()
    for (*_, want), r in zip(SUFFIXES, got):
        assert want in r.s.problem and r.s.total is None if isinstance(want, str) else (r.s.total, r.s.tokens, r.s.problem) == (*want, None)


def test_raw_responses(spark):
    base = spark.createDataFrame([(k, ["Q A", "Q B"]) for k in range(7)], "row int, prompts array<string>")
    good = lambda i, text, done: (i, text, [None, -1.0 - i, -3.0], None, done)
    cases = [
        [good(1, "Q Bx", 1), good(0, "Q A", 1)],
        [good(0, "Q A", 0), good(0, "Q A", 0)],
        [good(0, "Q A", 0)],
        [good(0, "Q A", 0), good(1, "R B", 0)],
        [good(0, "Q Ax", 1), good(1, "Q Bx", 1)],
        [],
        [(0, None, [-1.0], [0], None), (1, None, [-1.0], [0], None), (27, None, [-1.0], [0], None)],
    ]
    raw = spark.createDataFrame([(k, *r) for k, c in enumerate(cases) for r in c], "row int, index int, text string, token_logprobs array<double>, text_offset array<int>, completion_tokens int")
    got = {r.row: r for r in choice.with_responses(base, raw, "row", "full", "prompts").collect()}
    assert got[0].choice_problem is None and [(x.token_logprobs[1], x.generated_tail_n_tokens) for x in got[0].full] == [(-1.0, 0), (-2.0, 1)]
    assert [got[k].choice_problem is not None for k in range(1, 7)] == [True] * 6 and "echo" in got[3].choice_problem and "count" in got[4].choice_problem and "no responses" in got[5].choice_problem


def test_responses_are_joined_by_shuffle(spark):
    """The gathered arrays grow with the rows, so no size that Spark guesses may bring them to the driver."""
    base = spark.createDataFrame([(k, ["Q A"]) for k in range(3)], "row int, prompts array<string>")
    raw = spark.createDataFrame([(k, 0, "Q A", [-1.0], None, 0) for k in range(3)], "row int, index int, text string, token_logprobs array<double>, text_offset array<int>, completion_tokens int")
    joined = choice.with_responses(base, raw, "row", "full", "prompts")
    assert joined.count() == 3 and joined.where("choice_problem is null").count() == 3
    joined.collect()
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
