import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from evalyard.operators import choice, graders, ifeval, judges, metrics, rows
from evalyard.plans import planning


def frame(spark, values, schema):
    return spark.createDataFrame(values, schema)


def test_pass_at_k_and_gates(spark):
    cases = [(10, 3, 5, 0.916667), (4, 4, 2, 1.0), (3, 0, 8, 0.0), (32, 1, 16, 0.5), (5, 2, 0, 0.0)]
    for n, c, k, want in cases:
        assert abs(spark.range(1).select(metrics.pass_at_k(F.lit(n), F.lit(c), k)).first()[0] - want) < 1e-6
    df = frame(spark, [([],), ([],)], "correct array<int>")
    assert all(math.isnan(r.value) for r in metrics.scores(df, [1], [1]).collect())
    assert all(math.isnan(r.value) for r in metrics.scores(df.limit(0), [1], [1]).collect())
    zero = frame(spark, [([0, 0],)], "correct array<int>")
    assert [r.value for r in metrics.scores(zero, [2], [1]).collect()] == [0.0, 0.0, 0.0]
    assert all(math.isnan(r.value) for r in metrics.scores(zero, [2], [1], zero_is_nan=True).collect())


def test_half_sample_std_is_the_limit_of_resampling(spark):
    flags = [[1, 0], [1, 1], [0, 0], [1, 0], [0, 1]]
    got = spark.createDataFrame([(f,) for f in flags], "correct array<int>").agg(metrics.half_sample_std(F.col("correct"), 2)).first()[0]
    means = [sum(sum(f) for f in half) / 4 for half in itertools.combinations(flags, 2)]
    mu = sum(means) / len(means)
    assert abs(got - math.sqrt(sum((m - mu) ** 2 for m in means) / len(means))) < 1e-12


def test_unigram_overlap(spark):
    rows_ = [("a", ["the cat. the dog", "x"], "the cat"), ("a", ["none"], "of it"), ("a", [None], "x"), ("a", [" "], "x"), ("b", [], "x"), ("b", ["x"], None), ("c", ["same same"], "same")]
    got = {r["name"]: r["value"] for r in metrics.unigram_overlap(frame(spark, rows_, "difficulty string, picked array<string>, ground_truth string")).collect()}
    assert got == {"a rouge-1": pytest.approx(100 * 0.8 / 2, abs=1e-4), "c rouge-1": pytest.approx(100, abs=1e-4)}


def test_multiple_choice_fallbacks(spark):
    cases = [("Answer - B", "B"), (r"\boxed{ (C) }", "C"), ("first (A) then (D)", "D"), ("x" * 700 + " E", "E"), ("The answer is A" + " word" * 200, None), ("it is 2", "B"), ("?", "?"), ("", None), (None, None), ("the answer is b", "B")]
    df = frame(spark, [([c for c, _ in cases], "2x")], "generations array<string>, ground_truth string")
    row = graders.grade(df, "multiple-choice").first()
    assert row.picked == [w for _, w in cases]
    assert row.correct == [int(w == "B") for _, w in cases]
    with pytest.raises(Exception, match="differ"):
        graders.grade(frame(spark, [(["a"], ["A", "B"])], "generations array<string>, ground_truth array<string>"), "multiple-choice").collect()


def test_error_and_too_long_rows(spark):
    df = frame(spark, [(["A", "A"], "A", None, False), (["A", "A"], "A", "x", False), (["A", "A"], "A", None, True)], "generations array<string>, ground_truth string, error string, input_too_long boolean")
    assert [r.correct for r in graders.grade(df, "multiple-choice").collect()] == [[1, 1], [0], [0, 0]]


def test_registry():
    for name in ("bbh", "ruler", "math_verify", "exact-match"):
        graders.get_grader(name)
    with pytest.raises(RuntimeError, match="algebra"):
        graders.get_grader("sympy_llm_as_judge")
    with pytest.raises(KeyError, match="known"):
        graders.get_grader("nope")


def test_math_numeric(spark):
    cases = [("so x = 1,234.", "1234", 1), (r"\boxed{0.5}", r"\frac{1}{2}", 1), ("Answer: 3/4", "3/4", 1), ("1/2", "0.5", 1), ("sqrt(2)", "sqrt(2)", 1), ("5", "6", 0), ("The final answer is $7", "7", 1)]
    df = frame(spark, [([c], t) for c, t, _ in cases], "generations array<string>, ground_truth string")
    assert [r.correct[0] for r in graders.grade(df, "math-verify").collect()] == [w for _, _, w in cases]
    listed = frame(spark, [(["4", "5"], ["5", "6"])], "generations array<string>, ground_truth array<string>")
    row = graders.grade(listed, "math-verify").first()
    assert (row.correct, row.partial_accuracy, row.any_accuracy) == ([0, 1], 0.5, 1.0)


def test_row_numbers_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("k"), F.repeat(F.lit("x"), 40).alias("pad"))
        got = rows.row_numbers(df, ["k"]).agg(F.count("row"), F.count_distinct("row"), F.min("row"), F.max("row")).first()
        assert tuple(got) == (200_000, 200_000, 0, 199_999)
        numbered = rows.row_numbers(df, ["k"])
        w = numbered.orderBy("k").select("row").limit(5).collect()
        assert [r.row for r in w] == [0, 1, 2, 3, 4]
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_arithmetic():
    assert graders.arithmetic("2**3 + 7//2 - -1") == 12
    for bad in ("9**9**9", "1/0", "a+1", "1+", "(" * 300 + "1"):
        assert graders.arithmetic(bad) is None


def test_judges_and_outputs(spark):
    verdict = lambda t: spark.createDataFrame([(t,)], "t string").select(graders.judge_verdict(F.col("t"))).first()[0]
    assert verdict("<think>GRADE: incorrect</think>\nGRADE: CORRECT") is True
    assert verdict('{"grade": "incorrect"}') is False and verdict(" correct. ") is True and verdict("hm") is None


def test_code_runs_and_reasons():
    assert judges.run_verdict(None, []) == "no_output" and judges.run_verdict([], []) == "pass"
    assert judges.same_lines("1.0\nx\n", "1\nx") and not judges.same_lines("1\n2", "1") and not judges.same_lines("a", "b")


def test_choice_pieces(spark):
    one = spark.range(1)
    assert one.select(choice.labels(F.lit(3))).first()[0] == ["A", "B", "C"]
    at = lambda i, t: one.select(choice.truth_index(F.lit(i), F.array(F.lit(t)), F.array(F.lit("A"), F.lit("B")), F.array(F.lit(" x"), F.lit(" y")))).first()[0]
    assert at(None, "B") == 1 and at(0, "B") == 0 and at(None, "y") == 1 and at(None, " y") == 1
    for other in ("C", "1", "0"):  # digits as text are no index
        with pytest.raises(Exception, match="no choice"):
            at(None, other)
    df = frame(spark, [([0, 6, 7], [None, -0.5, -0.125])], "o array<int>, p array<double>")
    got = df.select(choice.suffix_logprob(F.col("o"), F.col("p"), F.lit(7), F.lit(9))).first()[0]
    assert got == -0.125
    with pytest.raises(Exception, match="finite"):
        df.select(choice.suffix_logprob(F.col("o"), F.col("p"), F.lit(0), F.lit(9))).collect()


def test_instruction_grading(spark):
    ids = ["punctuation:no_comma", "length_constraints:number_words"]
    kw = [{}, {"relation": "at least", "num_words": "5"}]
    df = frame(spark, [("one two three four five", ids, kw), ("bad, line\none two three four five six", ids, kw), ("", ids, kw)], "response string, instruction_ids array<string>, kwargs array<map<string,string>>")
    got = ifeval.grade(df)
    assert [(r.strict, r.loose) for r in got.collect()] == [([True, True], [True, True]), ([False, True], [True, True]), ([False, False], [False, False])]
    score = {r["name"]: r["value"] for r in ifeval.accuracy_scores(got).collect()}
    assert score["strict_prompt_accuracy"] == pytest.approx(1 / 3) and score["loose_instruction_accuracy"] == pytest.approx(4 / 6)
    assert {(r.tier, r.id): (r.total, r.correct) for r in ifeval.report(got).collect()}[(0, "punctuation")] == (3, 1)
    assert len(ifeval.list_instructions()) == 25


@pytest.mark.parametrize(
    "rule, args, yes, no",
    [
        ("detectable_format:number_bullet_lists", {"num_bullets": "2"}, "* a\n - b", "* a\n** b **"),
        ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": "2", "nth_paragraph": "2", "first_word": "hi"}, "a\n\n\"Hi, you", "a\n\nho"),
        ("detectable_content:postscript", {"postscript_marker": "P.P.S"}, "x\nP. P.S now", "P.S. x"),
        ("combination:two_responses", {}, "a\n******\nb", "a******a"),
        ("combination:repeat_prompt", {"prompt_to_repeat": "Say  it"}, " say  it then", "no"),
        ("detectable_format:multiple_sections", {"section_spliter": "Section", "num_sections": "2"}, "Section 1 a Section 2 b", "Section a"),
        ("detectable_format:constrained_response", {"options": '["yes", "no"]'}, "well yes", "maybe"),
        ("keywords:forbidden_words", {"forbidden_words": '["cat"]'}, "concat", "a Cat!"),
        ("detectable_format:json_format", {}, '```json\n{"a": 1}\n```', '{"a": 1} x'),
        ("length_constraints:number_paragraphs", {"num_paragraphs": "2"}, "a\n***\nb ***", "a *** *** b"),
        ("detectable_format:title", {}, "<<T>> x", "<< >>"),
        ("startend:quotation", {}, ' "a" ', '"'),
        ("length_constraints:number_sentences", {"relation": "at least", "num_sentences": "2"}, "Dr. J. Roe came. So", "Dr. J. Roe... came."),
        ("change_case:capital_word_frequency", {"capital_relation": "at least", "capital_frequency": "2"}, "IT'S", "WELL-KNOWN"),
    ],
)
def test_instruction_rules(spark, rule, args, yes, no):
    df = frame(spark, [(yes,), (no,)], "t string")
    assert [r[0] for r in df.select(ifeval.follows(rule, F.col("t"), **args)).collect()] == [True, False]


def test_language_rules_leave_scores_to_the_others(spark):
    ids = ["change_case:english_capital", "language:response_language", "punctuation:no_comma"]
    df = frame(spark, [("ABC DE", ids, [{}] * 3), ("abc, d", ids, [{}] * 3), ("", ids, [{}] * 3), (None, ids, [{}] * 3)], "response string, instruction_ids array<string>, kwargs array<map<string,string>>")
    got = ifeval.grade(df)
    assert [r.strict for r in got.collect()] == [[None, None, True], [False, None, False], [False] * 3, [False] * 3]
    score = {r["name"]: r["value"] for r in ifeval.accuracy_scores(got).collect()}
    assert score["strict_prompt_accuracy"] == 0 and score["strict_instruction_accuracy"] == pytest.approx(1 / 9)
    assert {r.id: (r.total, r.correct) for r in ifeval.report(got).collect() if r.tier} == {ids[0]: (3, 0), ids[1]: (2, 0), ids[2]: (4, 1)}
    with pytest.raises(Exception, match="unknown instruction"):
        ifeval.grade(df.withColumn("instruction_ids", F.array(F.lit("no:such")))).collect()


def test_planning(spark):
    groups = frame(spark, [("g", "a", "b"), ("h", "a", "b")], "group_name string, model_tag string, task_tag string")
    models, tasks = frame(spark, [("m", "a")], "model string, model_tag string"), frame(spark, [("t", "b")], "task string, task_tag string")
    with pytest.raises(Exception, match="several groups"):
        planning.group_pairs(groups, models, tasks).collect()
    pairs = planning.group_pairs(groups.limit(1), models, tasks)
    events = planning.new_events(pairs, frame(spark, [("m", "u")], "model string, task string"))
    assert [(r.model, r.task, r.phase) for r in events.collect()] == [("m", "t", 0)]
    assert planning.new_events(pairs, events).count() == 0
    counts = planning.phase_counts(frame(spark, [(0,), (2,), (-1,), (1,)], "phase int")).first()
    assert tuple(counts) == (2, 1, 2)


def test_rows(spark):
    legacy = frame(spark, [("Q?", "A", 5)], "prompt string, label string, k int")
    r = rows.normalise_records(legacy).first()
    assert (r.row, r.completion_input, r.ground_truth, r.chat_input[0].content) == (0, "Q?", "A", "Q?")
    df = frame(spark, [(i, [str(j) for j in range(6)]) for i in range(5)], "row int, options array<string>")
    for r in df.select("row", "options", rows.seeded_shuffle(3)("row", "options").alias("s")).collect():
        want = list(r.options)
        random.Random(3 + r.row).shuffle(want)
        assert r.s == want
    merged = frame(spark, [({"a": 1, "b": 2}, {"b": 3})], "x map<string,int>, y map<string,int>").select(rows.merge_settings(F.col("x"), F.col("y"))).first()[0]
    assert merged == {"a": 1, "b": 3}
    assert rows.new_messages(frame(spark, [(1, 1, ["a"]), (1, 2, ["a", "b", "c"])], "s int, t int, m array<string>"), "s", "t", "m").orderBy("t").collect()[1].new == ["b", "c"]


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().optimizedPlan().toString()


def _asked(spark):
    kwargs = F.expr("array(map('-', '-'), map('relation', 'at least', 'keyword', 'tion', 'frequency', '1'))")
    rows_ = spark.createDataFrame([("nation, one",), ("nation",), (" \n ",), (None,)], "response string")
    return rows_.select("response", F.array(F.lit("punctuation:no_comma"), F.lit("keywords:frequency")).alias("instruction_ids"), kwargs.alias("kwargs"))


def test_strict_scores_make_no_loose_readings(spark):
    """The eight readings of each text, and a Python worker for rules that no row asks for, aren't in the plan."""
    scores = ifeval.accuracy_scores(ifeval.grade(_asked(spark)), ("strict",))
    assert {r["name"]: r["value"] for r in scores.collect()} == {"strict_prompt_accuracy": 0.25, "strict_instruction_accuracy": 3 / 8}
    plan = _plan(scores)
    assert "array_join" not in plan and "ArrowEvalPython" not in plan
    both = {r["name"]: r["value"] for r in ifeval.accuracy_scores(ifeval.grade(_asked(spark))).collect()}
    assert set(both) == {f"{m}_{k}_accuracy" for m in ("strict", "loose") for k in ("prompt", "instruction")} and both["strict_prompt_accuracy"] == 0.25


def test_strict_report_makes_no_loose_readings(spark):
    got = ifeval.report(ifeval.grade(_asked(spark)))
    assert {(r.tier, r.id): (r.total, r.correct) for r in got.collect()} == {(0, "punctuation"): (4, 1), (1, "punctuation:no_comma"): (4, 1), (0, "keywords"): (4, 2), (1, "keywords:frequency"): (4, 2)}
    plan = _plan(got)
    assert "array_join" not in plan and "ArrowEvalPython" not in plan


def test_loose_readings_are_made_once_a_row(spark):
    """Against a plain walk over the eight readings; each is joined from lines in one place of the plan."""
    texts = ["a, b", "a, b\nc", "c\na, b", "a, b\nc nation\nd, e", "*na*tion\nx,\n\n", " \n na,tion 　\n ", "\n\n", "*", "**\n*,*", "one\r\ntwo, three", "nation*", "", None]

    def walk(t):
        if t is None:
            return [False, False]
        r = t.split("\n")
        plain = [t, *("\n".join(x).strip() for x in (r[1:], r[:-1], r[1:-1]))]
        readings = [x for x in (*plain, *(p.replace("*", "") for p in plain)) if x.strip()]
        return [any("," not in x for x in readings), any("nation" in x for x in readings)]

    kwargs = F.expr("array(map('-', '-'), map('relation', 'at least', 'keyword', 'nation', 'frequency', '1'))")
    df = spark.createDataFrame([(t,) for t in texts], "response string")
    graded = ifeval.grade(df.select("response", F.array(F.lit("punctuation:no_comma"), F.lit("keywords:frequency")).alias("instruction_ids"), kwargs.alias("kwargs")))
    assert {r.response: r.loose for r in graded.collect()} == {t: walk(t) for t in texts}
    report = ifeval.report(graded, "loose")
    assert {r.id: r.correct for r in report.collect() if r.tier} == {k: sum(walk(t)[n] for t in texts) for n, k in enumerate(("punctuation:no_comma", "keywords:frequency"))}
    assert _plan(report).count("array_join(") == 3
