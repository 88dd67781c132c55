"""Queries that put written cases to parsers and graders; the SQL holds the values that must come out.

Each row of a table takes the case that its key selects, so every case runs over the whole table.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import extract
from .functions.parsers import parse, parse_all, reasoning
from .functions.text import path_pattern
from .operators import choice, datasets, graders, ifeval, judges, rows
from .plans import planning
from .session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def quoted(value) -> str:
    """A DuckDB literal."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int | float):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def picked(values: list, key: str, kind: str) -> str:
    return f"cast([{', '.join(map(quoted, values))}][cast({key} % {len(values)} + 1 as int)] as {kind})"


def literal(value) -> Column:
    if isinstance(value, list):
        return F.array(*map(literal, value)) if value else F.array().cast("array<string>")
    return F.lit(value).cast("string") if value is None else F.lit(value)


def cases(name: str, items: list[tuple], result: Callable[[DataFrame], DataFrame], inputs: list[str], kind: str = "varchar", source: str = "part", key: str = "p_partkey") -> None:
    """Register ``name``: ``items`` are inputs, named by ``inputs``, and the expected ``result`` column."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        at = (F.col(key) % len(items) + 1).cast("int")
        df = table(spark, sf, source).select(key, *[F.element_at(F.array(*[literal(i[k]) for i in items]), at).alias(n) for k, n in enumerate(inputs)])
        return result(df).select(key, "result")

    QUERIES[name] = run
    SQL[name] = f"select {key}, {picked([i[-1] for i in items], key, kind)} as result from {source}"


# --- parsers --------------------------------------------------------------------------------

PARSER_CASES: dict[str, list[tuple[str | None, str | None]]] = {
    "passthrough": [(" a\n", " a\n"), ("", ""), (None, None)],
    "so_the_answer_is": [
        ("the answer is 42.", "42"), ("So THE ANSWER IS (B).\nmore", "(B)"), ("The correct answer is A", ""), ("the answer is \nnext line", None), ("the answer is ", None),
        ("nothing", None), ("the answer is 1. the answer is 2.", "1. the answer is 2"), ("the answer is\tx.", None), ("", None), (None, None), ("the answer is é\u2028z", "é\u2028"),
    ],
    "so_the_answer_is_last": [
        ("the answer is (A).\nthe answer is (C).", "(C)"), ("the answer is $1,000. The answer is (B).", "(B)"), ("the answer is (A). Let me see. the answer is (C).\nok", "(C)"),
        ("the answer is A. the answer is ", None), ("the answer is 1. the correct answer is \n2", None), ("THE ANSWER IS yes.", "yes"), ("no", None), (None, None),
    ],
    "answer_tag": [
        ("<answer>42</answer>", "42"), ("x <ANSWER> 7\n</answer> <answer>8</answer>", "7"), ("<answer>a\nb</answer>", "a\nb"), ("<answer>   </answer>", None), ("<answer></answer>", None),
        ("<answer>open", None), ("<answer><answer>x</answer>", "<answer>x"), ("\u00a0<answer>\u00a0é\u00a0</answer>", "é"), ("none", None), ("", None), (None, None),
    ],
    "think_suffix": [
        ("<think>reasoning</think>answer", "answer"), ("</think>  result  ", "result"), ("</THINK>answer", "answer"), ("</think_fast>a</think_faster> b ", "b"), ("x</think> ", None),
        ("\u00a0plain\u00a0", "plain"), ("</think>first</think>last", "last"), ("a</ think>b", "a</ think>b"), (" ", None), ("", None), (None, None),
    ],
    "the_answer_is": [
        ("The answer is: (c) and the answer is D", "c"), ("\nthe answer is D\n", "D"), ("the answer is\n\n[b]", "b"), ("thE answer is：－", None), ("the answer is -: E", "E"),
        ("bathe answer is A", None), ("the answer is 42", None), ("the answer is cat", "c"), ("no", None), ("", None), (None, None),
    ],
    "the_answer_is_last": [("The answer is: (c) and the answer is D", "D"), ("the answer is A\nso the answer is\n(B)", "B"), ("the answer is A. the answer is 7", "A"), ("nothing", None), (None, None)],
    "boxed": [
        (r"a \boxed{1} b \fbox {x{y}z} c", "x{y}z"), (r"\boxed   {5}", "5"), ("\\boxed\n\t{6}", "6"), (r"\BOXED{ 42 }", "42"), (r"a \boxed{1", r"a \boxed{1"), (r"\boxed{\frac{1}{2}} and \boxed{}", ""),
        (r"\boxed 7", None), ("boxed{7}", None), (r"\boxed{{}", r"\boxed{{}"), ("none", None), ("", None), (None, None),
    ],
    "gsm8k_base": [
        ("work\n#### 42\n", "42"), ("**Answer:** 3\nAnswer: 4 ", "4"), ("step **Answer: 42", "42"), ("work **Final Answer:** 42", "42"), (r"so \boxed{42}", "{42}"), ("The answer is ", None),
        ("### 1\nThe answer is 2", "2"), ("42", "42"), ("Answer: 1 ### 2", "2"), ("", None), (None, None),
    ],
    "code-think": [
        ("x</think>```python\na=1\n``` ```python3\nb=2\n```", "b=2\n"), ("```python\nold\n```</THINK>\n```python\nnew\n```", "new\n"), ("```python\nold\n```</think>none", None), ("```python\na\n```", "a\n"),
        ("```\na\n```", None), ("a</think>```python\nb\n```</think>", "b\n"), ("no", None), ("", None), (None, None),
    ],
    "code": [
        ("```python\ndef f():\n  return 1\n\nprint(f())\n```\n```python\nf()\n```", "def f():\n  return 1"), ("```python\nimport os\nx = 1\nclass A:\n  pass\nA()\n```", "import os\nclass A:\n  pass"),
        ("```python\nx = 1\n```", "x = 1\n"), ("```python\nasync def f():\n\n  pass\n\n\n```", "async def f():\n\n  pass"), ("def f(): pass", None), ("", None), (None, None),
    ],
    "code_completion": [
        ("<think>a</think>\n\n```python\nx = 1\n```", "x = 1\n"), ("    return 1\n", "    return 1\n"), ("</think>\n    return 2", "    return 2"), ("```py\ny\n```", "y\n"), ("```\nz\n```", "z\n"),
        ("<think>a\n\n    return 3", "    return 3"), ("a</think>  \n", None), ("", None), (None, None),
    ],
    "mc_answer": [
        ("<think>answer: A</think>\nreason\n**Answer: 3**", "C"), ("Answer: (b)\nlater only option C matters", "B"), ("so option D is correct", "D"), (r"\boxed{E}", "E"), ("<final answer> 2 </final answer>", "B"),
        ("<think>The choice is A</think>", "A"), ("text\nB.", "B"), ("it matches option (C) here\nand more", "C"), ("no choice F", None), ("  ", None), (None, None),
    ],
    "longbench-v2": [("The correct answer is (c)", "C"), ("maybe (b) or (D)", "B"), ("the  correct\nanswer is A, not (B)", "A"), ("(E)", None), ("b", None), ("", None), (None, None)],
    "gpqa_aa_visible_final": [
        ("Explanation: final.\nAnswer: C", "C"), (r"Reasoning. \boxed{B}", "B"), ("mentions Answer: B, but revises it.\nAnswer: A", "A"), ("D. The fourth option is correct.", "D"), ("Reasoning without a final marker", None),
        ("analysis Answer: A\n</ifm|think>\nfinal.\nAnswer: D", "D"), ("analysis Answer: A\n</ifm|think>", None), ("Answer: A</think_faster>I select **b**", "B"), ("I choose option C", "C"), ("The answer is E", "E"),
        ("The correct choice: (J) or so", "J"), ("because\n(D)", "D"), ("xx\n(A) one\n(A) two", "A"), ("xx\n(A) one\n(B) two", "B"), ("first line\nb", "B"), ("Answer: A</think> the answer is cat", None), ("</think> C", "C"), ("", None), (None, None),
    ],
}
PARSER_CASES |= {"hle_aa_choice": PARSER_CASES["gpqa_aa_visible_final"], "the-correct-answer-is": PARSER_CASES["longbench-v2"], "think_tag": PARSER_CASES["think_suffix"], "multiple_choice_answer": PARSER_CASES["mc_answer"], "humaneval": PARSER_CASES["code_completion"]}
for _name, _items in PARSER_CASES.items():

    def _parsed(df: DataFrame, name: str = _name) -> DataFrame:
        """Alone and in an array, which must agree."""
        one, listed = parse(name, "t"), F.element_at(parse_all(name, F.array("t", F.lit("x"))), 1)
        df = df.withColumns({"one": one, "listed": listed})
        return df.withColumn("result", F.when(F.col("one").eqNullSafe(F.col("listed")), F.col("one")).otherwise("alone and listed differ"))

    cases("parse_" + _name.replace("-", "_"), _items, _parsed, ["t"])


# --- graders --------------------------------------------------------------------------------


def first_flag(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: graders.grade(df, name).withColumn("result", F.element_at("correct", 1).cast("int"))


def as_generation(df: DataFrame) -> DataFrame:
    return df.withColumns({"generations": F.array("g"), "parsed_generations": F.array(F.lit(None).cast("string"))})


MATH_CASES = [
    ("The answer is 3/4", "3/4", 1), (r"so \boxed{\frac{3}{4}}", "3/4", 1), (r"\boxed{0.75}", r"\frac{3}{4}", 1), (r"\boxed{2\frac{2}{3}}", "2", 0), (r"\boxed{2\frac{2}{3}}", r"\frac{8}{3}", 1), ("The answer is 3/4", "3", 0),
    ("She walks **18 miles** in all. She then asks 2 friends.", "18", 1), ("so x = 1,234.", "1234", 1), (r"It costs \$70{,}000 in all, the answer is \$70{,}000.", "70000", 1), ("1", "x+1", 0), ("x + 1", "x+1", 1), (r"thus \boxed{x+1}.", "x+1", 1),
    (r"\boxed{\left( 3, \frac{\pi}{2} \right)}", r"(3, \frac{\pi}{2})", 1), ("[2,5)", "[2,5)", 1), ("1200", "2220", 0), ("#### 42", "42", 1), ("Answer: 7 apples, not 9", "7", 1), ("the answer is 5. Check: 5 + 6 = 11", "11", 0),
    ("0.3333333333333333", "1/3", 1), ("0.33", "1/3", 0), (r"\boxed{-\frac12}", "-0.5", 1), ("The total is 12 dollars.", "12", 1), ("First 3, then 4, last 5", "5", 1), ("First 3, then 4, last 5", "4", 0), ("-7", "7", 0), ("no number", "5", 0), ("", "5", 0), (None, "5", 0), (r"\sqrt{51}", r"\sqrt{51}", 1), (r"\boxed{50\%}", "50", 1),
    ("1/0", "5", 0), (r"so \boxed{1}", "1.0", 1),
    ("**Step 2:** Simplify.\nThe total is 7.", "7", 1), ("**Step 1:** add 3 and 4.\n**Step 2:** check.\nSo x = 7", "7", 1), ("**Step 2:** Simplify.\nThe total is 7.", "9", 0), (r"**Step 2:** so \boxed{7} units, 8 left", "8", 0),
]
cases("grade_math", MATH_CASES, lambda df: first_flag("math-verify")(as_generation(df)), ["g", "ground_truth"], "int")

_CHOICES = "Pick one.\nOptions:\n(A) red ball\n(B) blue cube\n(C) It's green\n"
_ONE = "few\nQ: old\nOptions:\n(A) zzz\nA: (A)\n\nQ: " + _CHOICES + "A: Let's think step by step."
_WORDS = "Q: Sort the words. List: pear fig apple\nA: Let's think step by step."
BBH_CASES = [
    ("date_understanding", _ONE, "First (A), so (B).", "(B)", 1), ("snarks", _ONE, "It is the blue cube", "(B)", 1), ("snarks", _ONE, "it's GREEN, its green!", "(C)", 1), ("hyperbaton", _ONE, "Answer: C", "(C)", 1), ("hyperbaton", _ONE, "zzz", "(A)", 0),
    ("ruin_names", _ONE, "nothing here", "(A)", 0), ("penguins_in_a_table", None, "so (D)", "(D)", 1), ("boolean_expressions", "Q: not True\nA:", "not True is False", "False", 1), ("boolean_expressions", "Q: x\nA:", "false", "False", 0),
    ("causal_judgement", "", "No. So yes", "Yes", 1), ("navigate", "", "Noyes", "No", 0), ("formal_fallacies", "", "It is invalid.", "invalid", 1), ("formal_fallacies", "", "It is invalid.", "valid", 0), ("object_counting", "", "3 and 4 make 7.", "7", 1),
    ("multistep_arithmetic_two", "", "it is -15", "-15", 1), ("multistep_arithmetic_two", "", "7 -", "7", 0), ("sports_understanding", "", "That is not plausible.", "no", 1), ("sports_understanding", "", "Not plausible? It is PLAUSIBLE", "yes", 1),
    ("web_of_lies", "", "So Ann tells the truth.", "Yes", 1), ("web_of_lies", "", "Ann does not tell the truth", "No", 1), ("web_of_lies", "", "Ann lies", "No", 0), ("word_sorting", _WORDS, "pear fig: apple fig pear", "apple fig pear", 1),
    ("word_sorting", _WORDS, "apple pear fig", "apple fig pear", 0), ("word_sorting", "Q: none\nA:", "apple", "apple", 0), ("dyck_languages", "Q: < [ [ ]\nA:", "The word is <[[]]> so the rest is ]>.", "] >", 1),
    ("dyck_languages", "", r"] \; ] \; > and then the whole < [ [ ] ] >", "] ] >", 1), ("dyck_languages", "", "[ ( ) ]", ")", 0), ("unknown_task", _ONE, "(A)", "(A)", 0), (None, _ONE, "(A)", "(A)", 0), ("snarks", _ONE, None, "(A)", 0),
]
cases("grade_bbh", BBH_CASES, lambda df: first_flag("bbh")(as_generation(df).withColumn("meta", F.struct(F.col("task").alias("subtask")))), ["task", "completion_input", "g", "ground_truth"], "int")

HLE_CASES = [
    ("some words\nAnswer: A", "A", "multipleChoice", None, 1), ("Answer: Bob", "B", "multipleChoice", None, 1), ("ANSWER:\n c", "C", "multipleChoice", None, 1), ("Answer: (D)", "A", "multipleChoice", None, 1), ("Answer: (D)", "D", "multipleChoice", None, 0),
    ("d", " d ", "multipleChoice", None, 1), ("42", "A", "multipleChoice", None, 0), ("any", "x", "exactMatch", '{"correct": "Yes"}', 1), ("any", "x", "exactMatch", '<think>correct: no</think> text {"correct": "no", "a": 1}', 0),
    ("any", "x", "exactMatch", "reasoning: fine\ncorrect: yes\nconfidence: 9", 1), ("any", "x", "exactMatch", "{broken} Correct: YES", 1), ("any", "x", "exactMatch", "correct: no\ncorrect: yes", 0), ("any", "x", "exactMatch", "", 0), ("any", "x", "exactMatch", None, 0), ("any", "x", "exactMatch", "{} correct: yes", 0),
]
cases("grade_hle", HLE_CASES, lambda df: first_flag("hle")(as_generation(df).withColumn("judge_replies", F.array("reply"))), ["g", "ground_truth", "answer_type", "reply"], "int")
cases(
    "grade_hle_strings",
    [(" Paris \n", "paris", 1), ("PARIS", "Paris", 1), ("Paris, France", "Paris", 0), ("", "x", 0), (None, "x", 0)],
    lambda df: first_flag("hle")(as_generation(df).withColumn("answer_type", F.lit("exactMatch"))),
    ["g", "ground_truth"],
    "int",
)

HLE_AA_CASES = [
    ("analysis Answer: A\n</think>\nAnswer: D", "D", "multipleChoice", None, "1 ok"), ("Answer: D</think>", "D", "multipleChoice", None, "0 ok"), ("g", "x", "exactMatch", "correct: yes", "1 ok"), ("g", "x", "exactMatch", "**correct: no**\n*correct*: yes", "1 ok"),
    ("g", "x", "exactMatch", "correct: yes\n</think>\nwell", "0 failed"), ("g", "x", "exactMatch", 'correct: yes\n<|channel|>final<|message|>{"correct": "no"}', "0 ok"), ("g", "x", "exactMatch", "correct: no assistantfinal correct: yes", "1 ok"),
    ("g", "x", "exactMatch", "[correct_answer]: yes", "1 ok"), ("g", "x", "exactMatch", "[correct_answer]: yes it is", "0 failed"), ("g", "x", "exactMatch", '{"correct": "yes"} then\ncorrect: no', "0 ok"), ("g", "x", "exactMatch", '{"a": {"correct": "YES "}}', "1 ok"), ("g", "x", "exactMatch", None, "0 failed"), ("g", "x", "exactMatch", "incorrect: yes", "0 failed"),
]
cases(
    "grade_hle_aa",
    HLE_AA_CASES,
    lambda df: graders.grade(as_generation(df).withColumn("judge_replies", F.array("reply")), "hle_aa").withColumn("result", F.concat_ws(" ", F.element_at("correct", 1), F.when(F.col("judge_failed"), "failed").otherwise("ok"))),
    ["g", "ground_truth", "answer_type", "reply"],
)

LCR_CASES = [
    ("an answer", False, "", "CORRECT", "judge 1"), ("an answer", False, "", " correct\n", "judge 1"), ("an answer", False, "", "INCORRECT", "judge 0"), ("an answer", False, "", "It is CORRECT", "judge 0"), ("an answer", False, "", None, "judge 0"),
    (" \n", False, "", "CORRECT", "empty_final 0"), (None, False, "", "CORRECT", "empty_final 0"), ("an answer", True, "", "CORRECT", "unclosed_think_tag 0"), ("thought", False, "thought", "CORRECT", "reasoning_substituted_for_empty_final 0"), ("thought", False, "thoughts", "CORRECT", "judge 1"),
]
cases(
    "grade_lcr_aa",
    LCR_CASES,
    lambda df: graders.grade(df.withColumns({"generations": F.array(F.coalesce("g", F.lit(""))), "parsed_generations": F.array("g"), "unclosed": F.array("open"), "reasoning": F.array("thought"), "judge_replies": F.array("reply")}), "lcr_aa").withColumn("result", F.concat_ws(" ", F.element_at("grading_source", 1), F.element_at("correct", 1))),
    ["g", "open", "thought", "reply"],
)
cases(
    "grade_judged",
    [("grade: correct", 1), ("<think>grade: correct</think>\ngrade: incorrect", 0), ('{"grade": "correct"}', 1), (" Correct. ", 1), ("not sure", 0), ("GRADE: INCORRECT", 0), ("", 0), (None, 0)],
    lambda df: graders.grade(df.withColumns({"generations": F.array(F.lit("g")), "judge_replies": F.array("reply")}), "llm_as_judge").withColumn("result", F.element_at("correct", 1).cast("int")),
    ["reply"],
    "int",
)
cases(
    "judge_inputs",
    [("thought</think> end ", "end 0 false"), ("0123456789", "456789 4 false"), ("a</ifm|think>", "No answer 0 true"), ("", "No answer 0 false"), (None, "No answer 0 false"), ("</think>abcdefgh", "cdefgh 2 false")],
    lambda df: df.withColumn("j", judges.judge_input_of(6)("g")).withColumn("result", F.concat_ws(" ", "j.text", "j.omitted", "j.empty_visible")),
    ["g"],
)

# --- runs of generated code -----------------------------------------------------------------

RUN_CASES = [
    ([("1.0\nx\n", 0, False)], [("1\nx", "stdin")], "pass"), ([("1", 0, False), ("2", 0, False)], [("1", "stdin"), ("3", "stdin")], "wrong_answer"), ([("1", 0, True)], [("1", "stdin")], "timeout"), ([("1", 1, False)], [("1", "stdin")], "wrong_answer"),
    ([("1", 0, False)], [("1", "stdin"), ("1", "stdin")], "wrong_answer"), (None, [("1", "stdin")], "no_output"), ([('{"b": 1, "a": [2.0]}', 0, False)], [('{"a": [2], "b": 1}', "functional")], "pass"), ([("nope", 0, False)], [("1", "functional")], "wrong_answer"),
    ([("a b ", 0, False)], [(" a b\n\n", "stdin")], "pass"), ([("a\nb", 0, False)], [("b\na", "stdin")], "wrong_answer"), ([("0x10", 0, False)], [("16", "stdin")], "wrong_answer"), ([("1e3", 0, False)], [("1000", "stdin")], "pass"),
]


def _runs(df: DataFrame) -> DataFrame:
    runs = F.from_json("results", "array<struct<stdout:string,exit_code:int,timeout:boolean>>")
    df = df.withColumns({"generations": F.array(F.lit("code")), "runs": F.array(runs), "tests": F.from_json("checks", "array<struct<output:string,testtype:string>>")})
    graded = graders.grade(df, "lcbv6-daytona")
    agrees = F.element_at("correct", 1) == (F.element_at("verdicts", 1) == "pass").cast("int")
    return graded.withColumn("result", F.when(agrees, F.element_at("verdicts", 1)))


cases(
    "grade_runs",
    [(r and json.dumps([dict(zip(("stdout", "exit_code", "timeout"), x)) for x in r]), json.dumps([dict(zip(("output", "testtype"), x)) for x in t]), want) for r, t, want in RUN_CASES],
    _runs,
    ["results", "checks"],
)

# --- instruction following ------------------------------------------------------------------

_INSTRUCTIONS = [
    ("keywords:existence", {"keywords": '["the", "and"]'}, "The sand", 1), ("keywords:existence", {"keywords": '["the", "and"]'}, "the", 0), ("keywords:frequency", {"relation": "at least", "keyword": "ab", "frequency": "2"}, "abAB", 1), ("keywords:frequency", {"relation": "less than", "keyword": "ab", "frequency": "2"}, "ab ab", 0),
    ("keywords:forbidden_words", {"forbidden_words": '["cat"]'}, "concat", 1), ("keywords:forbidden_words", {"forbidden_words": '["cat"]'}, "a Cat!", 0), ("keywords:letter_frequency", {"let_relation": "at least", "letter": "a", "let_frequency": "3"}, "aAa", 1), ("keywords:letter_frequency", {"let_relation": "less than", "letter": "a", "let_frequency": "3"}, "aAa", 0),
    ("length_constraints:number_words", {"relation": "at least", "num_words": "3"}, "a, b-c", 1), ("length_constraints:number_words", {"relation": "less than", "num_words": "3"}, "a b c", 0), ("length_constraints:number_paragraphs", {"num_paragraphs": "2"}, "a\n***\nb ***", 1), ("length_constraints:number_paragraphs", {"num_paragraphs": "2"}, "a *** *** b", 0),
    ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": "2", "nth_paragraph": "2", "first_word": "hi"}, 'a\n\n"Hi, you', 1), ("length_constraints:nth_paragraph_first_word", {"num_paragraphs": "2", "nth_paragraph": "2", "first_word": "hi"}, "a\n\nho", 0), ("detectable_content:number_placeholders", {"num_placeholders": "2"}, "[a] [b c]", 1), ("detectable_content:number_placeholders", {"num_placeholders": "2"}, "[a [b]", 0),
    ("detectable_content:postscript", {"postscript_marker": "P.P.S"}, "x\nP. P.S now", 1), ("detectable_content:postscript", {"postscript_marker": "P.P.S"}, "P.S. x", 0), ("detectable_format:number_bullet_lists", {"num_bullets": "2"}, "* a\n - b", 1), ("detectable_format:number_bullet_lists", {"num_bullets": "2"}, "* a\n** b **", 0),
    ("detectable_format:constrained_response", {"options": '["yes", "no"]'}, "well yes", 1), ("detectable_format:constrained_response", {"options": '["yes", "no"]'}, "maybe", 0), ("detectable_format:number_highlighted_sections", {"num_highlights": "2"}, "*a* and *b*", 1), ("detectable_format:number_highlighted_sections", {"num_highlights": "2"}, "*a* * *", 0),
    ("detectable_format:multiple_sections", {"section_spliter": "Section", "num_sections": "2"}, "Section 1 a Section 2 b", 1), ("detectable_format:multiple_sections", {"section_spliter": "Section", "num_sections": "2"}, "Section a", 0), ("detectable_format:json_format", {}, '```json\n{"a": [1, null]}\n```', 1), ("detectable_format:json_format", {}, '{"a": 1} x', 0),
    ("detectable_format:title", {}, "<<T>> x", 1), ("detectable_format:title", {}, "<< >>", 0), ("combination:two_responses", {}, "a\n******\nb", 1), ("combination:two_responses", {}, "a******a", 0), ("combination:repeat_prompt", {"prompt_to_repeat": "Say  it"}, " say  it then", 1), ("combination:repeat_prompt", {"prompt_to_repeat": "Say  it"}, "no", 0),
    ("startend:end_checker", {"end_phrase": "The End"}, 'so "the end" ', 1), ("startend:end_checker", {"end_phrase": "The End"}, "the end!", 0), ("startend:quotation", {}, ' "a" ', 1), ("startend:quotation", {}, '"', 0), 
    ("length_constraints:number_sentences", {"relation": "at least", "num_sentences": "3"}, 'He said "Go." Then Dr. J. Roe left... and came! So', 1), ("length_constraints:number_sentences", {"relation": "less than", "num_sentences": "3"}, "One. Two! Three?", 0), ("length_constraints:number_sentences", {"relation": "less than", "num_sentences": "2"}, " Version 2.0 (e.g. of it) ", 1),
    ("change_case:capital_word_frequency", {"capital_relation": "at least", "capital_frequency": "5"}, "DON'T NATO, (USA) 3D 42 don't", 1), ("change_case:capital_word_frequency", {"capital_relation": "less than", "capital_frequency": "2"}, "WELL-KNOWN as ABC-def GHI.", 0), ("change_case:english_capital", {}, "ALL of it", 0), ("change_case:english_capital", {}, "ALL OF IT", None),
    ("change_case:english_lowercase", {}, "42", 0), ("change_case:english_lowercase", {}, "all of it", None), ("language:response_language", {"language": "en"}, "all of it", None), ("language:response_language", {"language": "en"}, " ", 0), ("punctuation:no_comma", {}, "a b", 1), ("punctuation:no_comma", {}, "a, b", 0), ("punctuation:no_comma", {}, " ", 0),
    ("startend:constrained_start", {"starter": "My answer"}, "Well.\n  My answer is no", 1), ("startend:constrained_start", {"starter": "My answer"}, "So my answer", 0),
    ("detectable_format:rephrase", {"original_message": "a *b* c"}, "a *new words* c", 1), ("detectable_format:rephrase", {"original_message": "a *b* c"}, "a *b* d", 0), ("detectable_format:rephrase", {"original_message": "a *b* c"}, "a b c", 0),
    ("detectable_content:rephrase_paragraph", {"original_paragraph": "The cat, the dog; a cat", "low": "3", "high": "4"}, "the CAT the cat sat", 1), ("detectable_content:rephrase_paragraph", {"original_paragraph": "The cat, the dog; a cat", "low": "3", "high": "4"}, "the the the dog", 1),
    ("detectable_content:rephrase_paragraph", {"original_paragraph": "The cat, the dog; a cat", "low": "3", "high": "4"}, "the the the", 0), ("detectable_content:rephrase_paragraph", {"original_paragraph": "The cat, the dog; a cat", "low": "3", "high": "4"}, "a cat, the cat, the dog", 0),
    ("keywords:key_sentences", {"key_sentences": '["It rains.", "We go!"]', "num_sentences": "2"}, "We go! Now. It rains. Yes.", 1), ("keywords:key_sentences", {"key_sentences": '["It rains.", "We go!"]', "num_sentences": "2"}, "We go! So it rains.", 0), ("keywords:key_sentences", {"key_sentences": '["It rains."]', "num_sentences": "0"}, "It rains here.", 1),
]


def _instructions(df: DataFrame) -> DataFrame:
    """Each case's rule through ``grade``, one instruction a row."""
    args = F.from_json("args", "map<string,string>")
    graded = ifeval.grade(df.withColumns({"instruction_ids": F.array("rule"), "kwargs": F.array(args)}))
    return graded.withColumn("result", F.element_at("strict", 1).cast("int"))


cases("grade_instructions", [(r, json.dumps(a), t, w) for r, a, t, w in _INSTRUCTIONS], _instructions, ["rule", "args", "response"], "int", "customer", "c_custkey")
cases(
    "grade_loose",
    [("intro, here\nclean\nbye, now", "0 1"), ("intro, here\nclean", "0 1"), ("a, b\nc, d\ne, f", "0 0"), ("clean", "1 1"), ("only, line", "0 0"), ("", "0 0")],
    lambda df: ifeval.grade(df.withColumns({"instruction_ids": F.array(F.lit("punctuation:no_comma")), "kwargs": F.expr("array(map('-', '-'))")})).withColumn("result", F.concat_ws(" ", F.element_at("strict", 1).cast("int"), F.element_at("loose", 1).cast("int"))),
    ["response"],
)

# --- extraction and shaping -----------------------------------------------------------------

_part = lambda f: lambda df: df.withColumn("result", f(F.col("t")))
cases(
    "split_tags",
    [("<think>a</think>\n\nb", "a|b"), ("a</think>b</think>c", "a|b</think>c"), ("x<think_fast>a\n</think_fast>b", "a|b"), ("<ifm|think>a</ifm|think>b", "a|b"), ("a</ifm|think_faster>b", "a|b"), ("plain", "|plain"), ("<think>open", "|<think>open"), ("<think></think>a</ifm|think>b", "a|b"), ("x</think>y</ifm|think>z", "x</think>y|z"), ("", "|"), (None, "|")],
    _part(lambda t: F.concat_ws("|", extract.split_think(t)["reasoning"], extract.split_think(t)["answer"])),
    ["t"],
)
cases(
    "reasoning_blocks",
    [("<think>a</think> b <think>c</think>", "a;b <think>c</think>;0;multi"), ("a</think>b", "a;b;0;"), ("<think>a", "a;;0;open"), ("x<tool_call> {1} </tool_call>y", ";xy;1;"), ("x<tool_call>open", ";;1;tool"), ("plain", ";;0;"), ("<THINK x='1'> a </Think>\n b\n", "a;b;0;"), ("a</think>", "a;;0;")],
    _part(lambda t: F.concat_ws(";", F.coalesce(reasoning(t)["reasoning"], F.lit("")), F.coalesce(reasoning(t)["answer"], F.lit("")), F.coalesce(F.size(reasoning(t)["tool_calls"]), F.lit(0)), F.concat(F.when(reasoning(t)["multiple_think_blocks"], "multi").otherwise(""), F.when(reasoning(t)["unclosed_think_tag"], "open").otherwise(""), F.when(reasoning(t)["unclosed_tool_call"], "tool").otherwise("")))),
    ["t"],
)
cases(
    "tool_calls",
    [('<tool_call>{"name": "f", "arguments": {"a": 1}}</tool_call>', 'call_0 f {"a":1}'), ('<tool_call>bad</tool_call><tool_call>\n{"name": "g"}\n</tool_call>', "call_1 g {}"), ('<tool_call>{"arguments": {}}</tool_call>', ""), ("<ifm|tool_call>f\n<ifm|arg_key>a</ifm|arg_key>\n<ifm|arg_type>int</ifm|arg_type><ifm|arg_value>1</ifm|arg_value>\n<ifm|arg_key>b</ifm|arg_key><ifm|arg_value>x \"y</ifm|arg_value></ifm|tool_call>", 'call_ifm_0 f {"a":1,"b":"x \\"y"}'), ("<ifm|tool_call>h</ifm|tool_call>", "call_ifm_0 h {}"), ('<ifm|tool_call>{"name": "j", "arguments": {}}</ifm|tool_call>', "call_ifm_0 j {}"), ("<tool_call>h</tool_call>", ""), ('<tool_call>{"name": "open"', ""), ("none", ""), (None, "")],
    _part(lambda t: F.array_join(F.transform(extract.tool_calls(F.coalesce(t, F.lit(""))), lambda x: F.concat_ws(" ", x["id"], x["name"], x["arguments"])), ";")),
    ["t"],
)
cases("fenced_code", [("a\n```py\nx\n```", "x"), ("```\nx\ny", "x\ny"), ("```c++\n  int a;\n```\n```\nb\n```", "int a;"), ("no fence", ""), ("", "")], _part(extract.fenced_code), ["t"])
cases("function_body", [('def f(a):\n    """Doc."""\n    return 1', "    return 1"), ("def f(a) -> int:\n    return 2", "    return 2"), ("    return 3", "    return 3"), ("def g(a):\n    return 4", "def g(a):\n    return 4")], _part(lambda t: extract.function_body(t, "f")), ["t"])
cases(
    "normal_formulas",
    [("\\text{ yes}", "yes"), ("x = 5", "5"), ("\\dfrac12", "\\frac{1}{2}"), ("3/4", "\\frac{3}{4}"), ("0.5", "\\frac{1}{2}"), (".5", "\\frac{1}{2}"), ("\\sqrt3", "\\sqrt{3}"), ("5\\text{ cm}", "5"), ("90^\\circ", "90"), ("2 \\left( x \\right)", "2(x)"), ("50\\%", "50"), ("\\$7", "7"), ("-3/8", "\\frac{-3}{8}"), ("abc = 5", "abc=5")],
    _part(extract.normal_formula),
    ["t"],
)
cases(
    "plain_values",
    [("\\text{Yes}", "yes"), ("1,234", "1234"), ("5.0", "5"), ("$3 million", "3*10^6"), ("50\\%", "50"), ("90^\\circ", "90"), ("12 meters", "12"), ("3 cm^2", "3"), ("{x}", "x"), ("2 1/2", "2+1/2"), ("\\frac{1}{2}", "1/2"), ("\\sqrt{3}", "sqrt(3)"), ("2\\pi", "2pi"), ("- 4", "-4"), ("1,23", "1,23"), ("3 or 4", "3,4"), ("-7.00000000", "-7"), ("x^2 + Y", "x^2+y"), (None, None)],
    _part(extract.plain_value),
    ["t"],
)
cases(
    "judged_numbers",
    [("7", "7", "No", "math_verify"), ("8", "7", "<think>no</think> Yes.", "llm"), ("8", "7", "Yes</think>No", "none"), ("8", "7", "", "none"), ("8", "7", None, "none")],
    lambda df: graders.grade(df.withColumns({"generations": F.array("g"), "judge_replies": F.array("r")}), "math-verify-llm-as-judge").withColumn("result", F.element_at("grading_diagnostics.per_generation", 1)["method"]),
    ["g", "ground_truth", "r"],
)
cases("equality_inputs", [("short", "short"), ("", "No answer"), (None, "No answer"), ("x" * 200, "x" * 200), ("a" + "b" * 200, "a" + "b" * 200), ("a" * 300 + "b" * 700, "a" * 100 + "b" * 700)], _part(lambda t: judges.equality_input(t)["text"]), ["t"])
cases("path_patterns", [("/a/b.json", 1), ("/a/x/b.json", 1), ("/a/.x/b.json", 0), ("/a/b.jsonl", 0), ("/c/b.json", 0), ("/a/.b.json", 0), ("/a/x/y/b.json", 1), ("/a/bjson", 0)], lambda df: df.withColumn("result", F.rlike("p", F.lit(path_pattern("/a/**/*.json"))).cast("int")), ["p"], "int")
cases("tuple_parts", [("(1, 2]", "1|2"), ("x", "x"), ("[a,b,c]", "a|b|c"), ("(one)", "(one)"), (" ( 1 ,2 ) ", "1|2"), ("1,2", "1,2")], _part(lambda t: F.array_join(extract.tuple_parts(t), "|")), ["t"])
cases("job_names", [("m-1--7", "m-1 7"), ("a--b--c", "a--b c"), ("plain", ""), ("--x", ""), ("", "")], _part(lambda t: F.coalesce(F.concat_ws(" ", extract.job_parts(t)["name"], extract.job_parts(t)["instance"]), F.lit(""))), ["t"])
cases("clean_texts", [("  a ", "a"), ("\u00a0", None), ("", None), (None, None), ("a\n", "a")], _part(rows.clean_text), ["t"])
cases("long_durations", [("1-02:03:04", 93784), ("00:00:10", 10), ("100:00:00", 360000), ("1:2:3", None), ("x", None), ("", None), (None, None)], _part(rows.duration_seconds), ["t"], "bigint")

# A text of digits is matched like other text: it names a label or a completion, never an index.
_TRUTHS = [(None, "B", "AB", 1), (0, "B", "AB", 0), (None, "1", "12", 0), (None, "2", "12", 1), (None, " y", "AB", 1), (None, "y", "AB", 1), (None, "x ", "AB", 0), (1, None, "AB", 1), (None, "A", "AB", 0), (None, " B\n", "AB", 1), (None, "y", "y?", 0)]
cases("truth_indexes", _TRUTHS, lambda df: df.withColumn("result", choice.truth_index(F.col("i").cast("int"), F.array("t"), F.split("l", ""), F.array(F.lit(" x"), F.lit(" y")))), ["i", "t", "l"], "int")
cases("truth_candidates", [("z,B,A", 1), ("A", 0), ("q,x", 0), ("y,A", 1)], lambda df: df.withColumn("result", choice.truth_index(F.lit(None).cast("int"), F.split("t", ","), F.array(F.lit("A"), F.lit("B")), F.array(F.lit(" x"), F.lit(" y")))), ["t"], "int")

cases("token_counts", [('["2", "2.0"]', "2,2"), ("[1, 3.0]", "1,3"), ("[10, 7]", "10,7")], lambda df: df.withColumn("result", F.array_join(choice.token_counts(F.from_json("t", "array<string>"), F.lit(2)).cast("array<string>"), ",")), ["t"])
cases("suffix_starts", [("Q: Answer: A", "A", 10), ("Q: AnswerA", "A", 9), ("Q: B", "A", 99), ("A", "A", 0), ("Q  A", " A", 1), ("", "A", 99)], lambda df: df.withColumn("result", choice.suffix_start(F.col("p"), F.col("c"), F.lit(99))), ["p", "c"], "int")
cases("counted_suffixes", [(2, 0, -3.0), (1, 1, -1.0), (3, 0, -3.5), (2, 1, -1.5), (0, 0, 0.0)], lambda df: df.withColumn("result", choice.counted_suffix_logprob(F.array(*map(F.lit, (-0.5, -1.0, -2.0))), F.col("n"), F.col("tail"))), ["n", "tail"], "double")
cases("offset_suffixes", [(0, 9, -1.75), (7, 9, -0.25), (6, 7, -0.5), (3, 7, -1.5)], lambda df: df.withColumn("result", choice.suffix_logprob(F.array(*map(F.lit, (0, 6, 7))), F.array(*map(F.lit, (-1.0, -0.5, -0.25))), F.col("a"), F.col("b"))), ["a", "b"], "double")
cases("choice_rows", [("choice_scoring", "p", "x", True), ("choice_scoring", None, None, False), ("choice_scoring", None, "x", True), ("chat", "p", "x", False), (None, "p", "x", False)], lambda df: df.withColumn("scoring_completions", F.array(F.lit("A"))).withColumn("result", choice.is_choice_row(df.withColumn("scoring_completions", F.lit(1)))), ["scoring_mode", "scoring_prompt_prefix", "completion_input"], "boolean")
cases("scoring_prompts", [("Answer: ", "A", "Answer: A"), ("x\n", " B", "x  B"), ("", "C", " C"), ("x ", "C ", "x C "), (" x", "\tD", " x \tD")], lambda df: df.withColumn("result", F.element_at(choice.prompts(F.col("p"), F.array("c")), 1)), ["p", "c"])
cases(
    "choice_prompts",
    [("p ", None, None, "p a|p  b|Answer: a|Answer:  b"), ("p", "q \nr", "So: ", "q a|r  b|So: a|So:  b"), (None, "q\nr\n", None, "q a|r  b|Answer: a|Answer:  b")],
    lambda df: df.withColumn("s", choice.scoring_prompts(F.array(F.lit("a"), F.lit(" b")), F.col("p"), F.when(F.col("ps").isNotNull(), F.split(F.regexp_replace("ps", "\n$", ""), "\n")), F.col("cp"))).withColumn("result", F.array_join(F.concat("s.prompts", "s.alone"), "|")),
    ["p", "ps", "cp"],
)
cases("choice_rows_plain", [("choice_scoring", "x", True), ("choice_scoring", None, False), ("chat", "x", False), (None, "x", False)], lambda df: (lambda one: one.withColumn("result", choice.is_choice_row(one)))(df.withColumn("scoring_completions", F.array(F.lit("A")))), ["scoring_mode", "completion_input"], "boolean")
cases("prompt_prefixes", [("q", "p", "p\n\nq"), ("q", "", "q"), ("q", None, "q"), ("", "p", "p\n\n")], lambda df: df.withColumn("result", rows.prefixed(F.col("q"), F.col("p"))), ["q", "p"])
_kv = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
cases("split_parameters", [('{"temperature": "1", "top_k": "5"}', "temperature=1|top_k=5"), ('{"min_p": "0"}', "|min_p=0"), ('{"seed": "1", "n": "2"}', "n=2,seed=1|"), ("{}", "|")], _part(lambda t: F.concat_ws("|", _kv(rows.split_parameters(F.from_json(t, "map<string,string>"))["standard"]), _kv(rows.split_parameters(F.from_json(t, "map<string,string>"))["extra"]))), ["t"])
cases("secret_safe", [('{"api_key": "abc", "name": "m"}', "api_key=ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad,name=m"), ("{}", "")], _part(lambda t: _kv(rows.secret_safe(F.from_json(t, "map<string,string>")))), ["t"])
cases("merged_settings", [('{"a": "1", "b": "2"}', '{"b": "3"}', "a=1,b=3"), ("{}", '{"x": "y"}', "x=y"), ('{"x": "y"}', "{}", "x=y")], lambda df: df.withColumn("result", _kv(rows.merge_settings(F.from_json("a", "map<string,string>"), F.from_json("b", "map<string,string>")))), ["a", "b"])
cases("task_names", [("Social Science & Law (High School)", "ar_social_science_and_law_high_school"), ("__a__", "ar_a"), ("", "ar_"), ("A-B", "ar_a_b")], _part(lambda t: datasets.task_name(t, "ar_")), ["t"])
cases("judged_queries", [("doc\n=== QUESTION ===\nWhy?\n\nAnswer:", "Why?"), ("plain \n", "plain"), ("a\n=== QUESTION ===\nb\n=== QUESTION ===\n c", "c"), ("", "")], _part(datasets.judged_query), ["t"])
cases("descriptions", [('"""\nWrite f.\nassert f(1) == 2\n"""', "Write f."), ("no quotes", "no quotes"), ('"""\nassert x\n"""', "assert x"), ("a\nassert b\nassert c", "a")], _part(datasets.description), ["t"])
cases("source_texts", [(" a [note] b ", "a b"), ("T [title] x", "T. x"), (None, ""), ("[a]", "")], _part(datasets.source_text), ["t"])
cases("choice_targets", [("b", "b"), ("0", "a"), (" 2 ", "1"), ("1", "1")], _part(lambda t: datasets.choice_target(t, F.array(F.lit("a"), F.lit("b"), F.lit("1")))), ["t"])
cases("corrected_letters", [(0, "C", "C"), (0, "3", "D"), (1, None, "B"), (2, "E", "C"), (2, " a ", "C"), (2, "", "C")], lambda df: df.withColumn("result", datasets.corrected_letter(F.col("a").cast("int"), F.col("c"))), ["a", "c"])
cases("normal_tags", [(" Any ", "any"), ("", "any"), (None, "any"), (" x ", "x"), ("anyone", "anyone")], _part(planning.normal_tag), ["t"])
