import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evalyard.functions import parsers as P

CASES = [
    ("passthrough", " a ", " a "),
    ("so_the_answer_is", "So the answer is (B).\nmore", "(B)"),
    ("so_the_answer_is", "The correct answer is A", ""),
    ("so_the_answer_is", "nothing", None),
    ("so_the_answer_is_last", "the answer is 1. the answer is 22.", "22"),
    ("answer_tag", "x <ANSWER> 7\n</answer> <answer>8</answer>", "7"),
    ("answer_tag", "<answer> </answer>", None),
    ("think_suffix", "a</think>b</THINK_fast> c ", "c"),
    ("think_tag", "\u00a0plain\u00a0", "plain"),
    ("think_suffix", "x</think> ", None),
    ("the_answer_is", "The answer is: (c) and the answer is D", "c"),
    ("the_answer_is_last", "The answer is: (c) and the answer is D", "D"),
    ("boxed", r"a \boxed{1} b \fbox {x{y}z} c", "x{y}z"),
    ("boxed", r"a \boxed{1", r"a \boxed{1"),
    ("boxed", "none", None),
    ("gsm8k_base", "#### 42\n", "42"),
    ("gsm8k_base", "**Answer:** 3\nAnswer: 4 ", "4"),
    ("gsm8k_base", "The answer is ", None),
    ("mc_answer", "<think>answer: A</think>\nreason\n**Answer: 3**", "C"),
    ("mc_answer", "Answer: (b)\nlater only option C matters", "B"),
    ("mc_answer", "so option D is correct", "D"),
    ("mc_answer", "  ", None),
    ("code-think", "x</think>```python\na=1\n``` ```python3\nb=2\n```", "b=2\n"),
    ("code-think", "no", None),
    ("code", "```python\ndef f():\n  return 1\n\nprint(f())\n```\n```python\nf()\n```", "def f():\n  return 1"),
    ("code_completion", "<think>a</think>\n\n```python\nx = 1\n```", "x = 1\n"),
    ("longbench-v2", "The correct answer is (c)", "C"),
    ("longbench-v2", "maybe (b) or (D)", "B"),
    ("gpqa_aa_visible_final", "A </think> The answer is B. Final answer: C", "C"),
    ("gpqa_aa_visible_final", "because\n(D)", "D"),
]


def test_cases(spark):
    for name, given_, want in CASES:
        df = spark.createDataFrame([(given_, [given_, None])], "t string, g array<string>")
        row = df.select(P.parse(name, "t").alias("a"), P.parse_all(name, "g").alias("b")).first()
        assert row.a == want, (name, given_, row.a)
        assert row.b == [want, None], (name, row.b)


def test_registry():
    assert len(P.list_parsers()) == 23
    with pytest.raises(KeyError, match="known"):
        P.get_parser("nope")
    with pytest.raises(ValueError):
        P.parser("boxed")(lambda c: c)


def test_reasoning(spark):
    rows = ["<think>a</think> b <think>c</think>", "a</think>b", "<think>a", "x<tool_call> {1} </tool_call>y", "x<tool_call>open", "", None, "plain"]
    df = spark.createDataFrame([(t,) for t in rows], "t string").select(P.reasoning(F.col("t")).alias("r"))
    got = [tuple(r.r) if r.r else None for r in df.collect()]
    assert got == [("a", "b <think>c</think>", None, None, None, True), ("a", "b", None, None, None, None), ("a", None, None, True, None, None), (None, "xy", ["{1}"], None, None, None), (None, None, ["open"], None, True, None), None, None, (None, None, None, None, None, None)]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab{}\\boxed "), max_size=30))
def test_boxed_never_loses_balance(text):
    got = P.boxed_text(text)
    if got is None:
        assert not re.search(r"\\(?:boxed|fbox)\s*\{", text)
    else:
        assert got in text
