"""Graders by name: a row plan that judges generations and an aggregate plan that scores the judged rows.

``grade(df, name)`` adds the columns of the named grader's row plan, mostly ``correct array<int>``;
``score(graded, name)`` gives its own scores (name, value), with its own rule for what no rows give.
``unavailable`` names raise with the reason. Inputs that carry ``error`` get ``[0]``, and rows marked
``input_too_long`` one zero per generation, before any grader looks at them. Packages add graders by entry
points of the group ``GROUP``, loaded when a name isn't known here.
"""

from __future__ import annotations

import ast
import operator
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache
from importlib.metadata import entry_points

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import same_answer
from ..functions.parsers import aptbench_choice, aptbench_summary, parse_all
from ..functions.text import digit_to_letter, found, last_found, quoted, regex, strip
from . import choice, ifeval, judges, metrics, subtasks

Rows = Callable[[DataFrame], DataFrame]
GROUP = "evalyard.graders"


@dataclass(frozen=True)
class Options:
    """What a task asks of a score: the counts of generations to average over, those of pass@k, and columns to group by."""

    average_over: tuple[int, ...] = (1,)
    pass_at: tuple[int, ...] = (1,)
    by: tuple[str, ...] = ()


Scores = Callable[[DataFrame, Options], DataFrame]


def accuracy_scores(zero_is_nan: bool = False) -> Scores:
    """The scores of ``correct`` flags; without rows or flags (``zero_is_nan``: or without a correct one) they are NaN."""
    return lambda graded, o: metrics.named_scores(graded, o.average_over, o.pass_at, o.by, zero_is_nan)


def no_truth(df: DataFrame) -> Column:
    """What is missing in a row for most graders."""
    return F.when(F.col("ground_truth").isNull(), "no ground_truth")


@dataclass(frozen=True)
class Grader:
    """``rows`` judges, ``scores`` aggregates what ``rows`` gave; ``flags`` says whether rows have ``correct``.

    ``problem`` says of a row why it can't be judged, null if it can; ``prepare`` gives the columns the types that ``rows`` works on.
    """

    rows: Rows
    scores: Scores = field(default_factory=accuracy_scores)
    flags: bool = True
    problem: Callable[[DataFrame], Column] = no_truth
    prepare: Rows = lambda df: df


_GRADERS: dict[str, Grader] = {}
_UNAVAILABLE: dict[str, str] = {}


def register(grader: Grader, *names: str) -> None:
    for n in names:
        if n in _GRADERS:
            raise ValueError(f"grader {n!r} is already registered")
        _UNAVAILABLE.pop(n, None)
        _GRADERS[n] = grader


def grader(*names: str, **halves):
    def keep(f):
        register(Grader(f, **halves), *names)
        return f

    return keep


def unavailable(reason: str, *names: str) -> None:
    _UNAVAILABLE.update({n: reason for n in names if n not in _GRADERS})


def load_entry_points() -> None:
    """Register the graders that installed packages name; one that can't be loaded is unavailable, with its error."""
    for point in entry_points(group=GROUP):
        if point.name not in _GRADERS:
            try:
                register(point.load(), point.name)
            except ImportError as e:
                unavailable(f"{point.value} can't be imported ({e})", point.name)


def list_graders() -> list[str]:
    load_entry_points()
    return sorted({*_GRADERS, *_UNAVAILABLE})


def get_grader(name: str) -> Grader:
    if name not in _GRADERS:
        load_entry_points()
    if name in _GRADERS:
        return _GRADERS[name]
    if name in _UNAVAILABLE:
        raise RuntimeError(f"grader {name!r} is unavailable: {_UNAVAILABLE[name]}")
    raise KeyError(f"unknown grader {name!r}; known: {', '.join(list_graders())}")


def answers() -> Column:
    """Each parsed answer, or the generation where the parser found none."""
    return F.zip_with("parsed_generations", "generations", lambda p, g: F.coalesce(p, g))


def with_answers(df: DataFrame) -> DataFrame:
    if "answers" in df.columns:
        return df
    return df.withColumn("answers", answers() if "parsed_generations" in df.columns else F.col("generations"))


def grade(df: DataFrame, name: str) -> DataFrame:
    found = get_grader(name)
    df = found.prepare(df)
    out = found.rows(with_answers(df) if "generations" in df.columns else df)
    if not found.flags:
        return out
    special = F.lit(None).cast("array<int>")
    if "input_too_long" in df.columns:
        special = F.when(F.col("input_too_long"), F.transform("generations", lambda g: F.lit(0)))
    if "error" in df.columns:
        special = F.when(F.col("error").isNotNull(), F.array(F.lit(0))).otherwise(special)
    return out.withColumn("correct", F.coalesce(special, "correct"))


def grade_or_report(df: DataFrame, name: str) -> DataFrame:
    """``grade`` of the rows that can be judged, and the others as they are with the reason as ``exception``.

    No row of a batch that its grader would fail on stops the others; scores pass over error records.
    """
    found = get_grader(name)
    df = found.prepare(df)
    why = found.problem(df)
    if "generations" in df.columns:
        why = F.when(F.col("generations").isNull(), "no generations").otherwise(why)
    # rows that are answered before any grader looks at them need nothing else
    for early in {"error"} & set(df.columns):
        why = F.when(F.col(early).isNull(), why)
    df = df.withColumn("exception", why)
    good = grade(df.where("exception is null"), name)
    return good.unionByName(df.where("exception is not null"), allowMissingColumns=True)


def score(graded: DataFrame, name: str, options: Options = Options()) -> DataFrame:
    """name and value of each of a grader's scores over rows that ``grade`` or ``grade_or_report`` gave."""
    if "exception" in graded.columns:
        graded = graded.where("exception is null")
    return get_grader(name).scores(graded, options).select("name", F.col("value").cast("double").alias("value"))


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


# Phrases that state a choice, by priority; the last match of the first that occurs counts.
CHOICE_PATTERNS = (
    (r"(?:the\s+)?(?:final\s+)?answer\s+is[\s:]*\*{0,2}\(?([A-J])\)?\*{0,2}", "i"),
    (r"(?:final\s+)?answer[\s:]*[:\-]\s*\*{0,2}\(?([A-J])\)?\*{0,2}", "i"),
    (r"\\boxed\s*\{\s*\(?([A-J])\)?\s*\}", ""),
    (r"\*\*\(?([A-J])\)?\*\*", ""),
    (r"\(\s*([A-J])\s*\)", ""),
)


def pick_choice(text: Column) -> Column:
    """Choice symbol of a generation, or NULL: stated phrases in the last 600 characters, then a lone
    letter or digit in the last 50, then a text that is one symbol."""
    text = strip(text)
    tail, end = F.right(text, F.lit(600)), F.right(text, F.lit(50))
    stated = [F.upper(last_found(tail, p, 1, flags)) for p, flags in CHOICE_PATTERNS]
    lone = last_found(end, r"(?<![A-Za-z])([A-J])(?![A-Za-z])")
    digit = F.translate(found(end, r"(?<!\d)([1-5])(?!\d)"), "12345", "ABCDE")
    symbol = F.when((F.length(text) == 1) & ~text.rlike(regex(r"[\p{L}\p{N}]")), text)
    return F.coalesce(*stated, lone, digit, symbol)


def _choice_problem(df: DataFrame) -> Column:
    missing = no_truth(df)
    if df.schema["ground_truth"].dataType.typeName() == "array":
        return missing.when(F.size("ground_truth") != F.size("generations"), "truths and generations differ in number")
    return missing


@grader("multiple-choice", "multiple_choice", problem=_choice_problem)
def multiple_choice(df: DataFrame) -> DataFrame:
    """The truth is its first character, 1 to 5 read as A to E; a list pairs with the generations."""
    truth = F.col("ground_truth")
    if isinstance(df.schema["ground_truth"].dataType.simpleString(), str) and df.schema["ground_truth"].dataType.simpleString().startswith("array"):
        expected = F.when(F.size(truth) != F.size("answers"), F.raise_error(F.lit("truths and generations differ in number"))).otherwise(truth)
    else:
        expected = F.transform("answers", lambda a: truth)
    out = df.withColumn("picked", F.transform("answers", pick_choice))
    return out.withColumn("correct", F.zip_with("picked", expected, lambda p, e: _flag(p == digit_to_letter(F.left(e, F.lit(1))))))


@grader("exact-match", "exact_match")
def exact_match(df: DataFrame) -> DataFrame:
    """A generation is right if it starts with any of the options, case counted."""
    truth = F.col("ground_truth")
    options = truth if df.schema["ground_truth"].dataType.simpleString().startswith("array") else F.array(truth)
    return df.withColumn("correct", F.transform("answers", lambda g: _flag(F.exists(options, lambda o: F.startswith(g, o)))))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _numeric(answers: pd.Series, truths: pd.Series) -> pd.Series:
    return pd.Series([[int(any(same_answer(a, t) for t in ts)) for a in xs] for xs, ts in zip(answers, truths)], dtype=object)


@grader("math-verify", "math_verify")
def math_numeric(df: DataFrame) -> DataFrame:
    """Numeric tier: a generation is right if a place that states its answer has the value of one of the truths.

    Fractions and decimals compare by value within 1e-9; truths that aren't numbers by their formula's
    text. A bare integer never stands for a fraction's part, and text never for a number.
    """
    truth = F.col("ground_truth")
    truths = truth if df.schema["ground_truth"].dataType.typeName() == "array" else F.array(truth)
    out = df.withColumn("correct", _numeric("answers", truths))
    return out.withColumn("partial_accuracy", F.aggregate("correct", F.lit(0.0), lambda a, x: a + x) / F.size("correct")).withColumn("any_accuracy", F.exists("correct", lambda x: x == 1).cast("double"))


def _hle_problem(df: DataFrame) -> Column:
    return no_truth(df).when(~F.coalesce(F.col("answer_type").isin("multipleChoice", "exactMatch"), F.lit(False)), "unknown answer_type")


@grader("hle", problem=_hle_problem)
def hle(df: DataFrame) -> DataFrame:
    """By ``answer_type``: a choice letter after "Answer:" (else the first letter); else the judge's verdict where
    ``judge_replies`` are there, or equal trimmed lower-case text. Another type is an error."""
    letter = lambda g: F.upper(F.coalesce(found(g, r"answer:\s*([A-Za-z])", flags="i"), found(g, r"([A-Za-z])")))
    truth = F.col("ground_truth")
    choice = F.transform("answers", lambda g: _flag(letter(g) == F.upper(strip(truth))))
    exact = F.transform("answers", lambda g: _flag(F.lower(strip(g)) == F.lower(strip(truth))))
    if "judge_replies" in df.columns:
        exact = F.transform(judges.mapping_verdicts("judge_replies"), _flag)
    unknown = F.raise_error(F.concat(F.lit("unknown answer_type "), F.col("answer_type"))).cast("array<int>")
    return df.withColumn("correct", F.when(F.col("answer_type") == "multipleChoice", choice).when(F.col("answer_type") == "exactMatch", exact).otherwise(unknown))


def _needs_replies(df: DataFrame, name: str) -> None:
    if "judge_replies" not in df.columns:
        raise RuntimeError(f"grader {name!r} is unavailable without judge_replies: this library calls no judge")


@grader("hle_aa")
def hle_aa(df: DataFrame) -> DataFrame:
    """Choices by the last visible statement; else the last verdict of each reply. A reply without one
    counts as wrong and ``judge_failed`` says so; a choice row has no such failures."""
    is_choice = F.col("answer_type") == "multipleChoice"
    picked = F.transform(parse_all("hle_aa_choice", "answers"), lambda p: _flag(p == F.upper(strip(F.col("ground_truth")))))
    _needs_replies(df, "hle_aa")
    verdicts = judges.last_verdicts("judge_replies")
    out = df.withColumn("correct", F.when(is_choice, picked).otherwise(F.transform(verdicts, _flag)))
    return out.withColumn("judge_failed", ~is_choice & F.exists(verdicts, lambda v: v.isNull()))


@grader("lcr_aa")
def lcr_aa(df: DataFrame) -> DataFrame:
    """Replies that are just CORRECT; an answer that is empty, unclosed or only reasoning is wrong without a judge.

    Optional ``unclosed`` (array<boolean>) and ``reasoning`` (array<string>) columns. Adds grading_source.
    """
    _needs_replies(df, "lcr_aa")
    unclosed = F.col("unclosed") if "unclosed" in df.columns else F.array().cast("array<boolean>")
    thoughts = F.col("reasoning") if "reasoning" in df.columns else F.array().cast("array<string>")
    parsed = F.col("parsed_generations") if "parsed_generations" in df.columns else F.col("answers")
    why = F.transform(parsed, lambda p, i: deterministic_incorrect(p, F.get(unclosed, i), F.array_contains(thoughts, F.get(F.col("generations"), i))))
    out = df.withColumn("grading_source", F.transform(why, lambda w: F.coalesce(w, F.lit("judge"))))
    return out.withColumn("correct", F.zip_with("grading_source", "judge_replies", lambda w, r: _flag((w == "judge") & (judges.word_label(r) == "CORRECT"))))


@grader("boxed-llm-as-judge", "llm_as_judge", "llm_as_judge_lcr")
def judged(df: DataFrame) -> DataFrame:
    _needs_replies(df, "llm_as_judge")
    return df.withColumn("correct", F.transform("judge_replies", lambda r: _flag(judge_verdict(r))))


@grader("math-verify-llm-as-judge", "math_verify_llm_as_judge")
def math_judged(df: DataFrame) -> DataFrame:
    """Right by the numeric tier, or else by a judge's yes. ``judge_replies`` has a reply for each generation, or a list of
    replies (for its parsed and raw text and each truth), of which one yes is enough. Adds ``grading_diagnostics``; what a judge is
    to be shown is ``judges.equality_input``."""
    _needs_replies(df, "math-verify-llm-as-judge")
    several = df.schema["judge_replies"].dataType.elementType.typeName() == "array"
    yes = (lambda r: F.exists(F.coalesce(r, F.array().cast("array<string>")), lambda x: F.coalesce(judges.says_yes(x), F.lit(False)))) if several else (lambda r: F.coalesce(judges.says_yes(r), F.lit(False)))
    out = math_numeric(df)

    def one(by_value: Column, reply: Column) -> Column:
        by_judge = (by_value == 0) & yes(reply)
        method = F.when(by_value == 1, "math_verify").when(by_judge, "llm").otherwise("none")
        return F.struct(
            method.alias("method"),
            F.when(by_value == 1, "match").otherwise("no_match").alias("math_verify_result"),
            (by_value == 0).alias("llm_called"),
            F.when(by_value == 0, F.when(by_judge, "match").otherwise("no_match")).alias("llm_result"),
            F.greatest(by_value, by_judge.cast("int")).alias("score"),
        )

    each = F.zip_with("correct", "judge_replies", one)
    count = lambda field, value: F.size(F.filter("_each", lambda d: d[field] == value))
    out = out.withColumn("_each", each)
    summary = F.struct(
        F.col("_each").alias("per_generation"),
        count("math_verify_result", "match").alias("math_verify_match_count"),
        count("math_verify_result", "no_match").alias("math_verify_no_match_count"),
        F.size(F.filter("_each", lambda d: d["llm_called"])).alias("llm_called_count"),
        count("llm_result", "match").alias("llm_match_count"),
        count("llm_result", "no_match").alias("llm_no_match_count"),
    )
    correct = F.transform("_each", lambda d: d["score"])
    out = out.withColumns({"grading_diagnostics": summary, "correct": correct})
    return out.withColumns({"partial_accuracy": F.aggregate("correct", F.lit(0.0), lambda a, x: a + x) / F.size("correct"), "any_accuracy": F.exists("correct", lambda x: x == 1).cast("double")}).drop("_each")


@grader("humaneval", "humaneval-plus-daytona", "mbpp-daytona", "lcbv6-daytona", "mbpp-local", "mbpp_local", scores=accuracy_scores(zero_is_nan=True))
def code_runs(df: DataFrame) -> DataFrame:
    """Runs made elsewhere against the row's tests: ``runs`` (for each generation an array of stdout, exit_code, timeout) and ``tests`` (output, testtype)."""
    if "runs" not in df.columns:
        raise RuntimeError("code graders are unavailable without runs: this library doesn't run generated code")
    out = df.withColumn("verdicts", judges.run_verdicts("runs", "tests"))
    return out.withColumn("correct", F.transform("verdicts", lambda v: _flag(v == "pass")))


# How roles, assignments and number lists are written.
ROLE_LINE = r"\b([A-Za-z]+)\b.*?\b(knight|knave)\b"
ROLE_AFTER_NAME = r"\b.*?\b(knight|knave)\b"
ASSIGNED = r"\s*=\s*([-+]?\d*\.?\d+)"
LIST_MARKS = r"[,\s]+"
EXPRESSION = r"[\d+\-*/().\s]+"

# Retrieval task names by how their expected values are matched.
RULER_SINGLE = ("niah_single_1", "niah_single_2", "niah_single_3", "niah_multikey_1", "niah_multikey_2", "niah_multikey_3")
RULER_EACH = ("niah_multivalue", "niah_multiquery", "ruler_fwe", "ruler_cwe")
RULER_ANY = ("ruler_qa_squad", "ruler_qa_hotpot")


#: Tokens of a generation that each retrieval task looks at; tasks without an entry see all of it.
RULER_TOKENS = dict.fromkeys((*RULER_SINGLE, "niah_multiquery", "niah_multivalue"), 128) | {"ruler_cwe": 120, "ruler_fwe": 50, "ruler_vt": 30}


def within_budgets(df: DataFrame, tokenizer: str, task: str = "ruler_task") -> DataFrame:
    """``answers`` cut to the tokens that each row's task allows, by the vocabulary file ``tokenizer``, which every executor must see."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series, budget: pd.Series) -> pd.Series:
        coder = _tokenizer(tokenizer)
        cut = lambda t, n: t if not t or pd.isna(n) else coder.decode(coder.encode(t, add_special_tokens=False).ids[: int(n)], skip_special_tokens=True)
        return pd.Series([[cut(t, n) for t in ts] for ts, n in zip(texts, budget)], dtype=object)

    budgets = F.create_map(*[F.lit(x) for pair in RULER_TOKENS.items() for x in pair])
    return with_answers(df).withColumn("answers", run("answers", F.try_element_at(budgets, F.col(task))))


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _ruler_scores(graded: DataFrame, options: Options) -> DataFrame:
    return accuracy_scores()(graded, options).unionByName(metrics.flag_ratio(graded.where("ruler_task is not null"), "ruler_task"))


@grader("ruler", scores=_ruler_scores, problem=lambda df: no_truth(df).when(~F.coalesce(F.col("ruler_task").isin(*RULER_SINGLE, *RULER_EACH, *RULER_ANY, "ruler_vt"), F.lit(False)), "unknown ruler_task"))
def ruler(df: DataFrame) -> DataFrame:
    """Retrieval tasks: one whole-word flag, one flag for any value, or a flag for each expected value. ``ground_truth`` is a text or a list."""
    want, task = F.col("ground_truth"), F.col("ruler_task")
    if df.schema["ground_truth"].dataType.typeName() != "array":
        want = F.array(want)

    def flags(g: Column) -> Column:
        g = F.coalesce(g, F.lit(""))
        first = F.lower(F.element_at(want, 1))
        whole = F.regexp_like(F.lower(g), F.concat(F.lit(regex(r"(?<!\w)")), quoted(first), F.lit(r"(?!\w)")))
        each = F.transform(want, lambda v: _flag(F.contains(F.lower(g), F.lower(v))))
        upper = F.transform(want, lambda v: _flag(F.contains(F.upper(g), F.upper(v))))
        any_ = F.exists(want, lambda v: F.contains(F.lower(g), F.lower(v)))
        unknown = F.raise_error(F.concat(F.lit("unknown ruler_task "), task)).cast("array<int>")
        return F.when(task.isin(*RULER_SINGLE), F.array(_flag(whole))).when(task.isin(*RULER_EACH), each).when(task.isin(*RULER_ANY), F.array(_flag(any_))).when(task == "ruler_vt", upper).otherwise(unknown)

    return df.withColumn("correct", F.flatten(F.transform("answers", flags)))


@grader("knights-and-knaves", "kk")
def knights_and_knaves(df: DataFrame) -> DataFrame:
    """All named roles equal; a name without a stated role fails. ``names`` lists whom to look for."""
    line = ROLE_LINE
    lines = F.filter(F.split("ground_truth", "\n"), lambda x: x.rlike(regex(line, "i")))
    truth = F.map_from_entries(F.transform(lines, lambda x: F.struct(found(x, line, 1, "i").alias("k"), F.lower(found(x, line, 2, "i")).alias("v"))))

    def role(g: Column, name: Column) -> Column:
        p = F.concat(F.lit(r"(?dUiu)\b"), quoted(name), F.lit(ROLE_AFTER_NAME))
        return F.lower(F.nullif(F.call_function("regexp_extract", g, p, F.lit(1)), F.lit("")))

    out = df.withColumn("_truth", truth)
    known = lambda g: F.forall("names", lambda n: role(g, n).isNotNull())
    equal = lambda g: F.forall(F.map_keys("_truth"), lambda n: F.coalesce(F.array_contains("names", n) & (role(g, n) == F.try_element_at("_truth", n)), F.lit(False)))
    return out.withColumn("correct", F.transform("answers", lambda g: _flag(known(g) & equal(g)))).drop("_truth")


@grader("sum-puzzle", "sum")
def sum_puzzle(df: DataFrame) -> DataFrame:
    """The last assignments to x and to y equal the truth's."""
    last = lambda g, v: F.try_element_at(F.regexp_extract_all(g, F.lit(regex(rf"(?<!\w){v}" + ASSIGNED)), F.lit(1)), F.lit(-1)).try_cast("double")
    ok = lambda g: (last(g, "x") == F.col("ground_truth.x")) & (last(g, "y") == F.col("ground_truth.y"))
    return df.withColumn("correct", F.transform("answers", lambda g: _flag(ok(g))))


@grader("order-puzzle", "order")
def order_puzzle(df: DataFrame) -> DataFrame:
    """A permutation of 0..n-1 that meets every constraint; an item that isn't placed meets none."""
    con = F.col("ground_truth.constraints")

    def right(g: Column) -> Column:
        parts = F.transform(F.split(strip(g), regex(LIST_MARKS), -1), lambda v: v.try_cast("int"))
        day = lambda item: F.nullif(F.array_position(parts, item), F.lit(0).cast("bigint")) - 1
        before = lambda a, b: F.coalesce(day(a) < day(b), F.lit(False))
        fits = F.coalesce(F.array_sort(parts) == F.sequence(F.lit(0), con["n"] - 1), F.lit(False))
        free = F.forall(con["not_sold"], lambda m: F.forall(F.map_entries(m), lambda e: F.coalesce(day(e["key"].cast("int")) != e["value"], F.lit(True))))
        first = F.forall(con["sold_before"], lambda x: F.forall(x["sold_before_pivot"], lambda i: before(i, x["pivot"])))
        later = F.forall(con["sold_after"], lambda x: F.forall(x["sold_after_pivot"], lambda i: before(x["pivot"], i)))
        between = F.forall(con["sold_between"], lambda x: before(x["sold_before_pivot"], x["pivot"]) | before(x["pivot"], x["sold_after_pivot"]))
        return fits & free & first & later & between

    return df.withColumn("correct", F.transform("answers", lambda g: _flag(right(g))))


_OPERATIONS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv, ast.UAdd: operator.pos, ast.USub: operator.neg}


def arithmetic(text: str) -> float | None:
    """Value of an expression of numbers, + - * / // ** and brackets; None when it isn't one or grows too large."""

    def value(node):
        if isinstance(node, ast.Constant) and isinstance(node.value, int | float):
            return node.value
        if isinstance(node, ast.UnaryOp):
            return _OPERATIONS[type(node.op)](value(node.operand))
        if isinstance(node, ast.BinOp):
            a, b = value(node.left), value(node.right)
            if isinstance(node.op, ast.Pow):
                if abs(b) > 64 or abs(a) > 1e6:
                    raise ValueError
                return a**b
            return _OPERATIONS[type(node.op)](a, b)
        raise ValueError

    if not re.fullmatch(EXPRESSION, text) or len(text) > 1000:
        return None
    try:
        return value(ast.parse(text.strip(), mode="eval").body)
    except (ValueError, SyntaxError, KeyError, ArithmeticError, MemoryError, RecursionError):
        return None


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _countdown(answers: pd.Series, target: pd.Series, numbers: pd.Series) -> pd.Series:
    def one(text, want, have) -> int:
        if text is None or sorted(map(int, re.findall(r"\d+", text))) != sorted(have):
            return 0
        got = arithmetic(text)
        return int(got is not None and not isinstance(got, complex) and abs(got - want) < 1e-5)

    return pd.Series([[one(t, w, h) for t in a] for a, w, h in zip(answers, target, numbers)])


@grader("countdown", "cd")
def countdown(df: DataFrame) -> DataFrame:
    """Each given number used once and the value within 1e-5 of the target."""
    return df.withColumn("correct", _countdown("answers", "ground_truth.target", "ground_truth.numbers"))


# The benchmark's domains and categories by how a subtask's name begins; the first that fits counts.
APT_CLASSES = (("env_setup/", "SWE", "EnvSetup"), ("issue_fix/", "SWE", "IssueFix"), ("deepresearch/openend_", "DR", "Open-ended"), ("deepresearch/", "DR", "Closed-ended"))
APT_OVERLAP = ("deepresearch/summ_ans_en", "deepresearch/summ_ans_zh")


def apt_class(difficulty: Column) -> Column:
    """Struct of domain and category of a subtask, ``unknown`` for another name."""
    pick = lambda k: F.coalesce(*[F.when(F.startswith(difficulty, F.lit(c[0])), F.lit(c[k])) for c in APT_CLASSES], F.lit("unknown"))
    return F.struct(pick(1).alias("domain"), pick(2).alias("category"))


def _apt_scores(graded: DataFrame, options: Options) -> DataFrame:
    """Accuracies over all rows, domains, categories and subtasks in one pass, and word overlap of the summaries."""
    name = F.coalesce("difficulty", F.lit("unknown"))
    rows = graded.withColumns({"difficulty": name, "domain": apt_class(name)["domain"], "category": apt_class(name)["category"]})
    every = metrics.named_scores(rows, options.average_over, options.pass_at, ["domain", "category", "difficulty", *options.by], overall="overall")
    return every.where(~F.contains("name", F.lit("bootstrap_std"))).unionByName(metrics.unigram_overlap(rows.where(F.col("difficulty").isin(*APT_OVERLAP))))


@grader("aptbench", scores=_apt_scores)
def aptbench(df: DataFrame) -> DataFrame:
    """Equality of the extracted answer with the truth's text; ``extractor`` names the extraction. Only parsed answers count where they are given."""
    said = F.col("parsed_generations") if "parsed_generations" in df.columns else F.col("answers")
    summary = F.col("extractor") == "extract_answer_summ_ans" if "extractor" in df.columns else F.lit(False)
    pick = lambda g: F.when(summary, aptbench_summary(g)).otherwise(aptbench_choice(g))
    return df.withColumn("picked", F.transform(said, pick)).withColumn("correct", F.transform("picked", lambda p: _flag(p == F.col("ground_truth").cast("string"))))


@grader("bbh")
def bbh(df: DataFrame) -> DataFrame:
    """Each subtask's own extraction, choices and word lists from the prompt, then normalised equality; an unknown subtask is wrong."""
    prompt = F.col("completion_input") if "completion_input" in df.columns else F.lit(None).cast("string")
    out = df.withColumn("_g", subtasks.graded("meta.subtask", prompt, "answers", "ground_truth"))
    return out.withColumns({"picked": F.col("_g.picked"), "correct": F.col("_g.correct")}).drop("_g")


def judge_verdict(reply: Column) -> Column:
    """Whether a judge's reply says correct: after the last think tag, ``grade: correct`` in a mapping or a bare verdict."""
    text = strip(F.element_at(F.split(reply, regex(r"</think[^>]*>", "i"), -1), -1))
    grade_ = F.lower(last_found(text, r"^\W*(?:answer\.)?[\"']?grade[\"']?\s*:\s*[\"']?(\w+)", flags="im"))
    bare = F.lower(found(text, r"\A\W*(correct|incorrect)\W*\z", flags="i"))
    return F.coalesce(grade_, bare) == "correct"


def deterministic_incorrect(answer: Column, unclosed: Column, from_reasoning: Column) -> Column:
    """Reason why an answer is wrong without a judge: empty, unclosed think block, or only reasoning; else NULL."""
    return F.when(F.coalesce(F.length(strip(answer)), F.lit(0)) == 0, "empty_final").when(F.coalesce(unclosed, F.lit(False)), "unclosed_think_tag").when(F.coalesce(from_reasoning, F.lit(False)), "reasoning_substituted_for_empty_final")


unavailable("needs a symbolic algebra package", "sympy-llm-as-judge", "sympy_llm_as_judge")


def _instruction_columns(df: DataFrame) -> DataFrame:
    if "instruction_ids" not in df.columns and "instruction_id_list" in df.columns:
        df = df.withColumnRenamed("instruction_id_list", "instruction_ids")
    kind = df.schema["kwargs"].dataType
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.MapType):  # as JSON readers give them
        df = df.withColumn("kwargs", F.transform("kwargs", lambda k: F.from_json(F.to_json(k), "map<string,string>")))
    return df


def _instruction_problem(df: DataFrame) -> Column:
    ids = F.col("instruction_ids")
    known = F.forall(ids, lambda i: i.isin(*ifeval.list_instructions(unlisted=True)))
    return F.when(ids.isNull() | F.col("kwargs").isNull(), "no instructions").when(F.size(ids) != F.size("kwargs"), "instructions and arguments differ in number").when(~known, "unknown instruction")


@grader("ifeval", "if_eval", scores=lambda graded, o: ifeval.accuracy_scores(graded), flags=False, problem=_instruction_problem, prepare=_instruction_columns)
def instructions(df: DataFrame) -> DataFrame:
    """Flags of each instruction of a row's first answer, strict and loose; rows with an ``error`` or too long an input follow nothing."""
    said = F.try_element_at("answers", F.lit(1)) if "answers" in df.columns else F.col("response")
    for lost in ({"error"} & set(df.columns)):
        said = F.when(F.col(lost).isNull(), said)
    for lost in ({"input_too_long"} & set(df.columns)):
        said = F.when(~F.coalesce(lost, F.lit(False)), said)
    return ifeval.grade(df.withColumn("_said", said), "_said").drop("_said")


@grader("choice_scoring", "multiple_choice_nll", scores=lambda graded, o: choice.choice_scores(graded), flags=False, problem=lambda df: F.lit(None).cast("string"))
def choices(df: DataFrame) -> DataFrame:
    """Picks and values of each row's choices, from likelihoods that are there or from raw responses (see ``choice.from_responses``)."""
    if "choice_nll" not in df.columns:
        df = choice.from_responses(df)
    if "choice_group" not in df.columns:
        df = df.withColumn("choice_group", F.lit(None).cast("string"))
    return choice.choice_metrics(df)
