"""The parts of judged grading that need no judge: what goes to it, and what its replies say.

``judge_replies`` (one for each generation) holds the replies; asking for them is left to the caller.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip

# Tags that close a model's reasoning, marks of a judge's last channel, and verdict lines.
CLOSE_TAGS = ("</ifm|think>", "</ifm|think_fast>", "</ifm|think_faster>", "</think>", "</think_fast>", "</think_faster>")
FINAL_MARKS = ("assistantfinal", "<|channel|>final<|message|>", "<|channel|>final")
CORRECT_LINE = r"(?im)^\s*[*_`-]*correct\s*:?[*_`]*\s*:?[*_`]*\s*(yes|no)\b"
BRACKETED_LINE = r"(?im)^\s*\[correct_answer\]\s*:\s*(yes|no)\s*[*_`]*\s*$"
MOST_CHARS = 120_000


def after_last_of(text: str, marks: tuple[str, ...]) -> str | None:
    """What follows the mark that begins last (the longest such); None without one."""
    at, size = max(((text.rfind(m), len(m)) for m in marks), default=(-1, 0))
    return text[at + size :] if at >= 0 else None


def submitted_text(response: str | None, most: int = MOST_CHARS) -> tuple[str, int, bool]:
    """(text for the judge, characters left out, whether only reasoning was there): the visible end, the last ``most`` characters."""
    visible = after_last_of(response or "", CLOSE_TAGS)
    text = (response or "" if visible is None else visible).strip()
    cut = max(0, len(text) - most) if most > 0 else 0
    return text[cut:] or "No answer", cut, visible is not None and not text


def judge_input_of(most: int = MOST_CHARS):
    """Column function: struct of text, omitted and empty_visible, at most ``most`` characters of text."""

    @F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("omitted", T.IntegerType()), T.StructField("empty_visible", T.BooleanType())]))
    def run(responses: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([submitted_text(r, most) for r in responses], columns=["text", "omitted", "empty_visible"])

    return run


def mapping_verdict(reply: str | None) -> bool:
    """A JSON object's or a line's ``correct``: yes; anything else, an empty reply too, is no."""
    text = after_last_of(reply or "", ("</think>",))
    text = (reply or "" if text is None else text).strip()
    if "{" in text and "}" in text[text.index("{") :]:
        try:
            found = json.loads(text[text.index("{") : text.rindex("}") + 1])
            return isinstance(found, dict) and str(found.get("correct", "")).strip().lower() == "yes"
        except ValueError:
            pass
    line = re.search(r"correct:\s*(yes|no)", text, re.I)
    return bool(line) and line[1].lower() == "yes"


def last_verdict(reply: str | None) -> bool | None:
    """The verdict that comes last in the judge's last channel, as JSON or as a line; None when there is none."""
    reply = reply or ""
    text = after_last_of(reply, FINAL_MARKS)
    if text is None:
        text = after_last_of(reply, ("</think>",))
    text = (reply if text is None else text).strip()
    found = [(m.start(), m[1].lower()) for p in (CORRECT_LINE, BRACKETED_LINE) for m in re.finditer(p, text)]
    decode = json.JSONDecoder().raw_decode
    for m in re.finditer(r"\{", text):
        try:
            value = decode(text, m.start())[0]
        except ValueError:
            continue
        if (said := str(value.get("correct", "")).strip().lower()) in ("yes", "no"):
            found.append((m.start(), said))
    return max(found)[1] == "yes" if found else None


def _array(f):
    @F.pandas_udf(T.ArrayType(T.BooleanType()))
    def run(replies: pd.Series) -> pd.Series:
        return pd.Series([None if xs is None else [f(x) for x in xs] for xs in replies], dtype=object)

    return run


mapping_verdicts, last_verdicts = _array(mapping_verdict), _array(last_verdict)


def word_label(reply: Column) -> Column:
    """CORRECT or INCORRECT where a reply is just that, in any case; else NULL, which counts as incorrect."""
    text = F.upper(strip(reply))
    return F.when(text.isin("CORRECT", "INCORRECT"), text)


# An answer of more characters counts as a solution, of which the judge sees the end.
SOLUTION_CHARS, SOLUTION_END = 200, 800


def equality_input(answer: Column) -> Column:
    """Struct of what an equality judge is shown: ``is_solution`` and the ``text``, the end of a long one; nothing is "No answer"."""
    text = F.when(F.length(answer) > 0, answer).otherwise("No answer")
    long = F.length(text) > SOLUTION_CHARS
    return F.struct(long.alias("is_solution"), F.when(long, F.right(text, F.lit(SOLUTION_END))).otherwise(text).alias("text"))


def says_yes(reply: Column) -> Column:
    """Whether a judge's reply, after its last think block, says yes; null where it says nothing."""
    said = F.when(F.contains(reply, F.lit("</think>")), F.substring_index(reply, "</think>", -1)).otherwise(reply)
    return F.when(F.length(strip(said)) > 0, F.contains(F.lower(said), F.lit("yes")))


def diagnostics(verdicts: Column) -> Column:
    """Struct of the numbers of replies: yes, no, unparsed."""
    count = lambda f: F.size(F.filter(verdicts, f)).cast("bigint")
    return F.struct(count(lambda v: v == F.lit(True)).alias("yes"), count(lambda v: v == F.lit(False)).alias("no"), count(lambda v: v.isNull()).alias("unparsed"))


def same_json(a: str | None, b: str | None) -> bool:
    try:
        return json.loads(a) == json.loads(b)
    except (ValueError, TypeError):
        return False


def same_lines(a: str | None, b: str | None) -> bool:
    """Trimmed lines equal as numbers or as text, without blank ends."""
    if a is None or b is None:
        return False
    x, y = ([s.strip() for s in t.rstrip().splitlines()] for t in (a, b))

    def one(p, q):
        try:
            return float(p) == float(q)
        except ValueError:
            return p == q

    return len(x) == len(y) and all(map(one, x, y))


def run_verdict(results: list[dict] | None, tests: list[dict] | None) -> str:
    """pass, or the reason of the first test that fails: no_output, wrong_answer or timeout.

    ``results`` has stdout, exit_code, timeout of each run; ``tests`` has output and testtype ("functional": JSON).
    """
    if results is None:
        return "no_output"
    if tests is None or len(results) != len(tests):
        return "wrong_answer"
    for got, test in zip(results, tests):
        if got.get("timeout"):
            return "timeout"
        same = same_json if tests[0].get("testtype") == "functional" else same_lines
        if (got.get("exit_code") or 0) != 0 or not same(got.get("stdout"), test.get("output")):
            return "wrong_answer"
    return "pass"


@F.pandas_udf(T.ArrayType(T.StringType()))
def run_verdicts(runs: pd.Series, tests: pd.Series) -> pd.Series:
    """``run_verdict`` of each generation's runs against the row's tests."""
    return pd.Series([[run_verdict(r, t) for r in rs] for rs, t in zip(runs, tests)], dtype=object)
