"""Answer parsers: string to string or NULL, registered by name.

``parse(name, column)`` gives a Column; ``parse_all`` maps it over an array of generations.
Most are built-in expressions; those that walk braces or lines are Arrow UDFs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import after_last, all_found, blank_to_null, bound, found, last_found, regex, strip

_PARSERS: dict[str, Callable[[Column], Column]] = {}
_PYTHON: set[str] = set()


def parser(*names: str, python: bool = False):
    """Register a Column -> Column parser under all its names; a taken name is an error."""

    def keep(f):
        for n in names:
            if n in _PARSERS:
                raise ValueError(f"parser {n!r} is already registered")
            _PARSERS[n] = f
            if python:
                _PYTHON.add(n)
        return f

    return keep


def list_parsers() -> list[str]:
    return sorted(_PARSERS)


def get_parser(name: str = "passthrough") -> Callable[[Column], Column]:
    if name not in _PARSERS:
        raise KeyError(f"unknown parser {name!r}; known: {', '.join(list_parsers())}")
    return _PARSERS[name]


def parse(name: str, c: Column | str) -> Column:
    return get_parser(name)(F.col(c) if isinstance(c, str) else c)


def parse_all(name: str, generations: Column | str) -> Column:
    """The parser over each element of an array, in order."""
    c = F.col(generations) if isinstance(generations, str) else generations
    if name in _PYTHON:
        return _array_udf(name)(c)
    return F.transform(c, get_parser(name))


@parser("passthrough", "noop", "identity")
def _identity(c: Column) -> Column:
    return c


# Tags and phrases that introduce or wrap an answer.
ANSWER_TAG = r"<answer>(.*?)</answer>"
THINK_OPEN, THINK_CLOSE = r"<think[^>]*>", r"</think[^>]*>"
TOOL_OPEN, TOOL_CALL = r"<tool_call>(.*)", r"<tool_call>(.*?)</tool_call>"
PYTHON_BLOCK = r"```python3?\n(.*?)```"
ANY_PYTHON_BLOCK = r"```(?:python|py)?\s*\n(.*?)```"
DEFINITION, TOP_LEVEL = r"^(?:def |async def |class )", r"(?:def |async def |class |import |from \S+ import )"
CORRECT_ANSWER = (r"the\s+correct\s+answer\s+is\s*\(?\s*([ABCD])", r"\(([ABCD])\)")
LETTER_BEFORE_END = r"\b([A-Za-z])[)\n]"
ANSWER_IS = r"the (?:correct )?answer is "
LETTER_IS = r"\bthe answer is\b[\s:：-]*[\(\[]?\s*([A-Z])\s*[\)\]]?"


def _up_to_last(tail: Column) -> Column:
    """What stands on the tail's first line but for its last character; NULL for an empty line."""
    return found(tail, r"\A(.*)(?=.)")


@parser("so_the_answer_is")
def _so(c: Column) -> Column:
    return _up_to_last(found(c, ANSWER_IS + r"(?s:(.*))", flags="i"))


@parser("so_the_answer_is_last")
def _so_last(c: Column) -> Column:
    return _up_to_last(found(c, r"(?s:.*)" + ANSWER_IS + r"(?s:(.*))", flags="i"))


@parser("answer_tag")
def _answer_tag(c: Column) -> Column:
    return blank_to_null(strip(found(c, ANSWER_TAG, flags="is")))


@parser("think_suffix", "think_tag")
def _think_suffix(c: Column) -> Column:
    return blank_to_null(strip(F.element_at(F.split(c, regex(THINK_CLOSE, "i"), -1), -1)))


@parser("the_answer_is")
def _the_answer_is(c: Column) -> Column:
    return found(c, LETTER_IS, flags="i")


@parser("the_answer_is_last")
def _the_answer_is_last(c: Column) -> Column:
    return last_found(c, LETTER_IS, flags="i")


# Markers after which a numeric answer stands, in the order they are cut.
MARKERS = ("### ", "**Answer:", "**Answer**", "**Final Answer:**", "Answer:", "boxed{", "The answer is ")


@parser("gsm8k_base")
def _gsm8k(c: Column) -> Column:
    for m in MARKERS:
        # the brace only decides whether to cut; the cut is at the word
        cut = "boxed" if m == "boxed{" else m
        c = F.when(F.contains(c, F.lit(m)), F.regexp_replace(F.substring_index(c, cut, -1), r"^[ \n]+|[ \n]+\z", "")).otherwise(c)
    return blank_to_null(c)


@parser("code-think")
def _code_think(c: Column) -> Column:
    tail = F.regexp_replace(c, regex(r"\A.*?</think>", "is"), "")
    return last_found(tail, PYTHON_BLOCK, flags="s")


@parser("longbench-v2", "the-correct-answer-is")
def _longbench(c: Column) -> Column:
    return F.upper(F.coalesce(*[found(c, p, flags="i") for p in CORRECT_ANSWER]))


def aptbench_choice(c: Column) -> Column:
    """First letter before a closing bracket or line end, without asterisks."""
    return found(F.replace(c, F.lit("*"), F.lit("")), LETTER_BEFORE_END)


def aptbench_summary(c: Column) -> Column:
    """What stands before the first closing square bracket."""
    return F.when(F.contains(c, F.lit("]")), F.substring_index(c, "]", 1))


def reasoning(c: Column) -> Column:
    """Think and tool-call blocks of a generation as a struct; absent parts are NULL.

    reasoning, answer, tool_calls, unclosed_think_tag, unclosed_tool_call, multiple_think_blocks.
    """
    block, close = THINK_OPEN + "(.*?)" + THINK_CLOSE, THINK_CLOSE
    # each pattern runs at most once over a text, and none over a text without its tag's name
    names = bound(F.lower(c), lambda low: F.struct(F.contains(low, F.lit("think")).alias("think"), F.contains(low, F.lit("tool_call")).alias("tool")))

    def parts(s: Column) -> Column:
        none = F.array().cast("array<string>")
        seen = F.struct(F.when(s["think"], all_found(c, block, flags="is")).otherwise(none).alias("blocks"), F.when(s["tool"], all_found(c, TOOL_CALL, flags="is")).otherwise(none).alias("tools"), s["think"].alias("think"), s["tool"].alias("tool"))
        return bound(seen, with_tags)

    def with_tags(s: Column) -> Column:
        closed, has_tools = F.size(s["blocks"]) > 0, F.size(s["tools"]) > 0
        orphan = F.when(s["think"] & ~closed, c.rlike(regex(close, "i"))).otherwise(False)
        opened = F.when(s["think"] & ~closed, c.rlike(regex(THINK_OPEN, "i"))).otherwise(closed)
        open_tool = F.when(s["tool"], found(c, TOOL_OPEN, flags="is"))
        seen = F.struct(closed.alias("closed"), has_tools.alias("has_tools"), orphan.alias("orphan"), opened.alias("opened"), open_tool.alias("open_tool"), s["blocks"].alias("blocks"), s["tools"].alias("tools"))
        return bound(seen, fields)

    def fields(s: Column) -> Column:
        closed, orphan, opened, tools, open_tool, has_tools = (s[k] for k in ("closed", "orphan", "opened", "tools", "open_tool", "has_tools"))
        thought = F.when(closed, strip(F.try_element_at(s["blocks"], F.lit(1)))).when(orphan, strip(found(c, r"\A(.*?)" + close, flags="is"))).when(opened, strip(found(c, THINK_OPEN + "(.*)", flags="is")))
        rest = F.when(closed, found(c, r"\A.*?" + block + r"(.*)\z", 2, "is")).when(orphan, found(c, r"\A.*?" + close + r"(.*)\z", 1, "is"))
        plain = F.when(has_tools, F.regexp_replace(c, regex(TOOL_CALL, "is"), ""))
        return F.struct(
            thought.alias("reasoning"),
            blank_to_null(strip(F.when(closed | orphan | opened, rest).otherwise(plain))).alias("answer"),
            F.when(has_tools, F.transform(tools, strip)).when(open_tool.isNotNull(), F.array(strip(open_tool))).alias("tool_calls"),
            F.when(opened & ~closed & ~orphan, F.lit(True)).alias("unclosed_think_tag"),
            F.when(~has_tools & open_tool.isNotNull(), F.lit(True)).alias("unclosed_tool_call"),
            F.when(F.size(s["blocks"]) > 1, F.lit(True)).alias("multiple_think_blocks"),
        )

    return F.when(F.length(c) > 0, bound(names, parts))


# --- parsers that walk the text -------------------------------------------------------------


def boxed_text(text: str | None) -> str | None:
    """Body of the last boxed group; unbalanced braces give the whole text, no group NULL."""
    if text is None:
        return None
    starts = [m.end() for m in re.finditer(r"\\(?:boxed|fbox)\s*\{", text, re.I)]
    if not starts:
        return None
    depth = 1
    for i in range(starts[-1], len(text)):
        depth += {"{": 1, "}": -1}.get(text[i], 0)
        if not depth:
            return text[starts[-1] : i].strip()
    return text


# Patterns of choice answers.
CHOICE_TAGS = (r"<(?:final\s*)?answer>\s*[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*</(?:final\s*)?answer>", r"\\(?:boxed|fbox)\s*\{\s*([A-E1-5])\s*\}")
CHOICE_LINES = (
    r"^\s*(?:final[.:]?\s*)?answer\b\s*[:：-]?\s*(?:is\s*)?(?:\*\*|__|`)?\s*(?:option\s*)?[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?\s*(?:[.!?])?\s*$",
    r"^\s*(?:the\s+)?choice\s+is\s+(?:\*\*|__|`)?\s*(?:option\s*)?[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?\s*(?:[.!?])?\s*$",
    r"^\s*(?:\*\*|__|`)?\s*[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?\s*(?:[.!?])?\s*$",
)
CHOICE_HINTS = (
    r"\b(?:final[.:]?\s*)?answer\b\s*[:：-]?\s*(?:is\s*)?(?:\*\*|__|`)?\s*(?:option\s*)?[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?",
    r"\b(?:the\s+)?choice\s+is\s+(?:\*\*|__|`)?\s*(?:option\s*)?[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?",
    r"\b(?:match(?:es|ed)?|coincides?\s+with|corresponds?\s+to|gives?|yields?|confirms?)\s+(?:option|choice)\s*(?:\*\*|__|`)?\s*[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?",
    r"\bonly\s+(?:option\s*)?(?:\*\*|__|`)?\s*[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?",
    r"\b(?:option|choice)\s*(?:\*\*|__|`)?\s*[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?\s+(?:is|would\s+be|remains?|works?|fits?|correct|best|right|compatible|consistent|larger)\b",
    r"\b(?:\*\*|__|`)?\s*[\(\[]?\s*([A-E1-5])\s*[\)\]]?\s*(?:\*\*|__|`)?\s+is\s+(?:correct|best|right|compatible|consistent)\b",
)
_TAGS, _LINES, _HINTS = ([re.compile(p, re.I) for p in group] for group in (CHOICE_TAGS, CHOICE_LINES, CHOICE_HINTS))


def _letter(symbol: str) -> str:
    return "ABCDE"[int(symbol) - 1] if symbol.isdigit() else symbol.upper()


def _choice_in(text: str, lines: int = 96, tail: int = 4096) -> str | None:
    kept = [s for s in map(str.strip, text.splitlines()) if s]
    # the first line may only hold an explicit answer; later lines count from the end
    for line, patterns in [(x, _TAGS + _LINES) for x in kept[:1]] + [(x, _TAGS + _LINES + _HINTS) for x in reversed(kept[-lines:])]:
        for p in patterns:
            if m := p.search(line):
                return _letter(m[1])
    for p in _TAGS + _HINTS:
        if every := p.findall(text[-tail:]):
            return _letter(every[-1])
    return None


def choice_text(text: str | None) -> str | None:
    """Choice letter of a generation: after the last closing think tag if there, else anywhere."""
    text = (text or "").strip()
    if not text:
        return None
    parts = re.split(THINK_CLOSE, text, flags=re.I)
    return _choice_in(parts[-1].strip()) or _choice_in(text)


def code_text(text: str | None) -> str | None:
    """Last Python block with a top-level definition (else the last), without top-level example lines."""
    blocks = re.findall(PYTHON_BLOCK, text or "", re.S)
    if not blocks:
        return None
    best = next((b for b in reversed(blocks) if re.search(DEFINITION, b, re.M)), blocks[-1])
    keep, inside = [], False
    for line in best.split("\n"):
        top = bool(line) and not line[0].isspace()
        if top:
            inside = bool(re.match(TOP_LEVEL, line))
        if inside or (not line.strip() and keep):
            keep.append(line)
    return re.sub(r"(?:\n[^\S\n]*)+\Z", "", "\n".join(keep)) or best


def completion_text(text: str | None) -> str | None:
    """Code of a completion: what follows the think block, then the first Python fence if any."""
    if text is None:
        return None
    fenced = re.compile(ANY_PYTHON_BLOCK, re.S)
    if "</think>" in text:
        text = text.split("</think>", 1)[1].lstrip("\n")
    elif text.lstrip().startswith("<think>") and not fenced.search(text):
        text = text.rsplit("\n\n", 1)[-1]  # cut off while thinking: code tends to come last
    fence = fenced.search(text)
    text = fence[1] if fence else text
    return text if text.strip() else None


# Tags that close hidden reasoning, phrases that state a choice, and lines that are one.
HIDDEN_CLOSE = ("</ifm|think>", "</ifm|think_fast>", "</ifm|think_faster>", "</think>", "</think_fast>", "</think_faster>")
VISIBLE_FINAL = (
    r"\\boxed\s*\{\s*([A-Z])\s*\}",
    r"\b(?:the\s+)?(?:final\s+|correct\s+)?answer[*_`]*\s*(?:is|:|-)[*_`]*\s*(?:option\s+|choice\s+)?[*_`]*[\(\[]?([A-Z])\b",
    r"\b(?:the\s+)?(?:final\s+|correct\s+)?(?:answer\s+)?(?:option|choice)[*_`]*\s*(?:(?:is|:|-)[*_`]*\s*)?[*_`]*[\(\[]?([A-Z])\b",
    r"\b(?:I\s+)?(?:choose|select)\s+(?:option\s+|choice\s+)?[*_`]*[\(\[]?([A-Z])\b",
)
LEADING_CHOICE = r"\s*[*_`]*[\(\[]?([A-Z])[\)\]]?[*_`]*(?:[.:\-\u2013\u2014][*_`]*|\s)"
LINE_CHOICE = r"(?:^|\n)\s*[*_`]*[\(\[]?([A-Z])[\)\].:][*_`]*(?:\s|$)"
LAST_LINES = (r"(?:^|\n)\s*[*_`]*[\(\[]?([A-Z])[\)\].:][*_`]*[^\n]*\s*$", r"(?:^|\n)\s*[*_`]*[\(\[]?([A-Z])[\)\].]?[*_`]*\s*$")


def visible_final_text(text: str | None) -> str | None:
    """Choice letter of the visible part of a generation.

    The statement that begins last counts; without any the letter that begins the text, then the only
    letter that begins lines, then one on the last line. After a closing tag what was hidden never counts.
    """
    text = (text or "").strip()
    at, size = max((text.rfind(t), len(t)) for t in HIDDEN_CLOSE)
    text = text[at + size :].strip() if at >= 0 else text
    stated = [(m.start(), -k, m[1]) for k, p in enumerate(VISIBLE_FINAL) for m in re.finditer(p, text, re.I)]
    if stated:
        return max(stated)[2].upper()
    if m := re.match(LEADING_CHOICE, text, re.I):
        return m[1].upper()
    lines = {x.upper() for x in re.findall(LINE_CHOICE, text, re.I)}
    if len(lines) == 1:
        return lines.pop()
    ends = (m[1].upper() for p in LAST_LINES if (m := re.search(p, text, re.I)))
    return next(ends, None)


_WALKERS = {
    ("boxed",): boxed_text,
    ("mc_answer", "multiple_choice_answer", "think_tag_mc"): choice_text,
    ("code",): code_text,
    ("code_completion", "humaneval"): completion_text,
    ("gpqa_aa_visible_final", "hle_aa_choice"): visible_final_text,
}
_FUNCTION = {n: f for names, f in _WALKERS.items() for n in names}


def _udf(f: Callable[[str | None], str | None]):
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: f(x if isinstance(x, str) else None)).astype(object)

    return run


def _array_udf(name: str):
    f = _FUNCTION[name]

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda xs: None if xs is None else [f(x) for x in xs])

    return run


for _names, _f in _WALKERS.items():
    parser(*_names, python=True)(lambda c, f=_f: _udf(f)(c))
