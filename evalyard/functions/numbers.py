"""Numbers and formulas that a generation states as its answer; small helpers for the numeric grader."""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

# How numbers and fractions are written, where an answer is stated, and what is only layout.
NUMBER = r"-?\d[\d,]*(?:\.\d+)?|-?\.\d+"
FRACTION = r"(?P<sign>-?)(?P<whole>\d+)?\s*\\[dt]?frac\s*\{\s*(?P<top>-?\d+)\s*\}\s*\{\s*(?P<bottom>-?\d+)\s*\}|(?P<over>-?\d+)\s*/\s*(?P<under>\d+)"
SHORT_FRACTION = r"\\([dt]?)frac\s*(\d)\s*(\d)"
MARKER = r"final\s+answer|the\s+answer\s+is|\banswer\s*[:=]|####"
BOLD = r"\*\*(.+?)\*\*"
UNITS = r"(?:miles?|minutes?|hours?|dollars?|GB)"
SENTENCE_VALUE = r"(?:=|\b(?:is|are|equals?|makes?|has|have|gets?|arrives?|covers?|travels?))\s+\$?({number})(?:\s*{units})?\.?\s*$"
LAYOUT = ((r"\{\s*,\s*\}", ","), (r"\\\$|\\,|\\!|\\[()\[\]]|\$", ""), (r"\\(?:left|right)\b", ""), (r"\\[dt]frac", r"\\frac"), (r"\\text\{\s*([^{}]*)\}", r" \1"), ("[\u00a0\u202f]", " "))
MARKER_REACH = 80

_number, _fraction, _bold, _marker = re.compile(NUMBER), re.compile(FRACTION), re.compile(BOLD, re.S), re.compile(MARKER, re.I)
_sentence = re.compile(SENTENCE_VALUE.format(number=NUMBER, units=UNITS), re.I | re.M)


def plain(text: str) -> str:
    """``text`` without marks that only lay it out."""
    text = re.sub(SHORT_FRACTION, r"\\\1frac{\2}{\3}", text)
    for pattern, new in LAYOUT:
        text = re.sub(pattern, new, text)
    return text


def _ratio(m: re.Match[str]) -> Fraction | None:
    if m["over"] is not None:
        return Fraction(int(m["over"]), int(m["under"])) if int(m["under"]) else None
    if not int(m["bottom"]):
        return None
    part = int(m["whole"] or 0) + Fraction(int(m["top"]), int(m["bottom"]))
    return -part if m["sign"] else part


def whole_value(text: str | None) -> Fraction | None:
    """The value of a text that is one number or fraction and nothing else but layout, a unit or a final stop."""
    clean = re.sub(rf"\s*(?:\\?%|{UNITS})?\s*\.?\s*\Z", "", plain(text or "").strip().strip("*"), count=1, flags=re.I)
    if m := _fraction.fullmatch(clean):
        return _ratio(m)
    return Fraction(clean.replace(",", "")) if _number.fullmatch(clean) else None


def values_in(text: str) -> list[Fraction]:
    """Values of a short fragment in order: its fractions if there are any, which no bare integer may stand for, else its numbers."""
    clean = plain(text)
    if parts := list(_fraction.finditer(clean)):
        return [v for m in parts if (v := _ratio(m)) is not None]
    if "\\frac" in clean:
        return []
    return [Fraction(n.replace(",", "")) for n in _number.findall(clean)]


def boxed_body(text: str) -> str | None:
    """Body of the last boxed group, as far as its braces go."""
    starts = [m.end() for m in re.finditer(r"boxed\s*\{", text)]
    if not starts:
        return None
    depth = 1
    for at in range(starts[-1], len(text)):
        depth += (text[at] == "{") - (text[at] == "}")
        if not depth:
            return text[starts[-1] : at]
    return text[starts[-1] :]


def stated_values(text: str | None) -> Iterator[Fraction]:
    """Values at the places that state an answer: a boxed body, the last bold span with a number, what follows the
    last marker; unless there is a box or a marker also the end of a sentence, else the last number of all (a bold
    heading with a number doesn't hide a plain answer)."""
    text = text or ""
    if (whole := whole_value(text)) is not None:
        yield whole
        return
    sure = False
    if (body := boxed_body(text)) is not None:
        dollars = re.findall(rf"\$\s*({NUMBER})", body)
        for v in [Fraction(d.replace(",", "")) for d in dollars] or values_in(body):
            yield v
    for span in reversed(_bold.findall(text)):
        if found := values_in(span):
            yield found[-1]
            break
    if marks := list(_marker.finditer(text)):
        if found := values_in(text[marks[-1].end() : marks[-1].end() + MARKER_REACH]):
            sure = True
            yield found[0]
    if sure or body is not None:
        return
    clean = plain(text.replace("**", ""))
    if ends := _sentence.findall(clean):
        yield Fraction(ends[-1].replace(",", ""))
    elif found := values_in(clean):
        yield found[-1]


def formula(text: str | None) -> str:
    """A formula's text without layout, spaces, a final stop and enclosing emphasis."""
    return re.sub(r"\s+", "", plain(text or "").strip().strip("*")).removesuffix(".")


def same_answer(text: str | None, truth: str | None, within: float = 1e-9) -> bool:
    """Whether a generation states ``truth``: by value where the truth is a number, else by its formula's text."""
    if truth is None or text is None:
        return False
    want = whole_value(truth)
    if want is not None:
        return any(abs(v - want) <= within * max(1, abs(want)) for v in stated_values(text))
    places = [text, boxed_body(text)] + [text[m.end() :].split("\n")[0].lstrip(" :=") for m in list(_marker.finditer(text))[-1:]]
    return any(formula(p) == formula(truth) for p in places if p is not None)
