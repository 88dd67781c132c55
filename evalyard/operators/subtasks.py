"""Answers of the 27 hard-benchmark subtasks: each kind of subtask has one way to find its answer."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The subtasks by kind and the patterns of their answers.
CHOICE_TASKS = (
    "date_understanding", "disambiguation_qa", "geometric_shapes", "hyperbaton", "logical_deduction_five_objects",
    "logical_deduction_seven_objects", "logical_deduction_three_objects", "movie_recommendation", "penguins_in_a_table",
    "reasoning_about_colored_objects", "ruin_names", "salient_translation_error_detection", "snarks", "temporal_sequences",
    "tracking_shuffled_objects_five_objects", "tracking_shuffled_objects_seven_objects", "tracking_shuffled_objects_three_objects",
)
WORD_PATTERNS = {
    "boolean_expressions": r"\b(True|False)\b",
    "causal_judgement": r"\b(Yes|No|yes|no)\b",
    "formal_fallacies": r"\b(valid|invalid)\b",
    "multistep_arithmetic_two": r"([-0-9]+)",
    "navigate": r"\b(Yes|No|yes|no)\b",
    "object_counting": r"([-0-9]+)",
}
PHRASES = {
    "sports_understanding": {"no": r"\b(?:no|not plausible)\b", "yes": r"\b(?:yes|plausible)\b"},
    "web_of_lies": {"no": r"\b(?:no|does not tell the truth|is not telling the truth)\b", "yes": r"\b(?:yes|tells the truth|is telling the truth)\b"},
}
LETTER, CHOICE = r"\([A-Z]\)", r"\([A-Z]\)([^\n^(]*)"
BRACKETS, SPACING, CLOSERS = r'[\s"\[\](){}<>]+', r"\\(?:[,;:! ]|q?quad)", set(")]}>")
QUESTION = r"\bQ:\s*"
INVALID = "[invalid]"


def question_of(prompt: str | None) -> str:
    """The last question of a few-shot prompt, up to its answer mark; a prompt without marks is the question."""
    parts = re.split(QUESTION, prompt or "")
    return parts[-1].split("\nA:")[0].strip() if len(parts) > 1 else parts[0]


def _folded(text: str) -> str:
    return "".join(c for c in text.lower() if not unicodedata.category(c).startswith("P"))


def _last(pattern: str, text: str) -> str | None:
    found = re.findall(pattern, text)
    return found[-1] if found else None


def _choice(question: str, answer: str) -> str | None:
    """A bracketed letter; else a choice's text, else its letter after a colon; the last of each."""
    if letter := _last(LETTER, answer):
        return letter
    texts = [_folded(c.strip()) for c in re.findall(CHOICE, question)]
    letters = {t: f"({chr(65 + k)})" for k, t in enumerate(texts)}
    named = [t for t in texts if t]
    if named and (hit := _last("|".join(map(re.escape, named)), _folded(answer))):
        return letters[hit.strip()] if hit.strip() in letters else hit.strip()
    bare = _last(rf":\s*([{''.join(chr(65 + k) for k in range(len(texts)))}])", answer) if texts else None
    return bare and f"({bare})"


def _sorted_words(question: str, answer: str) -> str | None:
    """The question's words in the order of their last occurrence in the answer."""
    if "List:" not in question:
        return None
    words = question.split("List:")[1].split()
    if not words:
        return None
    seen = re.findall("|".join(rf"\b{re.escape(w)}\b" for w in words), answer)
    return " ".join(reversed(list(dict.fromkeys(reversed(seen)))))


def _completion(answer: str) -> str | None:
    """The last run of brackets that only closes; whole words, which also open, aren't completions."""
    runs = ("".join(r.split()) for r in re.findall(BRACKETS, re.sub(SPACING, " ", answer)))
    closing = [r for r in runs if r and set(r) <= CLOSERS]
    return closing[-1] if closing else None


def pick(task: str | None, question: str, answer: str | None) -> str | None:
    """What an answer states in its subtask, ``INVALID`` where it states nothing; None for an unknown subtask."""
    answer = answer or ""
    if task in WORD_PATTERNS:
        found = _last(WORD_PATTERNS[task], answer)
    elif task in PHRASES:
        said = _last("|".join(PHRASES[task].values()), answer.lower())
        found = said and next(v for v, p in PHRASES[task].items() if re.search(p, said))
    elif task in CHOICE_TASKS:
        found = _choice(question, answer)
    elif task == "word_sorting":
        found = _sorted_words(question, answer)
    elif task == "dyck_languages":
        found = _completion(answer)
    else:
        return None
    return INVALID if found is None else found.strip()


def normalised(text: str) -> str:
    """Without a final full stop, commas, backslashes, line feeds and quotes; lower case, trimmed."""
    return re.sub(r'\.$|[,\\\n"]', "", text).lower().strip()


@F.pandas_udf(T.StructType([T.StructField("picked", T.ArrayType(T.StringType())), T.StructField("correct", T.ArrayType(T.IntegerType()))]))
def graded(task: pd.Series, prompt: pd.Series, answers: pd.Series, truth: pd.Series) -> pd.DataFrame:
    """Picked answers and flags of each row."""
    rows = []
    for t, p, xs, want in zip(task, prompt, answers, truth):
        question, want = question_of(p), "" if want is None else str(want)
        form = (lambda s: "".join(s.split())) if t == "dyck_languages" else normalised
        picked = [pick(t, question, a) for a in xs]
        rows.append((picked, [int(a is not None and a != INVALID and bool(form(want)) and form(a) == form(want)) for a in picked]))
    return pd.DataFrame(rows, columns=["picked", "correct"])
