"""Instruction following: checkers as column expressions, strict and loose grading, reports.

A row has a response, ``instruction_ids array<string>`` and ``kwargs array<map<string,string>>``
(one map per instruction). ``grade`` adds one flag per instruction, strict and loose.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.language import Languages
from ..functions.sentences import Boundaries
from ..functions.text import all_found, bound, quoted, regex, strip

Args = Callable[[str], Column]
_CHECKS: dict[str, Callable[[Column, Args], Column]] = {}
# Patterns that define the rules.
BULLET_LINES = (r"^\s*\*[^\*].*$", r"^\s*-.*$")
HIGHLIGHTS = (r"\*[^\n\*]*\*", r"\*\*[^\n\*]*\*\*")
PARAGRAPH_MARK = r"\s?\*\*\*\s?"
PLACEHOLDER = r"\[.*?\]"
POSTSCRIPTS = {"P.P.S": r"\s*p\.\s?p\.\s?s.*$", "P.S.": r"\s*p\.\s?s\..*$"}
SECTION = (r"\s?", r"\s?\d+\s?")
TITLE = r"<<[^\n]+>>"
RESPONSE_MARK = r"\*{6}"
WORD = r"\w+"
# Shortened words whose full stop ends no sentence.
ABBREVIATIONS = ("Dr", "Mr", "Mrs", "Ms", "Prof", "Sr", "Jr", "St", "vs", "Inc", "Ltd", "Co", "No", "e.g", "i.e", "U.S", "a.m", "p.m")
SENTENCE_END = (
    r"(?:[!?][.!?]*|(?<!\.|\b(?:[A-Z]|" + "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS) + r"))\.(?!\.)|(?<!\.)\.{2,}(?!\S*\s+[a-z]))"
    r"""["')\]\u201d\u2019]*\s+(?=\S)"""
)
_MARKS = r"""\s,;:@#$%&?!"()\[\]{}<>"""
CAPITAL_WORD = rf"(?<![^{_MARKS}])(?=[^{_MARKS}]*\p{{Lu}})[^{_MARKS}\p{{Ll}}]+(?![^{_MARKS}])"
CONTRACTION = r"(?i)(?<=\w)(n't|(?<!n)'(?:s|m|d|ll|re|ve))(?!\w)"
#: Rules that ask for a text's language, each with the part that is decided without it.
LANGUAGE: dict[str, Callable[[Column], Column]] = {
    "language:response_language": lambda v: F.lit(True),
    "change_case:english_capital": lambda v: (F.upper(v) == v) & (F.lower(v) != v),
    "change_case:english_lowercase": lambda v: (F.lower(v) == v) & (F.upper(v) != v),
}


def check(name: str):
    def keep(f):
        _CHECKS[name] = f
        return f

    return keep


#: Rules that can be checked but that no list of instructions offers.
UNLISTED = ("startend:constrained_start", "detectable_format:rephrase", "detectable_content:rephrase_paragraph", "keywords:key_sentences")


def list_instructions(unlisted: bool = False) -> list[str]:
    return sorted(k for k in (*_CHECKS, JSON, *LANGUAGE) if unlisted or k not in UNLISTED)


def _int(args: Args, name: str) -> Column:
    return args(name).cast("int")


def _list(args: Args, name: str) -> Column:
    """A list argument, kept as a JSON array of strings."""
    return F.from_json(args(name), "array<string>")


def _count(v: Column, pattern: str, flags: str = "") -> Column:
    return F.regexp_count(v, F.lit(regex(pattern, flags)))


def _compare(n: Column, args: Args, limit: str, relation: str = "relation") -> Column:
    return F.when(args(relation) == "less than", n < _int(args, limit)).otherwise(n >= _int(args, limit))


def _filled(c: Column) -> Column:
    """Whether anything but white space is there; the search ends at the first such character."""
    return F.rlike(c, F.lit(regex(r"\S")))


@check("keywords:existence")
def _existence(v, a):
    return F.forall(_list(a, "keywords"), lambda k: F.regexp_like(v, F.concat(F.lit("(?dUiu)"), k)))


@check("keywords:frequency")
def _frequency(v, a):
    return _compare(F.regexp_count(v, F.concat(F.lit("(?dUiu)"), a("keyword"))), a, "frequency")


@check("keywords:forbidden_words")
def _forbidden(v, a):
    return ~F.exists(_list(a, "forbidden_words"), lambda k: F.regexp_like(v, F.concat(F.lit(r"(?dUiu)\b"), k, F.lit(r"\b"))))


@check("keywords:letter_frequency")
def _letters(v, a):
    low = F.lower(v)
    return _compare(F.length(low) - F.length(F.replace(low, F.lower(a("letter")), F.lit(""))), a, "let_frequency", "let_relation")


@check("length_constraints:number_words")
def _words(v, a):
    return _compare(_count(v, WORD), a, "num_words")


SENTENCES = "length_constraints:number_sentences"


@check(SENTENCES)
def _sentences(v, a):
    """Ends of sentences that more text follows, and the last sentence."""
    return _compare(_count(strip(v), SENTENCE_END) + 1, a, "num_sentences")


@check("length_constraints:number_paragraphs")
def _paragraphs(v, a):
    parts = F.split(v, regex(PARAGRAPH_MARK), -1)
    n = F.size(parts)
    inner = F.forall(F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))), _filled)
    ends = F.when(n > 1, (~_filled(F.element_at(parts, 1))).cast("int") + (~_filled(F.element_at(parts, -1))).cast("int")).otherwise((~_filled(F.element_at(parts, 1))).cast("int"))
    return inner & (n - ends == _int(a, "num_paragraphs"))


@check("length_constraints:nth_paragraph_first_word")
def _nth(v, a):
    parts = F.split(v, "\n\n", -1)
    n = F.size(F.filter(parts, _filled))
    own = strip(F.try_element_at(parts, _int(a, "nth_paragraph")))
    word = F.regexp_extract(F.regexp_replace(F.regexp_extract(own, regex(r"^(\S+)"), 1), r"^'*\"*", ""), r"^([^.,?!'\"]*)", 1)
    return F.coalesce((_int(a, "nth_paragraph") <= n) & (F.length(own) > 0) & (n == _int(a, "num_paragraphs")) & (F.lower(word) == F.lower(a("first_word"))), F.lit(False))


@check("detectable_content:number_placeholders")
def _placeholders(v, a):
    return _count(v, PLACEHOLDER) >= _int(a, "num_placeholders")


@check("detectable_content:postscript")
def _postscript(v, a):
    low, mark = F.lower(v), a("postscript_marker")
    other = F.regexp_like(low, F.concat(F.lit(r"(?dUm)\s*"), quoted(F.lower(mark)), F.lit(".*$")))
    return F.when(mark == "P.P.S", low.rlike(regex(POSTSCRIPTS["P.P.S"], "m"))).when(mark == "P.S.", low.rlike(regex(POSTSCRIPTS["P.S."], "m"))).otherwise(other)


@check("detectable_format:number_bullet_lists")
def _bullets(v, a):
    return sum(_count(v, p, "m") for p in BULLET_LINES) == _int(a, "num_bullets")


@check("detectable_format:constrained_response")
def _constrained(v, a):
    return F.exists(_list(a, "options"), lambda o: F.contains(strip(v), o))


@check("detectable_format:number_highlighted_sections")
def _highlights(v, a):
    kept = lambda p: F.size(F.filter(all_found(v, p, 0), lambda h: _filled(F.regexp_replace(h, r"^\*+|\*+$", ""))))
    return sum(map(kept, HIGHLIGHTS)) >= _int(a, "num_highlights")


@check("detectable_format:multiple_sections")
def _sections(v, a):
    return F.regexp_count(v, F.concat(F.lit(regex(SECTION[0])), a("section_spliter"), F.lit(SECTION[1]))) >= _int(a, "num_sections")


JSON = "detectable_format:json_format"
FENCE = r"^```(?:json|Json|JSON)?|```$"


def _parses(text: str | None) -> bool:
    try:
        json.loads(text or "")
        return True
    except ValueError:
        return False


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _json_flags(texts: pd.Series) -> pd.Series:
    """Whether each text, without a fence around it, is JSON. The built-in parser passes over what follows a value."""
    return pd.Series([None if xs is None else [_parses(re.sub(FENCE, "", (x or "").strip()).strip()) for x in xs] for xs in texts], dtype=object)


@check("detectable_format:title")
def _title(v, a):
    return F.exists(all_found(v, TITLE, 0), lambda t: _filled(F.regexp_replace(t, r"^<+|>+$", "")))


@check("combination:two_responses")
def _two(v, a):
    parts = F.split(v, RESPONSE_MARK, -1)
    full = F.filter(parts, _filled)
    inner = F.forall(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), _filled)
    return inner & (F.size(full) == 2) & (strip(F.element_at(full, 1)) != strip(F.element_at(full, -1)))


@check("combination:repeat_prompt")
def _repeat(v, a):
    return F.startswith(F.lower(strip(v)), F.lower(strip(a("prompt_to_repeat"))))


@check("startend:end_checker")
def _end(v, a):
    return F.endswith(F.lower(F.regexp_replace(strip(v), r'^"+|"+$', "")), F.lower(strip(a("end_phrase"))))


@check("startend:quotation")
def _quoted(v, a):
    s = strip(v)
    return (F.length(s) > 1) & F.startswith(s, F.lit('"')) & F.endswith(s, F.lit('"'))


@check("change_case:capital_word_frequency")
def _capitals(v, a):
    """Words without small letters; a hyphenated word is one, a contraction two."""
    return _compare(_count(F.regexp_replace(v, CONTRACTION, " $1"), CAPITAL_WORD), a, "capital_frequency", "capital_relation")


@check("punctuation:no_comma")
def _no_comma(v, a):
    return ~F.contains(v, F.lit(","))


@check("startend:constrained_start")
def _start(v, a):
    return F.regexp_like(v, F.concat(F.lit(r"(?dUm)^\s*"), a("starter"), F.lit(".*$")))


@check("detectable_format:rephrase")
def _rephrase(v, a):
    """Equal texts but for what stands between asterisks on a line; a response without such a change fails."""
    change = regex(r"\*.*\*")
    return F.rlike(v, F.lit(change)) & (F.regexp_replace(v, change, "") == F.regexp_replace(a("original_message"), change, ""))


@check("detectable_content:rephrase_paragraph")
def _rephrase_paragraph(v, a):
    """The words shared with a paragraph, each as often as in both, lie in a range."""

    def numbered(c: Column) -> Column:
        """Each word with its number among its equals, so that a multiset is a set."""
        w = F.array_sort(all_found(F.lower(c), WORD, 0))
        return F.transform(w, lambda x, i: F.concat(x, F.lit("#"), (i - F.array_position(w, x)).cast("string")))

    return F.size(F.array_intersect(numbered(a("original_paragraph")), numbered(v))).between(_int(a, "low"), _int(a, "high"))


@check("keywords:key_sentences")
def _key_sentences(v, a):
    """As many of the key sentences as asked for stand in the response as whole sentences."""
    parts = F.transform(F.split(F.regexp_replace(strip(v), regex(f"({SENTENCE_END})"), "$1\x00"), "\x00"), strip)
    return F.size(F.filter(F.array_distinct(_list(a, "key_sentences")), lambda k: F.array_contains(parts, k))) == _int(a, "num_sentences")


def _undecided(value: Column, name: str, decided: Column, tongue: Column | None, asked: Column) -> Column:
    """False where a language rule fails without a look at the language, else by the detected language, null where there is none."""
    own = F.lit(None).cast("string") if tongue is None else tongue
    right = own == (F.lower(asked) if name == "language:response_language" else F.lit("en"))
    return F.when(F.coalesce(_filled(value) & decided, F.lit(False)), right).otherwise(False)


def follows(instruction: str, response: Column, languages: Languages | None = None, sentences: Boundaries | None = None, **args) -> Column:
    """Whether a response follows one instruction with fixed arguments (lists as JSON text); null where its language decides and isn't known."""
    if instruction in LANGUAGE:
        return _undecided(response, instruction, LANGUAGE[instruction](response), languages.of(response) if languages else None, F.lit(args.get("language")))
    if instruction == JSON:
        return F.element_at(_json_flags(F.array(response)), 1)
    check = (lambda v, a: _compare(sentences.ends(v) + 1, a, "num_sentences")) if sentences and instruction == SENTENCES else _CHECKS[instruction]
    return F.coalesce(_filled(response) & check(response, lambda k: F.lit(args.get(k))), F.lit(False))


def variants(response: Column) -> Column:
    """A response with and without its first and last line and its asterisks: the eight loose readings, from one split into lines."""

    def plain(lines: Column) -> Column:
        n = F.size(lines)
        join = lambda start, size: strip(F.array_join(F.slice(lines, F.lit(start), F.greatest(size, F.lit(0))), "\n"))
        return F.array(response, join(2, n - 1), join(1, n - 1), join(2, n - 2))

    bare = lambda texts: F.transform(texts, lambda t: F.replace(t, F.lit("*"), F.lit("")))
    return bound(bound(F.split(response, "\n", -1), plain), lambda texts: F.concat(texts, bare(texts)))


def _dispatch(value: Column, is_json: Column, tongue: Column, name: Column, args: Column, sentences: Boundaries | None) -> Column:
    out = F.when(name == JSON, is_json)
    for k, f in _CHECKS.items():
        if k == SENTENCES and sentences:
            out = out.when(name == k, _compare(sentences.ends(value) + 1, lambda a: args[a], "num_sentences"))
        else:
            out = out.when(name == k, f(value, lambda a: args[a]))
    known = F.coalesce(_filled(value) & out.otherwise(F.raise_error(F.concat(F.lit("unknown instruction "), name)).cast("boolean")), F.lit(False))
    language = F.when(F.lit(False), F.lit(False))
    for k, f in LANGUAGE.items():
        language = language.when(name == k, _undecided(value, k, f(value), tongue, args["language"]))
    return F.when(name.isin(*LANGUAGE), language).otherwise(known)


def grade(df: DataFrame, response: str = "response", languages: Languages | None = None, sentences: Boundaries | None = None) -> DataFrame:
    """Adds strict and loose (array<boolean>, one flag per instruction). A null response follows nothing.

    ``languages`` and ``sentences`` are learned models (``functions.language``, ``functions.sentences``). Where a text's
    language decides and isn't known with confidence, or no model is given, the flag is null; the scores and reports pass over such
    flags. Without a model, sentences end by fixed rules. An unknown instruction is an error.
    """
    texts = variants(F.col(response))
    # only rows that ask for JSON or for a language pay for its parser, and plans that never ask hold none
    json_asked = F.array_contains("instruction_ids", JSON)
    asks = F.arrays_overlap("instruction_ids", F.array(*map(F.lit, LANGUAGE)))
    tongues = F.when(asks, languages.of_all(F.when(asks, texts))) if languages else F.lit(None).cast("array<string>")
    out = df.withColumns({"_json": F.when(json_asked, _json_flags(F.when(json_asked, texts))), "_tongues": tongues})
    # the strict flags don't go by way of the readings, which a plan without the loose ones then never makes
    strict = bound(F.col(response), lambda v: F.zip_with("instruction_ids", "kwargs", lambda i, k: _dispatch(v, F.get("_json", F.lit(0)), F.get("_tongues", F.lit(0)), i, k, sentences)))
    # the readings are made once a row, not once an instruction, and equal ones are checked once
    readings = F.array_distinct(F.transform(texts, lambda t, n: F.struct(t.alias("t"), F.get("_json", n).alias("j"), F.get("_tongues", n).alias("l"))))
    loose = bound(readings, lambda rs: F.zip_with("instruction_ids", "kwargs", lambda i, k: F.exists(rs, lambda r: _dispatch(r["t"], r["j"], r["l"], i, k, sentences))))
    return out.withColumns({"strict": strict, "loose": loose}).drop("_json", "_tongues")


def accuracy_scores(graded: DataFrame, modes: tuple[str, ...] = ("strict", "loose")) -> DataFrame:
    """strict and loose × prompt and instruction accuracy over decided flags, NaN without any; a prompt that an undecided flag leaves open isn't counted.

    Flags of a mode that isn't among ``modes`` aren't made.
    """
    aggs = []
    for m in modes:
        aggs.append(F.avg(F.forall(m, lambda x: x).cast("double")))
        aggs.append(F.try_divide(F.sum(F.size(F.filter(m, lambda x: x))), F.sum(F.size(F.filter(m, lambda x: x.isNotNull())))))
    wide = graded.agg(*[F.coalesce(a, F.lit(float("nan"))).alias(f"{m}_{k}_accuracy") for a, (m, k) in zip(aggs, ((m, k) for m in modes for k in ("prompt", "instruction")))])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in wide.columns])))


def report(graded: DataFrame, mode: str = "strict") -> DataFrame:
    """Accuracy by instruction family (before the colon) and by instruction: tier, id, total (decided flags), correct."""
    each = graded.select(F.explode(F.arrays_zip("instruction_ids", mode)).alias("x")).select(F.col("x.instruction_ids").alias("id"), F.col(f"x.{mode}").cast("int").alias("ok"))
    tiers = each.select(F.explode(F.array(F.struct(F.lit(0).alias("tier"), F.substring_index("id", ":", 1).alias("id")), F.struct(F.lit(1).alias("tier"), F.col("id").alias("id")))).alias("t"), "ok")
    return tiers.groupBy("t.tier", "t.id").agg(F.count("ok").alias("total"), F.coalesce(F.sum("ok"), F.lit(0)).alias("correct"))


def symmetric_conflicts(edges: DataFrame) -> DataFrame:
    """Conflict pairs (a, b) made symmetric and reflexive."""
    nodes = edges.select("a").union(edges.select("b"))
    return edges.select("a", "b").union(edges.select("b", "a")).union(nodes.selectExpr("a", "a as b")).distinct()
