"""Extraction from generations: tool calls, code, reasoning, normalised formulas, word overlap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import all_found, found, regex, strip

# Think tags in the order they are looked for, and an empty block that reasoning may begin with.
THINK_TAGS = ("ifm|think", "ifm|think_fast", "ifm|think_faster", "think", "think_fast", "think_faster")
EMPTY_THINK = r"\A<think(?:_fast|_faster)?>\s*</think(?:_fast|_faster)?>\s*"


# What a formula's layout is replaced by, in order.
PLAIN_FORMS = (("\n", ""), ("\\!", ""), ("\\\\", "\\"), ("tfrac", "frac"), ("dfrac", "frac"), ("\\left", ""), ("\\right", ""), ("^{\\circ}", ""), ("^\\circ", ""), ("\\$", ""), ("\\%", ""))


def _json_text(c: Column) -> Column:
    """A string as JSON text."""
    return F.regexp_replace(F.to_json(F.array(c)), r"\A\[|\]\z", "")


def _call(block: Column, number: Column, prefix: str) -> Column:
    p = F.from_json(block, "name string, arguments string")
    return F.struct(F.concat(F.lit(prefix), number.cast("string")).alias("id"), p["name"].alias("name"), F.coalesce(p["arguments"], F.lit("{}")).alias("arguments"))


def _tagged_call(block: Column, number: Column) -> Column:
    """A call written as a name and key and value elements; values that are JSON stay JSON, others become strings."""
    pairs = F.map_entries(argument_pairs(block, r"ifm\|"))
    body = F.array_join(F.transform(pairs, lambda e: F.concat(_json_text(e["key"]), F.lit(":"), F.when(F.try_parse_json(e["value"]).isNotNull(), e["value"]).otherwise(_json_text(e["value"])))), ",")
    return F.struct(F.concat(F.lit("call_ifm_"), number.cast("string")).alias("id"), strip(F.substring_index(block, "<ifm|arg_key>", 1)).alias("name"), F.concat(F.lit("{"), body, F.lit("}")).alias("arguments"))


def tool_calls(c: Column) -> Column:
    """Calls in tool-call blocks, as JSON with a name or, in ifm blocks, as tagged elements: array of id, name, arguments (JSON text)."""
    blocks = all_found(c, r"<tool_call>\s*(.*?)\s*</tool_call>", flags="s")
    tagged = all_found(c, r"<ifm\|tool_call>\s*(.*?)\s*</ifm\|tool_call>", flags="s")
    first = F.transform(blocks, lambda b, i: _call(b, i, "call_"))
    second = F.transform(tagged, lambda b, i: F.when(F.startswith(b, F.lit("{")), _call(b, i, "call_ifm_")).otherwise(_tagged_call(b, i)))
    return F.filter(F.concat(first, second), lambda x: F.length(x["name"]) > 0)


def argument_pairs(c: Column, prefix: str = "") -> Column:
    """Key and value elements of an XML-style call as a map; a repeated key keeps its last value."""
    kind = rf"(?:<{prefix}arg_type>\s*.*?\s*</{prefix}arg_type>\s*)?"
    p = rf"<{prefix}arg_key>\s*(.*?)\s*</{prefix}arg_key>\s*{kind}<{prefix}arg_value>\s*(.*?)\s*</{prefix}arg_value>"
    pairs = F.arrays_zip(all_found(c, p, 1, "s").alias("k"), all_found(c, p, 2, "s").alias("v"))
    last = F.reverse(pairs)
    names = F.array_distinct(F.transform(pairs, lambda x: x["k"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n, F.element_at(F.filter(last, lambda x: x["k"] == n), 1)["v"])))


def split_think(c: Column) -> Column:
    """Struct of reasoning and answer at the first closing tag of the first kind that occurs; no tag: all is answer."""
    edges = lambda x: F.regexp_replace(x, r"\A\n+|\n+\z", "")
    trim = lambda x: edges(F.regexp_replace(edges(x), EMPTY_THINK, ""))
    text = F.coalesce(c, F.lit(""))
    out = F.struct(F.lit("").alias("reasoning"), text.alias("answer"))
    for tag in reversed(THINK_TAGS):
        before = F.substring_index(text, f"</{tag}>", 1)
        after = F.regexp_replace(text, rf"(?s)\A.*?</\Q{tag}\E>\n*", "")
        inner = F.when(F.contains(before, F.lit(f"<{tag}>")), F.substring_index(before, f"<{tag}>", -1)).otherwise(before)
        out = F.when(F.contains(text, F.lit(f"</{tag}>")), F.struct(trim(inner).alias("reasoning"), after.alias("answer"))).otherwise(out)
    return out


def fenced_code(c: Column) -> Column:
    """First fenced block of any language; after an open fence all that follows; else empty."""
    fence = r"```[A-Za-z0-9_+-]*\s*\n"
    return F.coalesce(strip(F.coalesce(found(c, fence + r"(.*?)\n?```", flags="s"), found(c, fence + r"(.*)\z", flags="s"))), F.lit(""))


def function_body(c: Column, name: str) -> Column:
    """A completion without the definition line of ``name`` that it repeats, and its docstring."""
    head = rf"(?s)\A\s*def\s+\Q{name}\E\s*\(.*?\)\s*(?:->.*?)?:\s*\n"
    body = F.regexp_replace(F.regexp_replace(c, head, ""), r'(?s)\A\s*""".*?"""\s*\n', "")
    return F.when(c.rlike(head), body).otherwise(c)


def normal_formula(c: Column) -> Column:
    """A formula's text without spacing, units and sizing marks, with full fraction and root braces."""
    out = F.coalesce(found(strip(c), r"\A\\text\{(.+?)\}\z"), strip(c))
    for old, new in PLAIN_FORMS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, r"\\text\{ .*\z", "")
    out = F.regexp_replace(out, r"(^|[ {])\.(?=\d)", "$10.")
    out = F.regexp_replace(out, r"\A[^=]{0,2}=([^=]*)\z", "$1")
    out = F.regexp_replace(out, r"\\sqrt([^{])", "\\\\sqrt{$1}")
    out = F.replace(out, F.lit(" "), F.lit(""))
    out = F.regexp_replace(out, r"\\frac(\d)(\d)", "\\\\frac{$1}{$2}")
    out = F.when(out == "0.5", F.lit("\\frac{1}{2}")).otherwise(out)
    return F.regexp_replace(out, r"\A(-?\d+)/(\d+)\z", "\\\\frac{$1}{$2}")


# Units that say nothing about a value, and words and marks that stand for numbers and signs.
UNIT_WORDS = ("degree", "cm", "centimeter", "meter", "mile", "second", "minute", "hour", "day", "week", "month", "year", "foot", "feet", "inch", "yard")
VALUE_WORDS = (("\\%", "%"), ("\\$", "$"), ("$", ""), ("%", ""), (" or ", " , "), (" and ", " , "), ("million", "*10^6"), ("billion", "*10^9"), ("trillion", "*10^12"))
SIGNS = ((r"\\[dt]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", "$1/$2"), (r"\\[dt]?frac\s*(\d)\s*(\d)", "$1/$2"), (r"\\sqrt\s*\{([^{}]*)\}", "sqrt($1)"), (r"\\text\s*\{([^{}]*)\}", "$1"), (r"\\pi\b", "pi"), (r"\\infty\b", "inf"), (r"\\cup\b", "U"), (r"\\(?:cdot|times)\b", "*"), (r"\\(?:left|right)\b", ""), (r"\\[a-zA-Z]+|\\.", ""))


def plain_value(c: Column) -> Column:
    """An answer's text without units, currency, braces, spaces and case; whole numbers without commas and decimals.

    Fractions, roots and the usual signs are written plainly, as far as braces aren't nested; other commands go.
    """
    out = F.coalesce(found(c, r"\A\\text\{(.+?)\}\z"), c)
    for old, new in VALUE_WORDS:
        out = F.replace(out, F.lit(old), F.lit(new))
    for unit in UNIT_WORDS:
        out = F.regexp_replace(out, rf"{unit}(?:es)?s? *(?:\^[0-9]+)?", "")
    out = F.regexp_replace(out, r"\^ *\\circ", "")
    out = F.regexp_replace(out, r"(?s)\A\{(.*)\}\z", "$1")
    out = F.regexp_replace(out, r",\\! *", "")
    whole = lambda t: F.when((F.abs(t.try_cast("double")) < 1e15) & (F.abs(t.try_cast("double") - F.round(t.try_cast("double"))) <= 1e-7), F.round(t.try_cast("double")).cast("bigint").cast("string"))
    out = F.coalesce(whole(out), out)
    for pattern, new in SIGNS:
        out = F.regexp_replace(out, pattern, new)
    out = F.regexp_replace(F.regexp_replace(strip(out), "- *", "-"), "([0-9]) +([0-9])", "$1+$2")
    out = F.lower(F.regexp_replace(out, "[ {}]", ""))
    bare = F.regexp_replace(out, r"(?<=\d),(?=\d{3}(?!\d))", "")
    return F.coalesce(whole(bare), out)


def tuple_parts(c: Column) -> Column:
    """Comma-separated parts of a bracketed tuple or interval, trimmed; other text is one part."""
    inner = found(strip(c), r"\A[\(\[](.*)[\)\]]\z", flags="s")
    return F.when(inner.isNotNull() & F.contains(inner, F.lit(",")), F.transform(F.split(inner, ","), strip)).otherwise(F.array(strip(c)))


def job_parts(c: Column) -> Column:
    """Name and instance of a job name ``name--instance``; NULL for another form."""
    p = regex(r"\A(.+)--([^-]+)\z")
    return F.when(c.rlike(p), F.struct(F.regexp_extract(c, p, 1).alias("name"), F.regexp_extract(c, p, 2).alias("instance")))
