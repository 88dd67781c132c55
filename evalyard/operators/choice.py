"""Choice scoring: likelihoods of given completions, four ways to normalise them, macro and micro scores.

Raw responses, one record a choice, become likelihoods in one grouped plan: ``with_responses`` orders them by their
index and checks them, ``from_responses`` sums the completions' log-probabilities. A row whose responses
can't be used says why in ``choice_problem``; its values are null and no score counts it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import rstrip, strip
from .metrics import macro_micro

VIEWS = ("", "_char", "_token", "_compl")
METRICS = tuple(f"{m}{v}" for m in ("acc", "nll") for v in VIEWS)


def labels(n: Column) -> Column:
    """A, B, C ... for n choices, at most 26."""
    return F.when(n > 26, F.raise_error(F.lit("more than 26 choices")).cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.char(65 + i)))


def truth_index(index: Column, truths: Column, names: Column, completions: Column) -> Column:
    """Index of the right choice: ``index`` where it is given, else that of the first of ``truths`` that is a label or,
    failing that, a completion, both trimmed; no match and an index out of range are errors.

    An integer truth is an index and belongs into ``index``; a text of digits is matched as text.
    """
    trimmed = lambda a: F.transform(a, strip)
    place = lambda a, t: F.nullif(F.array_position(trimmed(a), strip(t)), F.lit(0).cast("bigint")) - 1
    found = F.filter(F.transform(truths, lambda t: F.coalesce(place(names, t), place(completions, t))), lambda i: i.isNotNull())
    got = F.coalesce(index.cast("bigint"), F.try_element_at(found, F.lit(1)))
    return F.when(got.between(0, F.size(names) - 1), got).otherwise(F.raise_error(F.lit("the truth names no choice")).cast("bigint")).cast("int")


def prompts(prefix: Column, completions: Column) -> Column:
    """Prompt of each choice: the prefix without trailing white space, a space and the completion as it is."""
    return F.transform(completions, lambda c: F.concat(rstrip(prefix), F.lit(" "), c))


#: Fixed value: what stands before a completion when its own likelihood is asked for.
COMPLETION_PREFIX = "Answer:"


def scoring_prompts(completions: Column, prefix: Column | None = None, prefixes: Column | None = None, completion_prefix: Column | None = None) -> Column:
    """Struct of two arrays: ``prompts`` in context and ``alone``, the completions behind a neutral prefix.

    ``prefixes`` (one a choice) goes before ``prefix`` where it isn't null; another number of them than of choices is an error.
    """
    one = F.transform(completions, lambda c: prefix) if prefix is not None else F.lit(None).cast("array<string>")
    every = F.coalesce(prefixes, one) if prefixes is not None else one
    joined = F.zip_with(F.transform(every, rstrip), completions, lambda p, c: F.concat(p, F.lit(" "), c))
    fits = F.when(F.size(every) == F.size(completions), joined).otherwise(F.raise_error(F.lit("prefixes and completions differ in number, or there is no prefix")).cast("array<string>"))
    neutral = F.coalesce(completion_prefix, F.lit(COMPLETION_PREFIX)) if completion_prefix is not None else F.lit(COMPLETION_PREFIX)
    return F.struct(fits.alias("prompts"), prompts(neutral, completions).alias("alone"))


def suffix_logprob(offsets: Column, logprobs: Column, start: Column, end: Column) -> Column:
    """Sum of the log-probabilities of the tokens that overlap [start, end); an error without any or if one isn't finite."""
    nexts = F.concat(F.slice(offsets, F.lit(2), F.size(offsets)), F.array(F.lit(2147483647)))
    tokens = F.zip_with(F.arrays_zip(offsets.alias("o"), nexts.alias("x")), logprobs, lambda t, p: F.struct(t["o"].alias("o"), t["x"].alias("x"), p.alias("p")))
    kept = F.filter(tokens, lambda t: (t["o"] < end) & (F.least(t["x"], end) > start))
    bad = (F.size(kept) == 0) | F.exists(kept, lambda t: t["p"].isNull() | F.isnan(t["p"]) | (F.abs(t["p"]) == float("inf")))
    total = F.aggregate(kept, F.lit(0.0), lambda a, t: a + t["p"])
    return F.when(bad, F.raise_error(F.lit("no finite suffix tokens")).cast("double")).otherwise(total)


def is_choice_row(df: DataFrame) -> Column:
    """Rows for choice scoring: their mode says so, and completions and a prompt are there."""
    some = [F.col(c).isNotNull() for c in ("scoring_prompt_prefixes", "scoring_prompt_prefix", "completion_input") if c in df.columns]
    if not {"scoring_mode", "scoring_completions"} <= set(df.columns) or not some:
        return F.lit(False)
    return F.coalesce((F.col("scoring_mode") == "choice_scoring") & F.col("scoring_completions").isNotNull() & reduce(or_, some), F.lit(False))


def token_counts(values: Column, choices: Column) -> Column:
    """Counts given as JSON values or texts: as many as choices, each a positive whole number; true, 1.9 or 0 is an error."""
    number = lambda v: F.when(~F.lower(v).isin("true", "false"), v.try_cast("double"))
    good = lambda v: F.coalesce((number(v) > 0) & (number(v) == F.floor(number(v))) & (number(v) < 2**31), F.lit(False))
    fits = (F.size(values) == choices) & F.forall(values, good)
    return F.when(fits, F.transform(values, lambda v: number(v).cast("int"))).otherwise(F.raise_error(F.lit("token counts must be positive whole numbers, one for each choice")).cast("array<int>"))


def suffix_start(prompt: Column, completion: Column, fallback: Column) -> Column:
    """Where a completion begins in its prompt, with its space if there is one; ``fallback`` where the prompt ends otherwise."""
    spaced = F.concat(F.lit(" "), completion)
    return F.when(F.endswith(prompt, spaced), F.length(prompt) - F.length(spaced)).when(F.endswith(prompt, completion), F.length(prompt) - F.length(completion)).otherwise(fallback)


def counted_suffix_logprob(logprobs: Column, count: Column, tail: Column) -> Column:
    """Sum of the ``count`` log-probabilities before the last ``tail`` ones, where no offsets are given; an error if one is missing."""
    kept = F.slice(logprobs, F.greatest(F.size(logprobs) - tail - count, F.lit(0)) + 1, F.greatest(count, F.lit(0)))
    bad = (F.size(logprobs) - tail < count) | F.exists(kept, lambda p: p.isNull() | F.isnan(p) | (F.abs(p) == float("inf")))
    return F.when(bad, F.raise_error(F.lit("no finite suffix tokens")).cast("double")).otherwise(F.aggregate(kept, F.lit(0.0), lambda a, p: a + p))


PAYLOAD = "struct<token_logprobs:array<double>,text_offset:array<int>,generated_tail_n_tokens:int>"
FULL, ALONE = "choice_scoring_full_logprobs", "choice_scoring_completion_logprobs"
#: Choices have labels A to Z.
MOST_CHOICES = 26


def with_responses(rows: DataFrame, responses: DataFrame, key: str, name: str, prompts: str) -> DataFrame:
    """Adds ``name``, the payloads of a row's responses in the order of its choices, and ``choice_problem``.

    ``responses`` has a record a choice: ``key``, index, text, token_logprobs, text_offset and completion_tokens (of the
    whole request), in any order. The indices must be those of the array ``prompts`` of the row, each once. Where offsets
    are missing, the echoed text says how many generated tokens follow the prompt (none or one), and the
    request's count must confirm it. Records beyond ``MOST_CHOICES`` are counted, not gathered. The gathered arrays are as
    long as the rows are many, and Spark guesses them far too small, so the join is always by shuffle.
    """
    bare = lambda c: F.coalesce(F.size(c) <= 0, F.lit(True))
    fields = ["index", "text", "token_logprobs", "text_offset", "completion_tokens"]
    each = responses.groupBy(key, "index").agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in fields[1:]])
    within = F.col("index").between(0, MOST_CHOICES - 1)
    per = each.groupBy(key).agg(F.sum("_n").alias("_records"), F.count_if(within).alias("_indices"), F.array_sort(F.collect_list(F.when(within, F.struct(*fields)))).alias("_r"))
    df = rows.join(per.hint("merge"), key, "left")
    n, r = F.size(prompts), F.col("_r")
    ordered = (F.col("_records") == n) & (F.col("_indices") == n) & F.forall(F.zip_with(r, F.sequence(F.lit(0), n - 1), lambda x, i: x["index"] == i), lambda ok: F.coalesce(ok, F.lit(False)))
    tails = F.zip_with(r, prompts, lambda x, p: F.when(~bare(x["text_offset"]), 0).when(x["text"] == p, 0).when(F.startswith(x["text"], p), 1))
    df = df.withColumn("_tails", tails)
    sum_of = F.aggregate("_tails", F.lit(0), lambda a, x: a + x)
    some = F.exists(r, lambda x: bare(x["text_offset"]))
    told = F.element_at(r, 1)["completion_tokens"]
    problem = (
        F.when(r.isNull(), "no responses")
        .when(~F.coalesce(ordered, F.lit(False)), "the indices aren't those of the choices")
        .when(F.exists(r, lambda x: x["token_logprobs"].isNull()), "no token log-probabilities")
        .when(some & F.exists("_tails", lambda t: t.isNull()), "the text doesn't echo its prompt")
        .when(some & ~F.coalesce(told == sum_of, F.lit(False)), "the count of generated tokens doesn't fit the texts")
    )
    payloads = F.zip_with(r, "_tails", lambda x, t: F.struct(x["token_logprobs"].alias("token_logprobs"), x["text_offset"].alias("text_offset"), t.alias("generated_tail_n_tokens"))).cast(f"array<{PAYLOAD}>")
    before = F.col("choice_problem") if "choice_problem" in rows.columns else F.lit(None).cast("string")
    df = df.withColumns({name: payloads, "choice_problem": F.coalesce(before, problem)})
    return df.drop("_records", "_indices", "_r", "_tails")


def suffix_of(payload: Column, count: Column, start: Column, prompt: Column) -> Column:
    """Struct of ``total`` and ``tokens`` of a completion's log-probabilities, or the ``problem`` that leaves them null.

    With offsets: the tokens that overlap the prompt from ``start`` to its end. Without: the ``count`` tokens before the generated ones.
    """
    values, tail = payload["token_logprobs"], F.coalesce(payload["generated_tail_n_tokens"], F.lit(0))
    offsets = F.when(F.size(payload["text_offset"]) > 0, payload["text_offset"])
    end = F.length(prompt)
    nexts = F.concat(F.slice(offsets, F.lit(2), F.greatest(F.size(offsets), F.lit(1))), F.array(end))
    tokens = F.zip_with(F.arrays_zip(offsets.alias("o"), nexts.alias("x")), values, lambda t, p: F.struct(t["o"].alias("o"), t["x"].alias("x"), p.alias("p")))
    by_offset = F.transform(F.filter(tokens, lambda t: (t["o"] < end) & (F.least(t["x"], end) > start)), lambda t: t["p"])
    last = F.size(values) - tail
    by_count = F.slice(values, F.greatest(last - count, F.lit(0)) + 1, F.greatest(count, F.lit(0)))
    kept = F.when(offsets.isNotNull(), by_offset).otherwise(by_count)
    disordered = F.exists(F.zip_with(offsets, nexts, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda t: t["a"].isNull() | (t["a"] < 0)) | (F.array_sort(offsets) != offsets)
    problem = (
        F.when(values.isNull(), "no token log-probabilities")
        .when(count <= 0, "the count of tokens isn't positive")
        .when(offsets.isNotNull() & (F.size(offsets) != F.size(values)), "offsets and log-probabilities differ in number")
        .when(offsets.isNotNull() & F.coalesce(disordered, F.lit(True)), "offsets aren't ordered")
        .when(offsets.isNull() & count.isNull(), "neither offsets nor counts of tokens")
        .when(offsets.isNull() & (last < count), "fewer tokens than the completion has")
        .when(F.size(kept) == 0, "no token of the completion")
        .when(F.exists(kept, lambda p: p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))), "a log-probability is missing or isn't finite")
    )
    total = F.when(problem.isNull(), F.aggregate(kept, F.lit(0.0), lambda a, p: a + p))
    return F.struct(total.alias("total"), F.when(problem.isNull(), F.size(kept)).alias("tokens"), problem.alias("problem"))


def _payloads(df: DataFrame, column: str) -> Column:
    """A payload column with all fields of ``PAYLOAD``; those that the records never had are null."""
    had = df.schema[column].dataType.elementType.names
    field = lambda x, name: x[name] if name in had else F.lit(None)
    every = F.transform(column, lambda x: F.struct(*[field(x, name).alias(name) for name in ("token_logprobs", "text_offset", "generated_tail_n_tokens")]))
    return every.cast(f"array<{PAYLOAD}>")


def from_responses(df: DataFrame) -> DataFrame:
    """Adds choice_nll, choice_nll_completion, n_tokens, n_chars, truth_index and choice_problem to rows with raw payloads.

    Rows have scoring_completions, the payload columns ``FULL`` and ``ALONE`` and a prefix, and perhaps labels,
    counts of tokens (``scoring_completion_n_tokens``) and of characters (``scoring_completion_n_chars``), ground_truth and ground_truth_index.
    """
    col = lambda c, kind: F.col(c) if c in df.columns else F.lit(None).cast(kind)
    names = F.col("scoring_completions")
    prefix = F.coalesce(col("scoring_prompt_prefix", "string"), col("completion_input", "string"))
    neutral = F.coalesce(col("scoring_completion_prefix", "string"), F.lit(COMPLETION_PREFIX))
    prefixes = F.coalesce(col("scoring_prompt_prefixes", "array<string>"), F.transform(names, lambda c: prefix))
    built = scoring_prompts(names, prefix, col("scoring_prompt_prefixes", "array<string>"), neutral)
    before = col("choice_problem", "string")
    counts = col("scoring_completion_n_tokens", "array<int>")
    chars = F.coalesce(col("scoring_completion_n_chars", "array<double>"), F.transform(names, lambda c: F.length(c).cast("double")))
    df = df.withColumns({c: _payloads(df, c) for c in (FULL, ALONE)})
    df = df.withColumns({"_built": F.when(before.isNull(), built), "_prefixes": F.transform(prefixes, rstrip)})
    places = F.sequence(F.lit(0), F.size(names) - 1)

    def sums(payloads: str, prompts: Column, prefix_of) -> Column:
        at = lambda i: suffix_of(F.get(payloads, i), F.get(counts, i), suffix_start(F.get(prompts, i), F.get(names, i), F.length(prefix_of(i))), F.get(prompts, i))
        return F.transform(places, at)

    df = df.withColumns({"_full": sums(FULL, F.col("_built.prompts"), lambda i: F.get("_prefixes", i)), "_alone": sums(ALONE, F.col("_built.alone"), lambda i: rstrip(neutral))})
    first = lambda c: F.try_element_at(F.filter(F.transform(c, lambda x: x["problem"]), lambda p: p.isNotNull()), F.lit(1))
    sizes = F.when((F.size(FULL) != F.size(names)) | (F.size(ALONE) != F.size(names)), "payloads and choices differ in number").when(F.exists(chars, lambda c: c <= 0) | (F.size(chars) != F.size(names)), "counts of characters aren't positive or differ in number")
    problem = F.coalesce(before, sizes, first("_full"), first("_alone"))
    minus = lambda c: F.transform(c, lambda x: -x["total"])
    truth = F.array(col("ground_truth", "string")) if dict(df.dtypes).get("ground_truth", "string") == "string" else F.col("ground_truth")
    own = {"choice_problem": problem, "choice_nll": minus("_full"), "choice_nll_completion": minus("_alone"), "n_tokens": F.coalesce(counts, F.transform("_full", lambda x: x["tokens"])), "n_chars": chars}
    if "truth_index" not in df.columns:
        own["truth_index"] = truth_index(col("ground_truth_index", "int"), truth, F.coalesce(col("scoring_completion_labels", "array<string>"), labels(F.size(names))), names)
    return df.withColumns(own).drop("_built", "_prefixes", "_full", "_alone")


def choice_metrics(df: DataFrame) -> DataFrame:
    """Adds picks, flags and values to rows of choice_nll, choice_nll_completion, n_tokens, n_chars and truth_index.

    Ties go to the first choice. Lengths must agree and the values be finite, but for rows with a ``choice_problem``: theirs are null.
    """
    nll = F.col("choice_nll")
    lost = F.col("choice_problem").isNotNull() if "choice_problem" in df.columns else F.lit(False)
    values = {
        "": nll,
        "_char": F.zip_with(nll, "n_chars", lambda a, b: a / b),
        "_token": F.zip_with(nll, "n_tokens", lambda a, b: a / b),
        "_compl": F.zip_with(nll, "choice_nll_completion", lambda a, b: a - b),
    }
    sizes = [F.size(c) for c in ("choice_nll", "choice_nll_completion", "n_tokens", "n_chars")]
    finite = F.forall(nll, lambda x: x.isNotNull() & ~F.isnan(x))
    ok = (F.least(*sizes) == F.greatest(*sizes)) & finite
    out = df.withColumns({f"_v{k}": F.when(lost, F.lit(None).cast("array<double>")).when(ok, v).otherwise(F.raise_error(F.lit("choice lengths differ or values aren't finite")).cast("array<double>")) for k, v in values.items()})
    cols = {}
    for k in VIEWS:
        best = F.array_min(f"_v{k}")
        at = (F.array_position(f"_v{k}", best) - 1).cast("int")
        right = at == F.col("truth_index")
        cols |= {f"picked{k}": at, f"correct{k}": right.cast("int"), f"acc{k}": F.when(right, 100.0).when(~right, 0.0), f"nll{k}": best}
    return out.withColumns(cols).drop(*[f"_v{k}" for k in VIEWS])


def choice_scores(graded: DataFrame, group: str = "choice_group") -> DataFrame:
    """Micro and macro means of the metrics over the rows without a problem."""
    if "choice_problem" in graded.columns:
        graded = graded.where("choice_problem is null")
    return macro_micro(graded, METRICS, group)
