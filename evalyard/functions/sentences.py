"""Sentence boundaries learned from a corpus without marks (Kiss and Strunk's statistics, 2006).

One aggregate over all texts, combined in each task first, counts how often each word form stands with and
without a final full stop. Word forms that almost always carry one, for their length, are abbreviations. A second
aggregate counts how often forms stand behind an end mark that isn't an abbreviation's: those that do so far more often
than by chance begin sentences. Only these two short lists leave Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import regex, strip

# Thresholds of the published method.
ABBREVIATION, STARTER = 0.3, 30.0
_TOKEN = r"[^\s\"()\[\]{}«»“”]+"
_CLOSING = r"[\"')\]}”’»]*"


def _log(x: Column) -> Column:
    return F.log(F.greatest(x, F.lit(1e-300)))


def word_forms(docs: DataFrame, text: str = "text", abbreviations: frozenset[str] = frozenset()) -> DataFrame:
    """form, stopped, plain, starts: each lower-case word form's number with a final full stop, without one, and
    upper-cased behind a token that ends in an end mark and is none of ``abbreviations``."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(regex(_TOKEN)), F.lit(0))
    pairs = F.zip_with(tokens, F.concat(F.array(F.lit("")), tokens), lambda t, before: F.struct(t.alias("t"), before.alias("before")))
    each = docs.select(F.explode(F.filter(pairs, lambda p: p["t"].isNotNull())).alias("p")).select("p.t", "p.before")
    each = each.withColumn("bare", F.regexp_replace("t", regex(r"[,;:!?]+\z"), ""))
    stop = F.endswith("bare", F.lit(".")) & (F.length("bare") > 1)
    ended = F.rlike("before", F.lit(r"[.!?]\z"))
    if abbreviations:
        ended = ended & ~F.lower(F.regexp_replace("before", r"\.\z", "")).isin(*sorted(abbreviations))
    each = each.select(F.lower(F.when(stop, F.expr("left(bare, length(bare) - 1)")).otherwise(F.col("bare"))).alias("form"), stop.alias("stop"), (ended & F.rlike("t", F.lit(r"^\p{Lu}"))).alias("start"))
    each = each.where(F.rlike("form", F.lit(r"^\p{L}[\p{L}.'-]*\z")))
    return each.groupBy("form").agg(F.count_if("stop").alias("stopped"), F.count_if(~F.col("stop")).alias("plain"), F.count_if("start").alias("starts"))


def scored_forms(forms: DataFrame) -> DataFrame:
    """``forms`` with ``abbreviation`` and ``starter``, the two log-likelihood scores."""
    total = forms.agg(F.sum(F.col("stopped") + F.col("plain")).alias("n_all"), F.sum("stopped").alias("n_stops"), F.sum("starts").alias("n_starts"))  # one row
    df = forms.crossJoin(F.broadcast(total))
    n, k = (F.col("stopped") + F.col("plain")).cast("double"), F.col("stopped").cast("double")
    p = F.col("n_stops") / F.col("n_all")
    ratio = -2 * (k * _log(p) + (n - k) * _log(1 - p) - k * F.log(F.lit(0.99)) - (n - k) * F.log(F.lit(0.01)))
    dots = F.length("form") - F.length(F.replace("form", F.lit("."), F.lit("")))
    size = F.length("form") - dots
    abbreviation = ratio * F.exp(-size.cast("double")) * (dots + 1) * F.pow(size.cast("double"), -F.col("plain").cast("double"))
    # how much likelier the form is behind an end mark than elsewhere
    a, s = F.col("starts").cast("double"), F.col("n_starts").cast("double")
    rest, others = n - a, F.col("n_all") - s
    q, q1, q2 = n / F.col("n_all"), a / s, rest / others
    like = lambda c, m, x: c * _log(x) + (m - c) * _log(1 - x)
    starter = F.when((s > 0) & (others > 0) & (q1 > q2), 2 * (like(a, s, q1) + like(rest, others, q2) - like(a, s, q) - like(rest, others, q))).otherwise(0.0)
    return df.select("form", "stopped", "plain", "starts", F.when(F.col("stopped") > 0, abbreviation).otherwise(0.0).alias("abbreviation"), starter.alias("starter"))


@dataclass(frozen=True)
class Boundaries:
    abbreviations: frozenset[str] = field(default_factory=frozenset)
    starters: frozenset[str] = field(default_factory=frozenset)

    def ends(self, text: Column) -> Column:
        """Number of sentence ends that more text follows.

        Exclamation and question marks end a sentence; a full stop does unless it follows an abbreviation or
        a single capital, where only a known beginning of sentences makes it an end; runs of dots before a small letter don't.
        """
        around = rf"(\S*?)([.!?]+){_CLOSING}\s+(?=(\S+))"
        found = lambda k: F.regexp_extract_all(strip(text), F.lit(regex(around)), F.lit(k))
        each = F.arrays_zip(found(1).alias("word"), found(2).alias("mark"), found(3).alias("next"))

        def ends(x: Column) -> Column:
            form = F.lower(F.regexp_replace(x["word"], regex(r"^[^\p{L}\p{N}]+"), ""))
            begins = F.lower(F.regexp_replace(x["next"], regex(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+\z"), ""))
            upper = F.rlike(F.regexp_replace(x["next"], regex(r"^[^\p{L}\p{N}]+"), ""), F.lit(r"^\p{Lu}"))
            short = F.rlike(x["word"], F.lit(r"(?:^|[^\p{L}\p{N}])\p{Lu}\z"))
            if self.abbreviations:
                short = short | form.isin(*sorted(self.abbreviations))
            starts = (upper & begins.isin(*sorted(self.starters))) if self.starters else F.lit(False)
            small = F.rlike(x["next"], F.lit(r"^\p{Ll}"))
            return F.when(F.rlike(x["mark"], F.lit("[!?]")), True).when(F.length(x["mark"]) > 1, ~small).otherwise(~short | starts)

        return F.size(F.filter(each, ends))


def learn(docs: DataFrame, text: str = "text") -> Boundaries:
    """The abbreviations and sentence beginnings of a corpus; null and empty texts teach nothing."""
    short = frozenset(r.form for r in scored_forms(word_forms(docs, text)).where(F.col("abbreviation") >= ABBREVIATION).select("form").collect())
    starts = scored_forms(word_forms(docs, text, short)).where(F.col("starter") >= STARTER).select("form").collect()
    return Boundaries(short, frozenset(r.form for r in starts) - short)
