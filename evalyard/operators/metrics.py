"""Scores over graded rows: accuracy, pass@k, spread, groups, macro and micro averages.

A graded row holds ``correct array<int>``. Everything aggregates with partial sums; the only
shuffles are those of the grouping keys.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import regex, strip
from ..session import materialize

NAN = float("nan")


def _ones(flags: Column) -> Column:
    return F.aggregate(flags, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x.cast("int"), F.lit(0)))


def pass_at_k(n: Column, c: Column, k: int) -> Column:
    """1 - C(n-c, k) / C(n, k) for one row; k is clamped to n, and 0 for k <= 0."""
    k_ = F.least(F.lit(k), n)
    miss = F.aggregate(F.sequence(F.lit(0), F.greatest(k_, F.lit(1)) - 1), F.lit(1.0), lambda a, i: a * (n - c - i) / F.greatest(n - i, F.lit(1)))
    return F.when(k_ <= 0, 0.0).when(n - c < k_, 1.0).otherwise(1.0 - miss)


def accuracy(correct: Column, n: int) -> Column:
    """Micro average of each row's first n flags; NaN without flags."""
    head = F.slice(correct, 1, n)
    total = F.sum(F.size(head))
    return F.when(total > 0, F.sum(_ones(head)) / total).otherwise(F.lit(NAN))


def row_accuracy(correct: Column) -> Column:
    return F.when(F.size(correct) > 0, _ones(correct) / F.size(correct)).otherwise(F.lit(NAN))


def half_sample_std(correct: Column, n: int) -> Column:
    """Limit of the spread of means over half samples of the rows without replacement; 0 for fewer than two rows.

    The deviation of the row means times sqrt((1 - m/N)/m), m = floor(N/2): exact where every
    row has as many flags, with nothing to draw and so nothing to seed.
    """
    rows = F.count(F.lit(1))
    m = F.floor(rows / 2)
    return F.when(rows <= 1, 0.0).otherwise(F.stddev_samp(row_accuracy(F.slice(correct, 1, n))) * F.sqrt((1 - m / rows) / m))


#: Blocks of rows whose shares of each half sample are drawn first; the rows of a block are drawn in one task.
BLOCKS, BLOCK_ROWS = 1024, 4096


def half_samples(df: DataFrame, n: int | None = None, replicates: int = 1000, seed: int = 0) -> DataFrame:
    """replicate, members, ok and flags: the sums over ``replicates`` half samples of the rows of ``correct``.

    Each half sample has exactly half of the rows, rounded down, drawn without replacement. Rows go to blocks by hash;
    how many of a block belong to a half sample is drawn from the hypergeometric law on the driver (blocks x
    replicates numbers), which of them by a seeded generator in the block's task. Sums are combined by Spark.
    """
    head = F.slice("correct", 1, n) if n else F.col("correct")
    rows = df.select(_ones(head).alias("ok"), F.size(head).cast("bigint").alias("flags"), F.monotonically_increasing_id().alias("_row"))
    total = rows.count()
    blocks = max(1, min(BLOCKS, total // BLOCK_ROWS))
    rows = materialize(rows.withColumn("block", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(blocks)).cast("int")), "halves")
    sizes = dict(map(tuple, rows.groupBy("block").count().collect()))
    names = sorted(sizes)
    drawn = np.random.default_rng(seed).multivariate_hypergeometric([sizes[b] for b in names], total // 2, size=replicates, method="marginals") if total > 1 else np.zeros((replicates, len(names)), int)
    shares = {b: drawn[:, k].astype(int).tolist() for k, b in enumerate(names)}

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row")
        values = frame[["ok", "flags"]].to_numpy()
        rng = np.random.default_rng([seed, int(key[0])])
        out = [(r, m, *values[rng.permutation(len(values))[:m]].sum(axis=0)) for r, m in enumerate(shares[int(key[0])])]
        return pd.DataFrame(out, columns=["replicate", "members", "ok", "flags"])

    per = rows.groupBy("block").applyInPandas(run, "replicate int, members bigint, ok bigint, flags bigint")
    return per.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("members", "ok", "flags")])


def half_sample_spread(df: DataFrame, n: int | None = None, replicates: int = 1000, seed: int = 0) -> DataFrame:
    """One row, ``value``: the standard deviation of the accuracy over half samples; 0 for fewer than two rows. Rows may have unequal numbers of flags."""
    each = half_samples(df, n, replicates, seed)
    return each.agg(F.coalesce(F.stddev_pop(F.try_divide("ok", "flags")), F.lit(0.0)).alias("value"))


def scores(df: DataFrame, average_over: Sequence[int] = (1,), pass_k: Sequence[int] = (1,), by: Sequence[Sequence[str]] = ((),), zero_is_nan: bool = False) -> DataFrame:
    """Long table of the grouping columns, name and value, for each grouping set of ``by``.

    Without rows or with only empty flag lists a score is NaN; ``zero_is_nan`` also makes it so
    when nothing is correct. pass@k uses all flags of a row.
    """
    c = F.col("correct")
    columns = list(dict.fromkeys(k for s in by for k in s))
    n, ok = F.size(c), _ones(c)
    parts = []
    for a in average_over:
        parts.append((f"accuracy (avg over {a})", accuracy(c, a)))
        if a > 1:
            parts.append((f"bootstrap_std (avg over {a})", half_sample_std(c, a)))
    parts += [(f"accuracy (pass@{k})", F.avg(pass_at_k(n, ok, k))) for k in pass_k]
    empty = (F.sum(ok) == 0) if zero_is_nan else (F.coalesce(F.max(n), F.lit(0)) == 0)
    aggs = [F.when(F.coalesce(empty, F.lit(True)), F.lit(NAN)).otherwise(v).alias(f"v{i}") for i, (_, v) in enumerate(parts)]
    if not columns:
        wide = df.agg(*aggs)
    elif len(by) == 1:
        wide = df.groupBy(*columns).agg(*aggs)
    else:
        wide = df.groupingSets([[F.col(k) for k in s] for s in by], *columns).agg(*aggs)
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(f"v{i}").alias("value")) for i, (name, _) in enumerate(parts)]))
    return wide.select(*columns, pairs.alias("s")).select(*columns, "s.name", "s.value")


def named_scores(df: DataFrame, average_over: Sequence[int] = (1,), pass_k: Sequence[int] = (1,), by: Sequence[str] = (), zero_is_nan: bool = False, overall: str = "") -> DataFrame:
    """name and value of the scores over all rows and of each value of each column of ``by``, in one pass over the rows.

    A group's name goes before its scores' (null: ``unknown``), ``overall`` before those of all rows.
    """
    keys = [f"_by{i}" for i in range(len(by))]
    df = df.withColumns({k: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for k, c in zip(keys, by)})  # null now says: not grouped
    found = scores(df, average_over, pass_k, [[], *([k] for k in keys)], zero_is_nan)
    label = F.coalesce(*map(F.col, keys), F.lit(overall)) if keys else F.lit(overall)
    return found.select(F.when(label != "", F.concat(label, F.lit(" "), "name")).otherwise(F.col("name")).alias("name"), "value")


def macro_micro(df: DataFrame, values: Sequence[str], group: str) -> DataFrame:
    """Micro averages over rows and macro averages over the means of non-null groups; names stay bare without groups."""
    per = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(v).alias(v) for v in values], *[F.sum(v).alias(f"_{v}") for v in values])
    known = F.col(group).isNotNull()
    wide = per.agg(
        F.count_if(known).alias("groups"),
        *[(F.sum(f"_{v}") / F.sum("_n")).alias(f"micro_{v}") for v in values],
        *[F.avg(F.when(known, F.col(v))).alias(f"macro_{v}") for v in values],
    )
    cells = []
    for v in values:
        bare = F.when(F.col("groups") > 0, F.lit(f"micro_avg/{v}")).otherwise(F.lit(v))
        cells.append(F.struct(bare.alias("name"), F.coalesce(f"micro_{v}", F.lit(NAN)).alias("value")))
        cells.append(F.struct(F.when(F.col("groups") > 0, F.lit(f"macro_avg/{v}")).alias("name"), F.col(f"macro_{v}").alias("value")))
    return wide.select(F.inline(F.array(*cells))).where("name is not null")


def breakdown(df: DataFrame, details: str = "evaluation_details") -> DataFrame:
    """How often each reason occurs, as scores named ``breakdown (reason)``."""
    per = df.select(F.explode(details).alias("reason")).groupBy("reason").count()
    return per.select(F.format_string("breakdown (%s)", "reason").alias("name"), F.col("count").cast("double").alias("value"))


def flag_ratio(df: DataFrame, by: str, prefix: str = "accuracy/") -> DataFrame:
    """Share of true flags of each group, flags counted one by one."""
    per = df.groupBy(by).agg(F.sum(_ones(F.col("correct"))).alias("ok"), F.sum(F.size("correct")).alias("n"))
    return per.select(F.concat(F.lit(prefix), F.col(by)).alias("name"), F.when(F.col("n") > 0, F.col("ok") / F.col("n")).otherwise(F.lit(NAN)).alias("value"))


def token_totals(df: DataFrame, by: Sequence[str], *columns: str) -> DataFrame:
    """Sums of token counts for each group: numbers, arrays of them, or arrays of arrays (turns of steps); nulls count as none."""

    def total(name: str) -> Column:
        kind, c = df.schema[name].dataType.simpleString(), F.col(name)
        while kind.startswith("array<array<"):
            kind, c = kind.removeprefix("array<").removesuffix(">"), F.flatten(F.filter(c, lambda x: x.isNotNull()))
        if kind.startswith("array"):
            c = F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x.cast("bigint"), F.lit(0)))
        return F.coalesce(F.sum(c), F.lit(0)).alias(name)

    return df.groupBy(*by).agg(*map(total, columns))


def unigram_f(text: Column, truth: Column) -> Column:
    """F of the distinct words that two texts share; white space and full stops part words."""
    words = lambda c: F.array_distinct(F.filter(F.split(c, regex(r"[\s.]+"), -1), lambda w: w != ""))
    shared = F.size(F.array_intersect(words(text), words(truth)))
    p, r = F.try_divide(shared, F.size(words(text))), F.try_divide(shared, F.size(words(truth)))
    return F.coalesce(2 * (p * r) / (p + r + 1e-8), F.lit(0.0))


def unigram_overlap(df: DataFrame, by: str = "difficulty") -> DataFrame:
    """Scores named ``group rouge-1``: 100 × the mean F of each row's first pick against its truth.

    Rows whose first pick or truth is null or blank are left out; a group without others has no score.
    """
    pairs = df.select(by, F.try_element_at("picked", F.lit(1)).alias("p"), F.col("ground_truth").cast("string").alias("t"))
    pairs = pairs.where((F.length(strip(F.col("p"))) > 0) & (F.length(strip(F.col("t"))) > 0))
    return pairs.groupBy(by).agg((F.avg(unigram_f(F.col("p"), F.col("t"))) * 100).alias("value")).select(F.concat(F.col(by), F.lit(" rouge-1")).alias("name"), "value")


def shares(df: DataFrame, column: str) -> DataFrame:
    """Each value's share of the rows."""
    per = df.groupBy(column).count()
    total = df.agg(F.count(F.lit(1)).alias("total"))  # one row
    return per.join(F.broadcast(total)).select(column, (F.col("count") / F.col("total")).alias("share"))
