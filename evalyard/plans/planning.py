"""Planning: tags, model and task pairs, groups, the event log and its phases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.rows import BROADCAST_BYTES, group_numbers

#: Parts of the keys that all tasks share, where models are too many to be broadcast.
SALTS = 64
PENDING, GENERATED, DONE, FAILED = 0, 1, 2, -1


def normal_tag(c: Column) -> Column:
    """Blank, null and any-case "any" become "any"; other tags are trimmed."""
    t = strip(c)
    return F.when(t.isNull() | (t == "") | (F.lower(t) == "any"), "any").otherwise(t)


def tag_pairs(models: DataFrame, tasks: DataFrame, models_bytes: int = 1 << 10) -> DataFrame:
    """Model and task pairs whose tags are equal or of which one is "any"; each pair once.

    One equi-join: a model with a tag looks for that tag and for "any"; a model with "any" looks
    for "*", which every task offers beside its own tag. Few models are broadcast, so no key gathers tasks; with many
    the keys "*" and "any" are split into ``SALTS`` parts: tasks go to one of them, models to each.
    """
    m = models.withColumn("model_tag", normal_tag(F.col("model_tag")))
    t = tasks.withColumn("task_tag", normal_tag(F.col("task_tag")))
    wanted = F.when(F.col("model_tag") == "any", F.array(F.lit("*"))).otherwise(F.array(F.col("model_tag"), F.lit("any")))
    m = m.withColumn("_key", F.explode(wanted))
    t = t.withColumn("_key", F.explode(F.array(F.col("task_tag"), F.lit("*"))))
    if models.count() * models_bytes <= BROADCAST_BYTES:
        return t.join(F.broadcast(m), "_key").select(*models.columns, *tasks.columns)
    common = F.col("_key").isin("*", "any")
    m = m.withColumn("_salt", F.explode(F.when(common, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    t = t.withColumn("_salt", F.when(common, F.pmod(F.xxhash64(*tasks.columns), F.lit(SALTS)).cast("int")).otherwise(0))
    return m.join(t, ["_key", "_salt"]).select(*models.columns, *tasks.columns)


def group_pairs(groups: DataFrame, models: DataFrame, tasks: DataFrame) -> DataFrame:
    """Pairs of each evaluation group by strictly equal tags; a pair in two groups is an error."""
    pairs = groups.join(models, "model_tag").join(tasks, "task_tag").select("group_name", "model", "task")
    per = pairs.groupBy("model", "task").agg(F.count(F.lit(1)).alias("n"), F.min("group_name").alias("group_name"))
    return per.select("group_name", "model", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("pair in several groups: "), F.col("model").cast("string"), F.lit(" x "), F.col("task").cast("string")))).otherwise(F.col("task")).alias("task"))


def new_events(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs without an event yet, in the pending phase."""
    return pairs.join(events.select("model", "task").distinct(), ["model", "task"], "left_anti").withColumn("phase", F.lit(PENDING))


def latest(log: DataFrame, key: list[str], version: str) -> DataFrame:
    """The newest row of each key of an append-only log, without a window or sort."""
    rest = [c for c in log.columns if c not in key]
    best = log.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(version)).alias("r"))
    return best.select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def upsert_models(old: DataFrame, new: DataFrame, key: str = "name", flag: str = "grading_only") -> DataFrame:
    """New rows replace old ones of the same key; ``flag`` stays true only where both have it."""
    every = old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)))
    rest = [c for c in old.columns if c not in (key, flag)]
    out = every.groupBy(key).agg(F.max_by(F.struct(*rest), F.col("_v")).alias("r"), F.min(F.col(flag).cast("int")).alias(flag))
    return out.select(key, *[F.col(f"r.{c}").alias(c) for c in rest], F.col(flag).cast(old.schema[flag].dataType).alias(flag))


def insert_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def insert_replace(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows in the place of old ones of the same key, whole."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def every_pair(models: DataFrame, tasks: DataFrame, models_bytes: int = 1 << 10) -> DataFrame:
    """Each model with each task, which is the result itself; few models go to the tasks' partitions."""
    names = models.select("model").distinct()
    if names.count() * models_bytes <= BROADCAST_BYTES:
        names = F.broadcast(names)
    return tasks.select("task").crossJoin(names).select("model", "task")


def with_judges(events: DataFrame, tasks: DataFrame, models: DataFrame) -> DataFrame:
    """Events with their task's grader and the endpoint of the judge that it names, null where it names none or an unknown one."""
    known = tasks.select("task", "grader", "judge")
    return events.join(known, "task").join(models.select(F.col("model").alias("judge"), "endpoint"), "judge", "left")


def active(models: DataFrame, flag: str = "grading_only") -> DataFrame:
    """Models that aren't for grading only; a null flag counts as unset."""
    return models.where(~F.coalesce(F.col(flag).cast("boolean"), F.lit(False)))


def serving_key(*parts: Column) -> Column:
    """A 12-digit key of the settings that a served model depends on, nulls counted."""
    return F.left(F.sha2(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts])), 256), F.lit(12))


def jobs_of_models(models: DataFrame, jobs: DataFrame) -> DataFrame:
    """Models with the jobs that serve them, by serving key; a model without a job keeps a null."""
    return models.join(jobs.select("serving_key", "job").distinct(), "serving_key", "left")


#: Fixed value: what a share of done rows looks like, from none to all.
SHADES = " ▁▂▃▄▅▆▇█"


def progress(df: DataFrame, by: str, order: str, done: str, width: int = 20) -> DataFrame:
    """Share of done rows in each of ``width`` stretches of a group's rows in order: group, stretch (from 0), share.

    Stretches differ by one row at most, longer ones first; a group of fewer rows has as many stretches. Groups are
    numbered over ranges, so a group of any size is spread over tasks.
    """
    rows = group_numbers(df.select(by, order, F.col(done).cast("int").alias("_d")), by, [order], "_i", "_n")
    parts = F.least(F.col("_n"), F.lit(width))
    each, more = F.floor(F.col("_n") / parts), F.col("_n") % parts
    stretch = F.when(F.col("_i") < more * (each + 1), F.floor(F.col("_i") / (each + 1))).otherwise(more + F.floor((F.col("_i") - more * (each + 1)) / each))
    return rows.groupBy(by, stretch.alias("stretch")).agg(F.avg("_d").alias("share"))


def progress_bars(shares: DataFrame, by: str) -> DataFrame:
    """A group's stretches as one text of shades."""
    shade = F.substring(F.lit(SHADES), F.floor(F.col("share") * (len(SHADES) - 1)).cast("int") + 1, F.lit(1))
    return shares.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("stretch", shade.alias("shade")))), lambda x: x["shade"]), "").alias("bar"))


def name_widths(events: DataFrame, *columns: str, least: int = 10) -> DataFrame:
    """The longest name of each column, ``least`` at least: the widths of a listing."""
    return events.agg(*[F.greatest(F.coalesce(F.max(F.length(c)), F.lit(0)), F.lit(least)).alias(c) for c in columns])


def listing_names(events: DataFrame, widths: DataFrame, *columns: str) -> DataFrame:
    """Adds ``label``: the names cut and padded to the widths, joined by bars."""
    w = widths.select(*[F.col(c).alias(f"_w_{c}") for c in columns])  # one row
    cells = [F.rpad(F.substring(F.coalesce(c, F.lit("")), F.lit(1), F.col(f"_w_{c}")), F.col(f"_w_{c}"), F.lit(" ")) for c in columns]
    return events.crossJoin(F.broadcast(w)).withColumn("label", F.concat_ws(" | ", *cells)).drop(*[f"_w_{c}" for c in columns])


def phase_counts(events: DataFrame) -> DataFrame:
    """completed (done or failed), successful and open events."""
    p = F.col("phase")
    return events.agg(F.count_if(p.isin(DONE, FAILED)).alias("completed"), F.count_if(p == DONE).alias("successful"), F.count_if(~p.isin(DONE, FAILED)).alias("open"))


def pair_token(*parts: Column) -> Column:
    """A 12-digit key of an ordered list of texts."""
    return F.left(F.sha2(F.concat_ws("\x00", *parts), 256), F.lit(12))


def replica_bonus(rows: DataFrame, by: str, order: list[Column], bonus: int) -> DataFrame:
    """The first ``bonus`` rows of each group in order get one replica more."""
    from pyspark.sql.window import Window

    nth = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("replicas", F.col("replicas") + (nth <= bonus).cast("int"))
