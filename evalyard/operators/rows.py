"""Row shaping: record normalising, prompts, resume joins, few-shot prefixes, transcripts, seeded shuffles."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip
from ..session import materialize


def messages_to_prompt(chat: Column) -> Column:
    """Contents of the messages joined by blank lines; null contents are passed over."""
    return F.array_join(F.filter(F.transform(chat, lambda m: m["content"]), lambda c: c.isNotNull()), "\n\n")


def normalise_records(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Core columns row, completion_input, chat_input and ground_truth from current or legacy records.

    Legacy: ``label`` is the truth where the ``ground_truth`` column is absent; ``prompt`` (text
    or messages) gives both inputs; ``row`` defaults to the position in ``order``.
    """
    kinds = dict(df.dtypes)
    chat = "array<struct<role:string,content:string>>"
    if "prompt" in kinds:
        if kinds["prompt"] == "string":
            text, talk = F.col("prompt"), F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")))
        else:
            text, talk = messages_to_prompt(F.col("prompt")), F.col("prompt")
        df = df.withColumn("completion_input", F.coalesce(F.col("completion_input"), text) if "completion_input" in kinds else text)
        df = df.withColumn("chat_input", F.coalesce(F.col("chat_input"), talk) if "chat_input" in kinds else talk).drop("prompt")
    elif "chat_input" in kinds and "completion_input" not in kinds:
        df = df.withColumn("completion_input", messages_to_prompt(F.col("chat_input")))
    elif "completion_input" in kinds and "chat_input" not in kinds:
        df = df.withColumn("chat_input", F.array(F.struct(F.lit("user").alias("role"), F.col("completion_input").alias("content"))).cast(chat))
    if "ground_truth" not in kinds and "label" in kinds:
        df = df.withColumnRenamed("label", "ground_truth")
    if "row" not in kinds:
        df = row_numbers(df, order or df.columns)
    return df


MESSAGES = "array<struct<role:string,content:string>>"


def records_of(df: DataFrame, record: str = "v", index: str = "row_index") -> DataFrame:
    """row, completion_input, chat_input and ground_truth of each record of a VARIANT column, current and legacy ones mixed.

    A key that a record lacks differs from one that is null: ``label`` is the truth only of records without
    ``ground_truth``, and ``prompt`` (text or messages) gives only the inputs that a record lacks. Columns other than
    ``record`` and ``index`` stay; ``ground_truth`` is a VARIANT. What isn't an object gives nulls but for its row.
    """
    v = F.col(record)
    get = lambda k: F.try_variant_get(v, f"$.{k}", "variant")
    has = lambda k: get(k).isNotNull()
    as_text = lambda k: F.when(F.is_variant_null(get(k)), F.lit(None).cast("string")).otherwise(F.try_variant_get(v, f"$.{k}", "string"))
    kind = lambda k: F.coalesce(F.schema_of_variant(get(k)), F.lit("VOID"))
    talk = lambda k: F.when(F.startswith(kind(k), F.lit("ARRAY")), F.try_variant_get(v, f"$.{k}", MESSAGES))
    asked = lambda text: F.array(F.struct(F.lit("user").alias("role"), text.alias("content"))).cast(MESSAGES)
    is_text = kind("prompt") == "STRING"
    chat = (
        F.when(has("chat_input"), talk("chat_input"))
        .when(F.startswith(kind("prompt"), F.lit("ARRAY")), talk("prompt"))
        .when(is_text, asked(as_text("prompt")))
        .when(has("completion_input"), asked(as_text("completion_input")))
    )
    completion = (
        F.when(has("completion_input"), as_text("completion_input"))
        .when(is_text, as_text("prompt"))
        .when(F.startswith(kind("prompt"), F.lit("ARRAY")), messages_to_prompt(talk("prompt")))
        .when(has("chat_input"), messages_to_prompt(talk("chat_input")))
    )
    truth = F.when(has("ground_truth"), get("ground_truth")).otherwise(get("label"))
    rest = [c for c in df.columns if c not in (record, index)]
    return df.select(F.coalesce(F.try_variant_get(v, "$.row", "bigint"), F.col(index)).alias("row"), completion.alias("completion_input"), chat.alias("chat_input"), truth.alias("ground_truth"), *rest)


def row_numbers(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """Gapless numbers from 0 in the given order, without one task for all rows: ranges are counted, then offset.

    The sorted ranges are written once, so that counting and numbering see the same ones. Rows that
    tie in ``order`` get neighbouring numbers in no fixed order.
    """
    part = F.spark_partition_id().alias("_part")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", part)
    ranged = materialize(ranged.withColumn("_nth", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("bigint"), 33)), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_from") + F.col("_nth")).drop("_part", "_nth", "_from")


#: Bytes up to which counted tables are broadcast; beyond, they are joined by shuffle.
BROADCAST_BYTES = 64 << 20


def sized(table: DataFrame, bytes_a_row: int = 64) -> DataFrame:
    """A written table, marked for broadcast if its counted rows are few enough."""
    return F.broadcast(table) if table.count() * bytes_a_row <= BROADCAST_BYTES else table


def group_numbers(df: DataFrame, by: str, order: list[str], name: str = "nth", total: str | None = None) -> DataFrame:
    """Gapless numbers from 0 within each group of ``by`` in the given order, and perhaps each group's number of rows.

    Ranges over (group, order) are sorted and written once, then counted for each group and range; a group that
    fills many ranges is numbered by all of their tasks. Null is a group.
    """
    part = F.spark_partition_id().alias("_part")
    ranged = df.repartitionByRange(by, *order).sortWithinPartitions(by, *order).select("*", part)
    ranged = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    counts = ranged.groupBy("_part", F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    w = Window.partitionBy("_by")  # a row for each range that a group reaches
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = materialize(counts.select(F.col("_part").alias("_in"), "_by", (before - F.col("_first")).alias("_from"), F.sum("_n").over(w).alias("_total")), "counts")
    out = ranged.join(sized(counts), (ranged["_part"] == counts["_in"]) & ranged[by].eqNullSafe(counts["_by"])).withColumn(name, F.col("_from") + F.col("_at"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_part", "_at", "_in", "_by", "_from", "_total")


def resume(rows: DataFrame, done: DataFrame, key: str = "row") -> DataFrame:
    """Rows whose key isn't done yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def merge_grades(stored: DataFrame, live: DataFrame) -> DataFrame:
    """Stored and new grades together; columns that one side lacks are null."""
    return stored.unionByName(live, allowMissingColumns=True)


def few_shot(test: DataFrame, pool: DataFrame, group: str, order: str, text: str, k: int = 5, joiner: str = "\n\n") -> DataFrame:
    """Adds ``prefix``: the first k exemplars of a row's group, joined in order; groups without any get ''."""
    nth = F.row_number().over(Window.partitionBy(group).orderBy(order))
    shots = pool.withColumn("_nth", nth).where(F.col("_nth") <= k).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_nth", text))).alias("_s"))
    shots = shots.select(group, F.array_join(F.transform("_s", lambda s: s[text]), joiner).alias("prefix"))
    return test.join(shots, group, "left").withColumn("prefix", F.coalesce("prefix", F.lit("")))


def next_turns(turns: DataFrame, by: str, order: str) -> DataFrame:
    """Adds the following turn's role and text as the observation of a step."""
    w = Window.partitionBy(by).orderBy(order)
    return turns.withColumn("next_role", F.lead("role").over(w)).withColumn("observation", F.lead("text").over(w))


def new_messages(df: DataFrame, by: str, order: str, messages: str) -> DataFrame:
    """Adds ``new``: the messages that the previous state of a transcript didn't have."""
    seen = F.coalesce(F.lag(F.size(messages)).over(Window.partitionBy(by).orderBy(order)), F.lit(0))
    return df.withColumn("new", F.slice(messages, seen + 1, F.greatest(F.size(messages) - seen, F.lit(0))))


def seeded_shuffle(seed: int):
    """Arrow UDF (row, array<string>) -> array<string>: each row's options in the order of CPython's generator for seed + row."""

    @F.pandas_udf("array<string>")
    def run(row: pd.Series, options: pd.Series) -> pd.Series:
        def one(r, xs):
            xs = list(xs)
            random.Random(seed + int(r)).shuffle(xs)
            return xs

        return pd.Series([one(r, xs) for r, xs in zip(row, options)])

    return run


def ordered_distinct_last(a: Column) -> Column:
    """Distinct elements in the order of their last occurrence."""
    return F.reverse(F.array_distinct(F.reverse(a)))


def clean_text(c: Column) -> Column:
    """Blank and null text becomes NULL, other text is trimmed."""
    return F.nullif(strip(c), F.lit(""))


def duration_seconds(c: Column) -> Column:
    """[DD-]HH:MM:SS as seconds; NULL for another form."""
    p = r"^(?:(\d+)-)?(\d+):(\d{2}):(\d{2})$"
    part = lambda k: F.coalesce(F.nullif(F.regexp_extract(c, p, k), F.lit("")).cast("bigint"), F.lit(0))
    return F.when(c.rlike(p), part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4))


def merge_settings(base: Column, override: Column) -> Column:
    """Flat maps merged, the override's keys winning."""
    old = F.map_filter(base, lambda k, v: ~F.map_contains_key(override, k))
    return F.map_concat(old, override)


def merge_nested(base: dict, override: dict) -> dict:
    """Settings merged key by key, mappings in mappings too; the inputs stay as they are."""
    both = {k: merge_nested(base[k], v) for k, v in override.items() if isinstance(v, dict) and isinstance(base.get(k), dict)}
    return base | override | both


# Parameters that every chat endpoint takes by name.
STANDARD_PARAMETERS = (
    "audio", "frequency_penalty", "function_call", "functions", "logit_bias", "logprobs", "max_completion_tokens", "max_tokens", "messages", "metadata", "modalities", "model", "n", "parallel_tool_calls", "prediction", "presence_penalty",
    "reasoning_effort", "response_format", "seed", "service_tier", "stop", "store", "stream", "stream_options", "temperature", "tool_choice", "tools", "top_logprobs", "top_p", "user",
)


def split_parameters(settings: Column, standard: tuple[str, ...] = STANDARD_PARAMETERS) -> Column:
    """Struct of the standard parameters of a map and of the others; a cache salt in it is an error."""
    checked = F.when(F.map_contains_key(settings, "cache_salt"), F.raise_error(F.lit("cache_salt can't be set directly")).cast("map<string,string>")).otherwise(settings)
    return F.struct(F.map_filter(checked, lambda k, v: k.isin(*standard)).alias("standard"), F.map_filter(checked, lambda k, v: ~k.isin(*standard)).alias("extra"))


def secret_safe(settings: Column, secret: tuple[str, ...] = ("api_key", "cache_salt")) -> Column:
    """A map of settings with the values of secret keys replaced by their SHA-256."""
    return F.transform_values(settings, lambda k, v: F.when(k.isin(*secret), F.sha2(v, 256)).otherwise(v))


def prefixed(prompt: Column, prefix: Column) -> Column:
    """The prefix, a blank line and the prompt; the prompt alone where there is no prefix."""
    return F.when(F.length(prefix) > 0, F.concat(prefix, F.lit("\n\n"), prompt)).otherwise(prompt)


def parallel_fields(structs: Column, fields: list[str]) -> dict[str, Column]:
    """An array of structs as parallel arrays, one for each field, in order; nulls keep their place."""
    return {f: F.transform(structs, lambda s, f=f: s[f]) for f in fields}


def sharded(df: DataFrame, rank: int, world: int, key: str = "row") -> DataFrame:
    """The rows of one of ``world`` equal shards by their number."""
    if not 0 <= rank < world:
        raise ValueError("rank must be below the world size")
    return df.where(F.pmod(F.col(key), F.lit(world)) == rank)


def by_prompt(rows: DataFrame, responses: DataFrame, version: str) -> DataFrame:
    """Rows with the response to their prompt, the newest by ``version`` where a prompt has several."""
    last = responses.groupBy("prompt").agg(F.max_by("response", version).alias("response"))
    return rows.join(last, "prompt")


def failure_class(status: Column, kind: Column | None = None) -> Column:
    """Error code and whether a retry can help, from an HTTP status (null: none) and perhaps a ``kind``, ``malformed`` or ``timeout``, which goes first."""
    kind = F.lit(None).cast("string") if kind is None else kind
    code = (
        F.when(kind == "malformed", "malformed_response")
        .when(kind == "timeout", "request_timeout")
        .when(status == 429, "rate_limited")
        .when(status == 408, "request_timeout")
        .when(status.between(500, 599), "backend_5xx")
        .when(status.between(400, 499), "backend_4xx")
        .otherwise("endpoint_unreachable")
    )
    return F.struct(code.alias("error_code"), (code != "backend_4xx").alias("retriable"))
