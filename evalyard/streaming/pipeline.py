"""Streaming: datasets to generations, grades and scores; windowed counts; event phases with state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.graders import grade

Generator = Callable[[Column, int], Column]


def echo_generator(prompt: Column, n: int) -> Column:
    """A deterministic stand-in for a served model: n texts made of the prompt and the letters A to D."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda g: F.concat(F.lit("The answer is ("), F.char(65 + F.pmod(F.length(prompt) + g, F.lit(4))), F.lit(")")))


def generations(rows: DataFrame, n: int, generator: Generator = echo_generator) -> DataFrame:
    return rows.withColumn("generations", generator(F.col("completion_input"), n))


def watch(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16, glob: str = "*.json") -> DataFrame:
    """New JSON files of a folder as a stream, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("latestFirst", False).option("pathGlobFilter", glob).json(path)


def grade_stream(rows: DataFrame, grader: str, n: int, out: str, checkpoint: str, generator: Generator = echo_generator, key: str = "row", delay: str | None = None):
    """Generate and grade everything that is there now, each key once over restarts; returns the query.

    The keys seen are kept as state. Where rows carry an event time ``ts`` give ``delay`` to bound it.
    """
    if delay:
        rows = rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])
    else:
        rows = rows.dropDuplicates([key])
    graded = grade(generations(rows, n, generator), grader)
    return graded.writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_accuracy(graded: DataFrame, by: str) -> DataFrame:
    """Accuracy so far for each group, for a stream in complete or update mode."""
    ones = F.aggregate("correct", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return graded.groupBy(by).agg(F.sum(ones).alias("ok"), F.sum(F.size("correct")).alias("n")).withColumn("accuracy", F.col("ok") / F.col("n"))


def windowed_counts(events: DataFrame, size: str = "1 day", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Rows and summed value per window and event type; works on batches and on streams with late data."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", delay).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def phases(updates: DataFrame, key: str = "event") -> DataFrame:
    """The phase machine as keyed state: pending 0, generated 1, done 2, failed -1.

    A move is taken from 0 to 1 or -1 and from 1 to 2 or -1; others leave the phase. Each batch
    gives (event, phase, moves) of the keys that it touches.
    """

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        phase, moves = state.get if state.exists else (0, 0)
        rows = pd.concat(frames).sort_values(["seq"])
        for to in rows["to"]:
            if to == -1 and phase in (0, 1) or to == phase + 1 and phase in (0, 1):
                phase, moves = int(to), moves + 1
        state.update((phase, moves))
        yield pd.DataFrame({key: [k[0]], "phase": [phase], "moves": [moves]})

    return updates.groupBy(key).applyInPandasWithState(step, f"{key} string, phase int, moves int", "phase int, moves int", "update", GroupStateTimeout.NoTimeout)


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> None:
    """Drive a stream over what is there now, batch by batch."""
    df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
