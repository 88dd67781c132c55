"""Continuous evaluation: ends of streams with their scores, merged sources, an idempotent sink of grades.

The stateful steps use keyed state with timers (``transformWithStateInPandas``), so a query needs a state store that
has them: ``with_state_store`` sets it. State is dropped when an event is complete and its timer has run out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import graders
from ..sources import readers

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> SparkSession:
    """The session with a state store that keeps timers and several values a key."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return spark


class _EndOfStream(StatefulProcessor):
    """Counts an event's rows and correct flags until all rows are there or its time is over."""

    def __init__(self, patience_ms: int):
        self.patience = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "n bigint, wanted bigint, ok bigint, flags bigint, due bigint")
        self.done = handle.getValueState("done", "due bigint")

    def _out(self, key, n: int, wanted: int, ok: int, flags: int) -> pd.DataFrame:
        return pd.DataFrame({"event": [key[0]], "complete": [n == wanted], "n_rows": [n], "wanted": [wanted], "accuracy": [ok / flags if flags else float("nan")]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, wanted, ok, flags, due = self.counts.get() if self.counts.exists() else (0, 0, 0, 0, 0)
        last = 0
        for frame in rows:
            n, ok, flags = n + len(frame), ok + int(frame["ok"].sum()), flags + int(frame["flags"].sum())
            wanted, last = max(wanted, int(frame["wanted"].max())), max(last, int(frame["ms"].max()))
        if self.done.exists():  # a late row of an event whose scores are out
            return
        until = max(last, timerValues.getCurrentWatermarkInMs()) + self.patience
        if until > due:  # the timer moves with the rows
            if due:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(until)
            due = until
        if n >= wanted:
            self.counts.clear()
            self.done.update((due,))
            yield self._out(key, n, wanted, ok, flags)
        else:
            self.counts.update((n, wanted, ok, flags, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.counts.exists():  # rows stayed away: what is there, marked incomplete
            n, wanted, ok, flags, _ = self.counts.get()
            yield self._out(key, n, wanted, ok, flags)
        self.counts.clear()
        self.done.clear()

    def close(self) -> None:
        pass


def scores_at_end(graded: DataFrame, event: str = "event", wanted: str = "num_generations", ts: str = "ts", delay: str = "10 minutes", patience_ms: int = 3_600_000) -> DataFrame:
    """event, complete, n_rows, wanted and accuracy, once for each event of a stream of graded rows.

    They come when an event has as many rows as ``wanted`` says, or marked incomplete when no row has come for
    ``patience_ms`` of event time. Rows that come after that, up to the end of the patience, change nothing; later
    ones are dropped by the watermark. Repeats of a ``row`` count once within the watermark.
    """
    ok = F.aggregate("correct", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x.cast("bigint"), F.lit(0)))
    rows = graded.withWatermark(ts, delay).dropDuplicatesWithinWatermark([event, "row"])
    rows = rows.select(F.col(event).cast("string").alias("event"), F.col(ts), F.unix_millis(ts).alias("ms"), F.col(wanted).cast("bigint").alias("wanted"), F.coalesce(ok, F.lit(0)).alias("ok"), F.coalesce(F.size("correct"), F.lit(0)).cast("bigint").alias("flags"))
    return rows.groupBy("event").transformWithStateInPandas(_EndOfStream(patience_ms), "event string, complete boolean, n_rows bigint, wanted bigint, accuracy double", "Update", "EventTime")


def merged(sources: dict[str, DataFrame], delays: dict[str, str], default: str = "10 minutes") -> DataFrame:
    """One stream of (source, id, event, seq, to, ts) from several, each with a watermark of its own; each (source, id) once.

    The slowest source holds the watermark back, so no source's rows are late because another runs ahead.
    """
    parts = [df.withWatermark("ts", delays.get(name, default)).select(F.lit(name).alias("source"), F.col("id").cast("string").alias("id"), F.col("event").cast("string").alias("event"), F.col("seq").cast("bigint").alias("seq"), F.col("to").cast("int").alias("to"), "ts") for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropDuplicatesWithinWatermark(["source", "id"])


class _Phases(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("phase", "phase int, moves int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        phase, moves = self.state.get() if self.state.exists() else (0, 0)
        seqs, tos = zip(*[(f["seq"].to_numpy(), f["to"].to_numpy()) for f in rows])  # two numbers a row
        to = np.concatenate(tos)[np.argsort(np.concatenate(seqs), kind="stable")]
        while phase in (0, 1):
            at = np.flatnonzero((to == -1) | (to == phase + 1))
            if not len(at):
                break
            phase, moves, to = int(to[at[0]]), moves + 1, to[at[0] + 1 :]
        self.state.update((phase, moves))
        yield pd.DataFrame({"event": [key[0]], "phase": [phase], "moves": [moves], "handled": [sum(map(len, seqs))]})

    def close(self) -> None:
        pass


def phases(updates: DataFrame) -> DataFrame:
    """event, phase, moves and handled (updates of this batch) of each event that a batch touches.

    Pending 0 goes to generated 1 or failed -1, and 1 to done 2 or -1; other updates leave the phase. Updates of a
    batch are taken by ``seq``.
    """
    return updates.groupBy("event").transformWithStateInPandas(_Phases(), "event string, phase int, moves int, handled bigint", "Update", "None")


class GradeSink:
    """Writes graded batches so that a batch that is repeated after a failure replaces itself.

    A batch goes to a folder of its own name, then an empty marker says that it is whole; ``read`` sees marked batches
    only. A batch with a marker isn't written again; one without is written anew in the place of what a
    killed attempt has left. Rows that the grader can't take become error records with an ``exception``.
    """

    def __init__(self, path: str, grader: str):
        self.path, self.grader = path.rstrip("/"), grader

    def _folder(self, batch: int) -> str:
        return f"{self.path}/batch-{batch:012d}"

    def _commit(self, spark: SparkSession, batch: int) -> None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_done/{batch:012d}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True).close()

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        if readers.exists(spark, f"{self.path}/_done/{batch:012d}"):
            return
        graders.grade_or_report(rows, self.grader).write.mode("overwrite").option("ignoreNullFields", True).json(self._folder(batch))
        self._commit(spark, batch)

    def read(self, spark: SparkSession, schema: str | None = None) -> DataFrame | None:
        """All records of whole batches; None before the first one."""
        if not readers.exists(spark, f"{self.path}/_done/*"):
            return None
        done = [n.rsplit("/", 1)[1] for n in readers.unreadable_files(spark, f"{self.path}/_done/*")[0]]
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.json([self._folder(int(n)) for n in done])


def grade_continuously(rows: DataFrame, grader: str, path: str, checkpoint: str, **trigger):
    """Grade a stream into a ``GradeSink``; the started query is returned. ``trigger`` is that of the stream, one pass over what is there by default."""
    return rows.writeStream.foreachBatch(GradeSink(path, grader)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def wanted_by(event: Column, counts: dict[str, int]) -> Column:
    """The number of rows that each event asks for, from a short table; an event that isn't in it never ends by count."""
    table = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair]) if counts else F.lit(None).cast("map<string,int>")
    return F.coalesce(F.try_element_at(table, event), F.lit(2**31 - 1))
