"""Sinks: JSON lines, score files, dual and per-group datasets, run manifests."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_records(df: DataFrame, path: str) -> None:
    """Append rows as compact JSON lines; null fields are left out."""
    df.write.mode("append").option("ignoreNullFields", True).json(path)


def write_dataset(df: DataFrame, path: str, overwrite: bool = False, partition: str | None = None) -> None:
    """A dataset as JSON lines; an existing one is an error unless ``overwrite``."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    (writer.partitionBy(partition) if partition else writer).json(path)


def write_full_and_small(df: DataFrame, path: str, small_path: str, rows: int = 100, overwrite: bool = False) -> None:
    """The whole dataset, and its rows with numbers below ``rows``."""
    write_dataset(df, path, overwrite)
    write_dataset(df.where(F.col("row") < rows), small_path, overwrite)


def write_scores(scores: DataFrame, path: str) -> None:
    """Score lines ``"name": value``, replacing the file; scores are a few rows by nature."""
    lines = [f"{json.dumps(r['name'], ensure_ascii=False)}: {_value(r['value'])}" for r in scores.orderBy("name").collect()]
    with open(path, "w", encoding="utf-8") as f:
        f.write("".join(line + "\n" for line in lines))


def _value(v) -> str:
    return ".nan" if v is None or v != v else repr(v)


def canonical_json(value) -> str:
    """Sorted keys, compact, no NaN, one line feed at the end."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False) + "\n"


def check_manifest(path: str, manifest: dict) -> None:
    """Write the run's manifest, or refuse to go on when an earlier one differs."""
    text = canonical_json(manifest)
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            if f.read() != text:
                raise ValueError(f"{path}: the earlier run had other settings")
        return
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
