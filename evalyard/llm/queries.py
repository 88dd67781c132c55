"""Registered queries of the corpus operators and their DuckDB equivalents."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import bpe as _bpe
from . import decontaminate as _decon
from . import exact_dedup as _exact
from . import licenses as _licenses
from . import ngram_join as _ngram
from . import ppm as _ppm
from . import pseudonyms as _pseudonyms
from . import quality as _quality
from . import repeats as _repeats
from . import resampling as _resampling
from . import resharding as _shards
from . import runs as _runs
from . import secrets as _secrets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


@query("op3_decontaminate", _decon.SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decon.contamination(_decon.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query("op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bpe.digest(_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decoded=True))


@query("op5_exact_dedup", _exact.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact.exact_groups(table(spark, sf_dir, "documents"))


@query("op4_ngram_join", _ngram.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ngram.near_duplicates(table(spark, sf_dir, "documents"))


OLD_SHARDS, NEW_SHARDS = 16, 24


@query("op6_resharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 16 old shards, chosen by source, to 24 of equal bytes."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(OLD_SHARDS))
    rows = _shards.sized(docs, carry={"old_shard": old})
    placed = _shards.reshard(rows, F.col("old_shard"), OLD_SHARDS, NEW_SHARDS)
    return placed.select(F.col("doc").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"))


@query("op7_licenses")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _licenses.digest(_licenses.scan_licenses(table(spark, sf_dir, "documents")))


@query("op8_pseudonyms")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pseudonyms.digest(_pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), key=b"a key for the test tables only"))


@query("op9_secrets")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _secrets.digest(_secrets.scan_secrets(table(spark, sf_dir, "documents")))


@query("op1_ppm")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return _ppm.score_corpus(table(spark, sf_dir, "documents"), held_out)


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_resampling", _resampling.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's repeats: in a tenth of the documents the words from one place on repeat a stretch."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return np.concatenate([np.arange(a), a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))])


@query("op13_runs", _runs.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs.digest(_runs.periodic_runs(table(spark, sf_dir, "documents"), source=_planted))


@query("op12_repeats", _repeats.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repeats.digest(_repeats.remove_repeats(table(spark, sf_dir, "documents")))
