"""The corpus pipeline: filter by quality, remove exact and near copies, decontaminate, encode.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All stages but
the last return the columns of ``documents``, whatever further columns there are.

Every stage judges rows, not ids: repeated ids and null ids stay apart and each row has its own
fate. A null text counts as empty; empty and blank texts are scored by the first stage, equal to
each other in the second (empty and blank aren't), linked to nothing in the third, never
contaminated, and encoded as no tokens or as their white space. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evalyard.llm import bpe, decontaminate, exact_dedup, ngram_join, quality
from evalyard.session import materialize_stage, table

#: No SQL: training and byte-pair merges are iterative; tests compare the stages with brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on ``labels``, doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that near-copy links connect, the row with the smallest doc_id."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule leaves."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    return bpe.digest(bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a finished stage has written on its way is removed at once."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize_stage(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
