r"""Exact deduplication by deterministic block naming, with DataFrame functions only.

Normalised texts (each ``[\x20\x09-\x0D]+`` run is one space) are cut into blocks of a fixed
number of UTF-8 bytes. Blocks are sorted, and each gets an integer name: the place where its run of
equal blocks begins, so equal blocks share a name and different blocks can't. Adjacent names
of a document are then paired and the pairs sorted and named the same way, level by level,
until one name is left: two documents of as many blocks are equal exactly when their last
names are. A document with a block or pair that occurs nowhere else is unique and leaves the
recursion.

Scale: the blocks are written once; a level is one shuffle by the key's hash, sorted within
each task. Only level 0 moves text, once. Hashes with over 1/``HOT`` of a level's rows are
counted first; they are fewer than ``HOT``, so their blocks are named after an aggregation
with map-side combining and by a broadcast, and every task of the sort has a bounded share.
Rows are told apart by a written number, not by their id, which may repeat or be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from ._text import row_identity, sized

BLOCK_BYTES = 4096
HOT = 1000


def single_spaced(docs: DataFrame, text: str = "text") -> DataFrame:
    r"""``text`` with every run of ``\x20\x09-\x0D`` as one space; null counts as empty."""
    spaced = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    # a projection of its own, so that the replaced text is made once for its three uses
    docs = docs.withColumn(text, spaced)
    return docs.withColumn(text, F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(F.col(text)))


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Written ``rows`` without ``keys`` and their hash ``h``, plus ``name``, an integer of the keys' own, and ``uses``, the rows that have it."""
    most = max(1, rows.count() // HOT)
    hot = [r.h for r in rows.groupBy("h").count().where(F.col("count") > most).select("h").collect()]  # fewer than HOT
    rest = rows.where(~F.col("h").isin(hot)) if hot else rows
    ordered = rest.repartition("h").sortWithinPartitions("h", *keys).withColumn("at", F.monotonically_increasing_id())
    run = Window.partitionBy("h", *keys)
    out = ordered.withColumns({"name": F.min("at").over(run), "uses": F.count(F.lit(1)).over(run)}).drop("h", "at", *keys)
    if not hot:
        return out
    many = rows.where(F.col("h").isin(hot))
    counts = many.groupBy("h", *keys).agg(F.count(F.lit(1)).alias("uses"))
    # below zero, where no place of the sort is; the numbered keys are fewer than HOT but for colliding hashes
    counts = counts.withColumn("name", -F.row_number().over(Window.orderBy("h", *keys)).cast("bigint"))
    same = [F.col(k).eqNullSafe(F.col(f"hot_{k}")) for k in keys]
    named = many.join(F.broadcast(counts.select(F.col("h").alias("hot_h"), *(F.col(k).alias(f"hot_{k}") for k in keys), "name", "uses")), [F.col("h") == F.col("hot_h"), *same])
    return out.unionByName(named.drop("h", "hot_h", *keys, *(f"hot_{k}" for k in keys)))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(doc, doc_id, n_blocks, text_sha256 of every row; doc, doc_id, n_blocks, name of each row that may have an equal).

    ``docs`` has ``doc_id``, ``text`` and perhaps ``doc``, a number of each row's own, which is added if it isn't there.
    Rows that aren't in the second result are unique.
    """
    norm = single_spaced(docs.select(F.col("doc") if "doc" in docs.columns else F.monotonically_increasing_id().alias("doc"), "doc_id", "text"))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block_bytes)).cast("int")
    cut = norm.select("doc", "doc_id", count.alias("n_blocks"), F.sha2("text", 256).alias("text_sha256"), F.col("text").cast("binary").alias("raw"))
    parts = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda k: F.substring("raw", k * block_bytes + 1, F.lit(block_bytes)))
    blocks = cut.select("doc", "doc_id", "n_blocks", "text_sha256", F.posexplode(parts).alias("idx", "block"))
    blocks = blocks.withColumns({"text_sha256": F.when(F.col("idx") == 0, F.col("text_sha256")), "h": F.xxhash64("block")})
    blocks = materialize(blocks, "blocks", compression="zstd")
    named = materialize(_named(blocks, ["block"]), "names0")
    every = named.where("idx = 0").select("doc", "doc_id", "n_blocks", "text_sha256")

    def left_over(level: DataFrame) -> DataFrame:
        """Rows of the documents without a name of their own."""
        single = level.where("uses = 1").select("doc").distinct()
        return level.join(single, "doc", "left_anti")

    level = left_over(named).select("doc", "doc_id", "idx", "n_blocks", "name", F.col("n_blocks").alias("left"))
    found = []
    while True:
        level = materialize(level, "level")
        found.append(level.where("left = 1").select("doc", "doc_id", "n_blocks", "name"))
        level = level.where("left > 1")
        if level.isEmpty():
            break
        half, odd = (F.col("idx") / 2).cast("int"), F.col("idx") % 2 == 1
        # an odd last name stands alone; documents of another length never meet it in the end
        pairs = level.groupBy("doc", "doc_id", half.alias("idx"), "n_blocks", "left").agg(F.max(F.when(~odd, F.col("name"))).alias("first"), F.max(F.when(odd, F.col("name"))).alias("second"))
        pairs = materialize(pairs.withColumn("left", F.ceil(F.col("left") / 2).cast("int")).withColumn("h", F.xxhash64("first", "second")), "pairs")
        level = left_over(materialize(_named(pairs, ["first", "second"]), "names")).select("doc", "doc_id", "idx", "n_blocks", "name", "left")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return every, out


def _members(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(``identities``' first result; doc, keep, group_size of each row that has an equal).

    ``keep`` is the row to keep, by smallest doc_id (null last), then smallest doc.
    """
    every, shared = identities(docs, block_bytes)
    key = ["n_blocks", "name"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc"))
    groups = shared.groupBy(*key).agg(first.alias("keep"), F.count(F.lit(1)).alias("group_size"))
    groups = materialize(groups.where("group_size > 1"), "groups")
    return every, shared.join(groups, key).select("doc", "keep", "group_size")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, keep_id (smallest doc_id of equal texts), group_size, kept, text_sha256; one row per input row.

    Null and blank texts: null is the empty text; a text of white space only is one space.
    ``id_col`` is a number or string. Rows that repeat an id each count in ``group_size``, and each
    has ``kept`` = (doc_id = keep_id), as in the SQL; a null id counts too, its ``kept`` is null,
    and ``keep_id`` is null only where all ids of the group are. An empty table gives an empty
    result; columns other than the two named are ignored.
    """
    every, members = _members(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), block_bytes)
    return every.join(members, "doc", "left").select(
        "doc_id",
        F.coalesce("keep.doc_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.coalesce("keep.doc_id", "doc_id") == F.col("doc_id")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with exactly one row of each group of equal texts, all columns kept.

    It is a row with the smallest doc_id, or one with a null id where the group has no other.
    Nulls, blank texts, repeated rows and empty tables are as in ``exact_groups``.
    """
    rows, key = row_identity(docs, "doc_id")
    _, members = _members(rows.select(F.col(key).alias("doc"), "doc_id", "text"), BLOCK_BYTES)
    gone = sized(materialize(members.where("doc <> keep.doc").select(F.col("doc").alias("gone")), "gone"))
    return rows.join(gone, rows[key] == gone["gone"], "left_anti").select(docs.columns)


SQL = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n
"""
