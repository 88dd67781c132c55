"""Shared text helpers: ASCII lower-casing, bounded slices of Arrow batches, vectorised words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import row_keys

#: Maps the bytes A-Z to a-z and leaves every other byte alone.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Lower-cases A-Z and turns each ASCII character outside 0-9, a-z into a space.
ALNUM_WORDS = bytes(32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in LOWER)
SLICE_BYTES = 2 << 20
#: Keys with over 1/HOT of all rows are fewer than HOT: they are joined by broadcast.
HOT = 1000
#: Bytes up to which a written table is broadcast; beyond, an ordinary join.
BROADCAST_BYTES = 64 << 20


def sized(table: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted rows of 8-byte columns are few enough."""
    return F.broadcast(table) if table.count() * 8 * (len(table.columns) + 1) <= BROADCAST_BYTES else table


def join_counted(rows: DataFrame, keyed: DataFrame, key: str | list[str], count: str) -> DataFrame:
    """``rows`` joined to written ``keyed``, which has one row a key and the number ``count`` of rows with it.

    Keys with over 1/``HOT`` of all rows are fewer than ``HOT`` and go by broadcast, the others by shuffle,
    so that no task gets more than such a share.
    """
    keys = [key] if isinstance(key, str) else key
    most = (keyed.agg(F.sum(count)).first()[0] or 0) // HOT
    hot = keyed.where(F.col(count) > most).select(*(F.col(k).alias(f"_hot_{k}") for k in keys), *(c for c in keyed.columns if c not in keys))
    if most == 0 or hot.isEmpty():
        return rows.join(keyed, keys)
    names = [f"_hot_{k}" for k in keys]
    same = [F.col(k) == F.col(f"_hot_{k}") for k in keys]
    often = rows.join(F.broadcast(hot), same).drop(*names)
    seldom = rows.join(F.broadcast(hot.select(*names)), same, "left_anti").join(keyed.where(F.col(count) <= most), keys)
    return often.unionByName(seldom)


def row_identity(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """(rows, column that tells them apart): the id where it is an integer that no rows share or lack, else a written number."""
    if docs.schema[id_col].dataType.typeName() in ("long", "integer"):
        shared = docs.groupBy(F.col(id_col).alias("id")).count().where("id is null or count > 1")
        if shared.isEmpty():
            return docs, id_col
    return row_keys(docs)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes of text each (one row at least).

    Working memory thus follows the slice, or the longest single text, and never the batch.
    """
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(size)
    start, done = 0, 0
    while start < len(size):
        stop = max(start + 1, int(np.searchsorted(end, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, done = stop, int(end[stop - 1])


def lower_ascii(texts: pa.Array) -> pa.Array:
    """Nulls become empty; only A-Z change."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])  # compacts a slice's buffers
    valid, offsets, data = texts.buffers()
    if data is None or not data.size:
        return texts
    return pa.Array.from_buffers(texts.type, len(texts), [valid, offsets, pa.py_buffer(data.to_pybytes().translate(LOWER))], offset=texts.offset)


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    r"""Words ``[^\x20\x09-\x0D]+`` of (lower-cased) texts: (row of each word, code of each word, dictionary).

    The dictionary may hold an empty string that no code refers to.
    """
    lists = pc.ascii_split_whitespace(lower_ascii(texts) if lower else pa.concat_arrays([pc.fill_null(texts, "")]))
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    if len(coded.dictionary):
        real = (pc.binary_length(coded.dictionary).to_numpy() > 0)[code]
        code, row = code[real], row[real]
    return row, code, coded.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants) over uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
