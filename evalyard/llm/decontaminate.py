"""Benchmark decontamination by Wu-Manber multi-pattern search.

Every benchmark item becomes windows of 13 consecutive words (shorter items: one window of
all their words). The windows are the patterns. A block shift table says how far the search
may jump at each position, a bucket keyed by the block at the window's end selects the
patterns that can occur there, and a direct comparison confirms the occurrence.

Documents stay where they are: one pass of ``mapInArrow`` over the scan, no shuffle. The
benchmark travels in blocks of bounded size; more blocks mean more passes over rows that are
numbered first, never a larger broadcast.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, row_keys
from ._text import LOWER

WINDOW = 13
#: Bytes of benchmark text that one pass broadcasts; a worker's tables take some 10 times as much, 24 while they are built, once a worker.
BLOCK_BYTES = 8 << 20
#: Lower-cases A-Z and turns each ASCII character outside 0-9, a-z into a space.
_WORDS = bytes(32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in LOWER)
#: Text positions that the tables take in at once.
_PIECE = 1 << 11
#: Shortest pattern of a length class and the block size that its tables use.
_CLASSES = ((32, 8), (16, 6), (8, 3), (3, 2))


def normalise(text: str | None) -> bytes:
    """Words joined by single spaces with one space at both ends; no words: empty."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    return b" " + b" ".join(found) + b" " if found else b""


class WuManber:
    """Tables for the patterns of one length class; ``m`` is the shortest pattern's length.

    A pattern is a range of ``blob``. The shift table is a byte for each value of a block's hash: blocks
    that share a value share the least shift, so a jump never passes an occurrence. Patterns are
    sorted by the hash of the block at ``m``; equal ones are one pattern with several owners.
    """

    def __init__(self, blob: bytes, start: np.ndarray, stop: np.ndarray, owner: np.ndarray, block: int):
        self.m = m = int((stop - start).min())
        self.block = block = min(block, m)
        self.blob, self.default = blob, min(m - block + 1, 255)
        self.mask = (1 << max(16, min(24, int(2 * len(start)).bit_length() + 3))) - 1
        self.shift = bytearray([self.default]) * (self.mask + 1)
        order, shift, mask = np.sort(start), self.shift, self.mask
        for low in range(0, len(blob) - block + 1, _PIECE):
            # a text position lies deepest in the pattern that starts first among those that hold it
            at = np.arange(low, min(low + _PIECE, len(blob) - block + 1))
            first = order[np.minimum(np.searchsorted(order, at + block - m), len(order) - 1)]
            inside = (first <= at) & (first >= at + block - m)
            for q, s in zip(array("q", at[inside].tobytes()), array("q", (m - block - at + first)[inside].tobytes())):
                h = hash(blob[q : q + block]) & mask
                if s < shift[h]:
                    shift[h] = s
        ends = np.fromiter((hash(blob[s + m - block : s + m]) for s in array("q", start)), np.int64, len(start))
        self.start, self.stop, self.owners, keys = array("q"), array("q"), [], array("q")
        known: dict[bytes, int] = {}
        for k in array("q", np.lexsort((owner, ends))):
            p = blob[start[k] : stop[k]]
            if not keys or keys[-1] != ends[k]:
                known = {}
            if p not in known:
                known[p] = len(keys)
                keys.append(int(ends[k]))
                self.start.append(int(start[k]))
                self.stop.append(int(stop[k]))
                self.owners.append(int(owner[k]))
            else:  # a tuple only where a window is shared
                had = self.owners[known[p]]
                had = had if isinstance(had, tuple) else (had,)
                if had[-1] != owner[k]:
                    self.owners[known[p]] = (*had, int(owner[k]))
        self.keys = keys

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(position, pattern number) of every occurrence."""
        m, block, shift, mask, keys, blob = self.m, self.block, self.shift, self.mask, self.keys, self.blob
        end, n = m, len(text)
        while end <= n:
            h = hash(text[end - block : end])
            if jump := shift[h & mask]:
                end += jump
                continue
            k = bisect_left(keys, h)
            while k < len(keys) and keys[k] == h:
                if text.startswith(blob[self.start[k] : self.stop[k]], end - m):
                    yield end - m, k
                k += 1
            end += 1


class Searcher:
    """All length classes over the windows of ``items`` = [(item id as text, text)]."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int = WINDOW):
        blob = bytearray()
        self.names = [i for i, _ in items]
        start, stop, owner = array("q"), array("q"), array("q")
        for k, (_, text) in enumerate(items):
            norm = normalise(text)
            gaps = [len(blob) + j for j, c in enumerate(norm) if c == 32]
            for j in range(max(1, len(gaps) - size) if gaps else 0):
                start.append(gaps[j])
                stop.append(gaps[min(j + size, len(gaps) - 1)] + 1)
                owner.append(k)
            blob += norm
        start, stop, owner = (np.frombuffer(a, np.int64) if a else np.zeros(0, np.int64) for a in (start, stop, owner))
        self.tables, most = [], np.inf
        for least, block in _CLASSES:
            own = (stop - start >= least) & (stop - start < most)
            if own.any():
                self.tables.append(WuManber(bytes(blob), start[own], stop[own], owner[own], block))
            most = least

    def search(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str | None]]:
        """(words, merged hit ranges of word positions with exclusive ends, sorted items that occur, null last)."""
        norm = normalise(text)
        found = sorted((at, t.stop[k] - t.start[k], i, k) for i, t in enumerate(self.tables) for at, k in t.find(norm))
        last, word, merged, items = 0, 0, [], set()
        for at, length, i, k in found:
            word += norm.count(b" ", last, at)
            last = at
            stop = word + norm.count(b" ", at, at + length) - 1
            if merged and word <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], stop)
            else:
                merged.append([word, stop])
            had = self.tables[i].owners[k]
            items.update(self.names[x] for x in (had if isinstance(had, tuple) else (had,)))
        return max(0, norm.count(b" ") - 1), [tuple(x) for x in merged], sorted(items, key=lambda x: (x is None, x or ""))


_SCHEMA = "array<struct<start:bigint,end:bigint>>"
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
#: The searcher that this worker built last, and its name: tasks of one pass share it.
_built: tuple[str, Searcher] | None = None


def _searcher(name: str, items: list[tuple[str | None, str | None]], size: int) -> Searcher:
    global _built
    if _built is None or _built[0] != name:
        _built = None  # the old tables go before new ones are built
        _built = (name, Searcher(items, size))
    return _built[1]


def _scan(docs: DataFrame, text: str, shared, size: int, rows: str) -> DataFrame:
    """``docs`` without ``text`` unless ``rows`` is "all", plus found_words, found_hits and found_items; rows "hit" are those with hits."""
    keep = [c for c in docs.columns if rows == "all" or c != text]
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _searcher(name, shared.value, size)
        for b in batches:
            found = [searcher.search(t.as_py()) for t in b.column(text)]
            cols = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), _HITS, pa.list_(pa.string())))]
            out = pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *cols], [*keep, "found_words", "found_hits", "found_items"])
            yield out.filter(pa.array([bool(f[1]) for f in found], pa.bool_())) if rows == "hit" else out

    schema = T.StructType([docs.schema[c] for c in keep] + T.StructType.fromDDL(f"found_words bigint, found_hits {_SCHEMA}, found_items array<string>").fields)
    return docs.mapInArrow(run, schema)


def _search(docs: DataFrame, text: str, bench: DataFrame, size: int, block_bytes: int, rows: str) -> DataFrame:
    """``_scan`` of all benchmark blocks: one pass, or several that meet by a written number of each row."""
    bench = bench.select(F.col("item_id").cast("string").alias("item"), "text")
    total = bench.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    context = docs.sparkSession.sparkContext
    if blocks == 1:
        return _scan(docs, text, context.broadcast([tuple(r) for r in bench.collect()]), size, rows)
    docs, key = row_keys(docs)
    passes = []
    for k in range(blocks):
        # one block at a time is on the driver and on the workers
        shared = context.broadcast([tuple(r) for r in bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()])
        passes.append(materialize(_scan(docs.select(key, text), text, shared, size, "hit"), "pass"))
        shared.destroy()
    every = reduce(DataFrame.unionByName, passes).groupBy(key).agg(
        F.array_sort(F.flatten(F.collect_list("found_hits"))).alias("found_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found_items")))).alias("found_items"),
    )
    merged = F.expr("""
        aggregate(found_hits, cast(array() as array<struct<start:bigint,end:bigint>>), (a, x) ->
          if(size(a) > 0 and element_at(a, -1).end >= x.start,
             concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end)))),
             concat(a, array(x))))""")
    none = _scan(docs, text, context.broadcast([]), size, rows).drop("found_hits", "found_items")  # counts the words
    return none.join(every.withColumn("found_hits", merged), key, "left").drop(key).withColumns({"found_hits": F.coalesce("found_hits", F.array().cast(_SCHEMA)), "found_items": F.coalesce("found_items", F.array().cast("array<string>"))})


def find_benchmark(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Occurrences of benchmark windows: doc_id, n_words, hits (ranges of word positions), items; a row for each row of ``docs``.

    A null or wordless text has no words and no hits; repeated rows give repeated results, rows
    with a null id their own; an empty benchmark hits nothing. Items that repeat an id count once;
    those without an id are one null at the end of ``items``. Columns other than the two named
    are ignored. The benchmark is read in ``ceil(bytes / block_bytes)`` blocks, one pass over the
    documents each; the number of blocks doesn't change the result.
    """
    found = _search(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", bench, size, block_bytes, "narrow")
    return found.select("doc_id", F.col("found_words").alias("n_words"), F.col("found_hits").alias("hits"), F.col("found_items").alias("items"))


def _hit(hits: str) -> Column:
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])


def contaminated(n_words: str, hits: str) -> Column:
    """The 5 % rule."""
    return (F.size(hits) > 0) & (20 * _hit(hits) >= F.col(n_words))


def contamination(found: DataFrame) -> DataFrame:
    """Digest of ``find_benchmark``: counts, hash of the items, and the 5 % rule."""
    return found.select(
        "doc_id",
        "n_words",
        _hit("hits").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated("n_words", "hits").alias("contaminated"),
    )


def decontaminate(docs: DataFrame, bench: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept, whatever their names; null and repeated ids are judged row by row."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    found = _search(docs.toDF(*names), text, bench, WINDOW, block_bytes, "all")
    return found.where(~contaminated("found_words", "found_hits")).select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))


SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bs as (select item, w, least(13, len(w)) as size, unnest(range(1, greatest(1, len(w) - 12) + 1)) as i from b where len(w) > 0),
bw as (select distinct item, size, array_to_string(w[i : i + size - 1], ' ') as win from bs),
sizes as (select distinct size from bw),
dp as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d where len(w) > 0),
dw as (select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as win from dp cross join sizes where i + size - 1 <= len(w)),
hits as (select doc_id, i, dw.size, item from dw join bw on dw.size = bw.size and dw.win = bw.win),
covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + size)) as p from hits) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join covered using (doc_id) left join its using (doc_id)
"""
