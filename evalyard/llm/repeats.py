r"""Removal of byte strings that occur before: suffix sorting by bucket-pointer refinement.

A string of ``length`` bytes is removed where it also starts earlier, in a smaller document or before in
the same one. Positions are numbers over the whole corpus, in document order.

1. Texts that equal an earlier text as a whole are removed whole; the rest of the work sees distinct texts.
2. Initial q-gram buckets. Of each string only the q-gram of least hash (leftmost) counts, its anchor: equal strings
   have equal anchors, at the same place within. Neighbouring strings share their anchor, so there is
   one entry for some 25 bytes. Buckets of one entry are settled: their strings occur once.
3. Entries of a bucket with the same bytes around (all that their strings read) are a class. All
   but the first entry of a class are repeats of the first. A bucket of one class is settled.
4. Else the buckets are refined, with the bytes of each class's first entry: positions get the pointer
   of their bucket, the place where it begins in sorted order; positions that share a bucket are sorted by the
   pointers at a later offset, which gives buckets of twice the depth, and the new pointers serve the next
   refinement, until the depth is ``length``. The first position of a last bucket stays, the others are repeats.

Scale: texts are read where they lie; entries move as three numbers. Only entries in shared buckets are
joined and written, only classes of unsettled buckets take their bytes along. Hot buckets and classes are
combined in each task first and joined by broadcast; buckets of over ``LIMIT`` classes are not refined in one
task but string by string, by a 128-bit hash. Buckets and classes are told apart by 64-bit and 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rows import row_numbers
from ..session import materialize
from ._text import BROADCAST_BYTES, join_counted, mix64, row_identity, sized, slices

LENGTH = 100
#: Classes of a bucket up to which one task refines it.
LIMIT = 4096
#: Starts of strings that one step of the scan takes in.
PIECE = 1 << 20
_C = np.uint64(0x9E3779B97F4A7C15)


def grams(length: int) -> tuple[int, int]:
    """(a power of two, bytes of a q-gram) for strings of ``length`` bytes."""
    p = 1 << max(0, (length // 3).bit_length() - 1)
    return p, p + p // 2


def _doubled(h: np.ndarray, k: int, salt: int) -> np.ndarray:
    """Hashes of 2 k bytes from those of k bytes."""
    out = h[: len(h) - k] * (_C + np.uint64(2 * salt))
    out += h[k:]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out


def anchors(data: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(bucket, class, place, first start, last start) of the anchors of pieces that follow each other and end at ``stops``; pieces have ``length`` bytes at least."""
    p, q = grams(length)
    h, k, half = data.astype(np.uint64) + np.uint64(1), 1, None
    while k < p:
        half, h, k = h, _doubled(h, k, k), 2 * k
    wide = _doubled(h, p, p)
    x = mix64(h if half is None else h[: len(h) - p // 2] * _C + half[p : p + len(h) - p // 2])
    low = np.uint64(len(x).bit_length())
    least = (x >> low << low) | np.arange(len(x), dtype=np.uint64)
    reach, k = length - q + 1, 1
    while 2 * k <= reach:
        least, k = np.minimum(least[:-k], least[k:]), 2 * k
    if k < reach:
        least = np.minimum(least[: len(least) - (reach - k)], least[reach - k :])
    inside = np.ones(len(least), bool)
    for stop in stops[:-1]:
        inside[max(0, stop - length + 1) : stop] = False
    start = np.flatnonzero(inside)
    at = (least[start] & np.uint64((1 << int(low)) - 1)).astype(np.int64)
    # a piece's last string and the next piece's first one can't have the same anchor
    fresh = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    first, last, at = start[fresh], start[np.append(fresh[1:] - 1, len(start) - 1)], at[fresh]
    end = last + length
    c = (end - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (at - first).astype(np.uint64)
    for k in range(-(-(2 * length - q) // (2 * p))):
        c = mix64(c * _C + wide[np.minimum(first + 2 * p * k, end - 2 * p)])
    return x[at].view(np.int64), c.view(np.int64), at, first, last


def _entries(rows: DataFrame, length: int, bits: int, classes: bool) -> DataFrame:
    """h, c, at and the reach of each anchor's strings before it, for written or scanned ``rows`` (key, text)."""

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for b in slices(batch, limit=PIECE):
            for key, text in zip(b.column("key").to_pylist(), b.column("text")):
                data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid and text.as_buffer().size else np.empty(0, np.uint8)
                for low in range(0, len(data) - length + 1, PIECE):
                    yield (key << bits) + low, data[low : low + PIECE + length - 1]

    def found(held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        stops = np.cumsum([len(d) for _, d in held])
        h, c, at, first, last = anchors(np.concatenate([d for _, d in held]), stops, length)
        if not classes:
            return pa.RecordBatch.from_arrays([pa.array(h)], ["h"])
        piece = np.searchsorted(stops, at, side="right")
        base = np.array([k for k, _ in held], np.int64) - np.concatenate([[0], stops[:-1]])
        reach = ((at - first) * (length + 1) + last - first)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(c), pa.array(at + base[piece]), pa.array(reach)], ["h", "c", "at", "reach"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for key, data in pieces(batch):
                held.append((key, data))
                size += len(data)
                if size >= PIECE:
                    yield found(held)
                    held, size = [], 0
        if held:
            yield found(held)

    return rows.mapInArrow(run, "h bigint, c bigint, at bigint, reach bigint" if classes else "h bigint")


def refine(data: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Bucket pointers of depth ``length``: equal for two positions exactly when the next ``length`` bytes are.

    ``left`` is the number of bytes from each position to the end of its span; positions with fewer than ``length`` get -1.
    """
    n, depth = len(data), 1
    key = data.astype(np.uint64)
    while depth < 8 and 2 * depth <= length:
        step = key[: len(key) - depth] << np.uint64(8 * depth)
        key = np.concatenate([step | key[depth:], np.zeros(n - len(step), np.uint64)])[:n]
        depth *= 2
    pointer = np.zeros(n, np.int64)
    act = np.flatnonzero(left >= depth)
    key = key[act].view(np.int64)
    order = np.argsort(key)
    act, key = act[order], key[order]
    old = np.zeros(len(act), np.int64)
    while True:
        place = np.arange(len(act))
        fresh = np.ones(len(act), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
        head = np.ones(len(act), bool)
        head[1:] = old[1:] != old[:-1]
        # a bucket's pointer is the place of its first position among all
        pointer[act] = old + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(head, place, 0))
        if depth >= length:
            break
        single = fresh & np.append(fresh[1:], True)
        step = min(depth, length - depth)
        depth += step
        act = act[~single & (left[act] >= depth)]
        old, key = pointer[act], pointer[act + step]
        order = np.lexsort((key, old))
        act, old, key = act[order], old[order], key[order]
    pointer[left < length] = -1
    return pointer


def repeated_starts(spans: list[bytes], first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the starts, both included, whose strings also start earlier in one of the spans; ``first`` is each span's place in the corpus."""
    size = np.array([len(s) for s in spans], np.int64)
    data = np.frombuffer(b"".join(spans), np.uint8)
    end = np.repeat(np.cumsum(size), size)
    left = end - np.arange(len(data))
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(data))
    pointer = refine(data, left, length)
    start = np.flatnonzero(pointer >= 0)
    start = start[np.lexsort((at[start], pointer[start]))]
    again = np.zeros(len(start), bool)
    again[1:] = pointer[start[1:]] == pointer[start[:-1]]
    return joined(np.sort(at[start[again]]))


def joined(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers as (from, to) of stretches without gaps."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate([[0], cut + 1])], starts[np.append(cut, len(starts) - 1)]


def _refined(spans: DataFrame, length: int) -> DataFrame:
    """(from, to) of repeated starts: buckets come whole, one after the other."""

    def settle(t: pa.Table) -> pa.RecordBatch:
        lo, hi = repeated_starts(t.column("span").to_pylist(), t.column("first").to_numpy(), length)
        return pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], ["lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            h = t.column("h").to_numpy()
            cuts = np.flatnonzero(h[1:] != h[:-1])
            held = t
            if len(cuts):
                held = t.slice(cuts[-1] + 1)
                yield settle(t.slice(0, cuts[-1] + 1))
        if held is not None and len(held):
            yield settle(held)

    return spans.repartition("h").sortWithinPartitions("h").mapInArrow(run, "lo bigint, hi bigint")


def _by_string(spans: DataFrame, length: int) -> DataFrame:
    """(from, to) of repeated starts in buckets of many classes, string by string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, len(b), 256):
                part = b.slice(k, 256)
                at, name = [], []
                for s, first in zip(part.column("span").to_pylist(), part.column("first").to_pylist()):
                    at += range(first, first + len(s) - length + 1)
                    name += [xxhash.xxh3_128_digest(s[i : i + length]) for i in range(len(s) - length + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.binary()), pa.array(at, pa.int64())], ["name", "at"])

    strings = materialize(spans.mapInArrow(run, "name binary, at bigint"), "strings")
    least = materialize(strings.groupBy("name").agg(F.min("at").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "least")
    return join_counted(strings, least, "name", "n").where("at > least").select(F.col("at").alias("lo"), F.col("at").alias("hi"))


def _spans(rows: DataFrame, reps: DataFrame, length: int, bits: int) -> DataFrame:
    """h, k, first and the bytes that the strings of each class's first entry read."""
    at = F.col("at") - F.floor(F.col("reach") / (length + 1))
    listed = reps.select(F.shiftright("at", bits).alias("of"), F.struct(at.bitwiseAND((1 << bits) - 1).alias("from"), (F.col("reach") % (length + 1)).cast("bigint").alias("more"), "h", "k").alias("x"))
    listed = listed.groupBy("of").agg(F.collect_list("x").alias("xs"))
    if reps.count() * 48 <= BROADCAST_BYTES:
        listed = F.broadcast(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                for key, text, xs in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), b.column("xs")):
                    x, raw = xs.values, text.encode("utf-8", "surrogatepass")
                    low = x.field("from").to_numpy()
                    spans = [raw[i : i + n + length] for i, n in zip(low.tolist(), x.field("more").to_pylist())]
                    yield pa.RecordBatch.from_arrays([x.field("h"), x.field("k"), pa.array(low + (key << bits)), pa.array(spans, pa.binary())], ["h", "k", "first", "span"])

    return rows.join(listed, rows["key"] == listed["of"]).select("key", "text", "xs").mapInArrow(run, "h bigint, k bigint, first bigint, span binary")


def _numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """(key, doc_id, text) in document order, and the bits that a position within a text takes."""
    longest = F.max(F.octet_length("text"))
    rows, key = row_identity(docs, "doc_id")
    if key == "doc_id":
        low, high, most = docs.agg(F.min("doc_id"), F.max("doc_id"), longest).first()
        bits = max(1, int(most or 0).bit_length())
        if low is None or (low >= 0 and high < 1 << (62 - bits)):
            return docs.select(F.col("doc_id").cast("bigint").alias("key"), "doc_id", "text"), bits
    rows = row_numbers(rows.select("doc_id", "text"), [F.asc_nulls_last("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256)], "key")
    return rows.select("key", "doc_id", "text"), max(1, int(docs.agg(longest).first()[0] or 0).bit_length())


def _starts(rows: DataFrame, length: int, bits: int) -> DataFrame:
    """(from, to) of all starts, as corpus positions, whose strings also start earlier."""
    # texts that equal an earlier one
    ids = materialize(rows.where(F.octet_length("text") >= length).select("key", F.octet_length("text").cast("bigint").alias("n"), F.sha2("text", 256).alias("digest")), "digests")
    groups = materialize(ids.groupBy("digest").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "copies")
    gone = materialize(join_counted(ids, groups, "digest", "copies").where("key > least").select("key", "n"), "gone")
    whole = gone.select(F.shiftleft("key", bits).alias("lo"), (F.shiftleft("key", bits) + F.col("n") - length).alias("hi"))
    lost = sized(gone.select(F.col("key").alias("lost")))
    texts = rows.where(F.octet_length("text") >= length).select("key", "text")
    texts = texts.join(lost, texts["key"] == lost["lost"], "left_anti")

    shared = materialize(_entries(texts, length, bits, classes=False).groupBy("h").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1"), "shared")
    every = _entries(texts, length, bits, classes=True)
    small = shared.count() * 24 <= BROADCAST_BYTES
    entries = every.join(F.broadcast(shared.select("h")), "h") if small else join_counted(every, shared, "h", "uses").drop("uses")
    entries = materialize(entries.select("h", "c", "at", "reach"), "entries")

    classes = materialize(entries.groupBy("h", "c").agg(F.min("at").alias("least"), F.min("reach").alias("reach"), F.count(F.lit(1)).alias("n")), "classes")
    # a class's entries have one reach: its hash takes it in
    later = join_counted(entries.drop("reach"), classes.where("n > 1"), ["h", "c"], "n").where("at > least")
    start = F.col("at") - F.floor(F.col("reach") / (length + 1))
    later = later.select(start.alias("lo"), (start + F.col("reach") % (length + 1)).alias("hi"))

    mixed = materialize(classes.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "mixed")
    reps = materialize(join_counted(classes.select("h", F.col("least").alias("at"), "reach"), mixed, "h", "k"), "firsts")
    spans = materialize(_spans(texts, reps, length, bits), "spans", compression="zstd")
    refined = _refined(spans.where(f"k <= {LIMIT}").select("h", "first", "span"), length)
    found = whole.unionByName(later).unionByName(refined)
    many = spans.where(f"k > {LIMIT}")
    return found if many.isEmpty() else found.unionByName(_by_string(many.select("first", "span"), length))


def _cuts(starts: DataFrame, length: int, bits: int) -> DataFrame:
    """of, cut: the maximal removed runs of bytes of each text that loses any."""
    each = starts.select(F.shiftright("lo", bits).alias("of"), F.struct(F.col("lo").bitwiseAND((1 << bits) - 1).alias("lo"), F.col("hi").bitwiseAND((1 << bits) - 1).alias("hi")).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for xs in b.column("xs"):
                lo, hi = xs.values.field("lo").to_numpy(), xs.values.field("hi").to_numpy()
                order = np.argsort(lo)
                lo, hi = lo[order], np.maximum.accumulate(hi[order]) + length
                cut = np.flatnonzero(lo[1:] > hi[:-1])
                out.append([{"start": int(s), "stop": int(e)} for s, e in zip(lo[np.concatenate([[0], cut + 1])], hi[np.append(cut, len(hi) - 1)])])
            yield pa.RecordBatch.from_arrays([b.column("of"), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], ["of", "cut"])

    return each.groupBy("of").agg(F.collect_list("x").alias("xs")).mapInArrow(run, "of bigint, cut array<struct<start:bigint,stop:bigint>>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, removed (maximal runs of removed bytes, start and stop) and kept (the other bytes, joined) of every row.

    A byte goes if a string of ``length`` bytes over it also starts earlier: in a row of smaller id (null last), or
    before in the same text. What is removed is judged on the input. Null counts as empty; texts of fewer than ``length`` bytes stay.
    Rows that repeat an id follow each other by their text's hash; of equal ones the first stays. ``kept`` may end within
    a character. An empty table gives an empty result; other columns are ignored.
    """
    if length < 3:
        raise ValueError("strings have three bytes at least")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows, bits = _numbered(docs)
    cuts = materialize(_cuts(_starts(rows, length, bits), length, bits), "cuts")
    if (cuts.agg(F.sum(F.size("cut") + 1)).first()[0] or 0) * 32 <= BROADCAST_BYTES:
        cuts = F.broadcast(cuts)
    joined = rows.join(cuts, rows["key"] == cuts["of"], "left").select("doc_id", "text", "cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                kept = []
                for text, cut in zip(b.column("text"), b.column("cut").to_pylist()):
                    raw, at, parts = text.as_buffer().to_pybytes(), 0, []
                    for x in cut or []:
                        parts.append(raw[at : x["start"]])
                        at = x["stop"]
                    kept.append(b"".join([*parts, raw[at:]]) if cut else raw)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([t.as_buffer().size for t in b.column("text")], pa.int64()), b.column("cut"), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, removed array<struct<start:bigint,stop:bigint>>, kept binary")
    return out.withColumn("removed", F.coalesce("removed", F.array().cast("array<struct<start:bigint,stop:bigint>>")))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of the kept bytes."""
    total = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, x: a + x["stop"] - x["start"])
    return found.select("doc_id", "n_bytes", total.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
with d as materialized (select doc_id, encode(coalesce(text, '')) as b, octet_length(encode(coalesce(text, ''))) as n from documents),
w as (select doc_id, s, array_slice(b, s + 1, s + 100) as g from (select doc_id, b, unnest(range(n - 99)) as s from d where n >= 100)),
r as (select doc_id, s, row_number() over (partition by g order by doc_id, s) as k from w),
o as (select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as fresh from r where k > 1),
i as (select doc_id, s, sum(fresh) over (partition by doc_id order by s) as span from o),
c as materialized (select doc_id, span, min(s) as a, max(s) + 100 as z from i group by all),
t as (select doc_id, count(*) as n_spans, sum(z - a)::bigint as n_removed from c group by doc_id),
gaps as (select doc_id, coalesce(lag(z) over (partition by doc_id order by a), 0) as x, a as y from c union all select doc_id, max(z), max(n) from c join d using (doc_id) group by doc_id),
kept as (select doc_id, string_agg(case when y > x then hex(array_slice(b, x + 1, y)) else '' end, '' order by x) as h from gaps join d using (doc_id) group by doc_id)
select d.doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(coalesce(unhex(h), b)) as kept_sha256
from d left join t using (doc_id) left join kept using (doc_id)
"""
