r"""Periodic runs of words by the runs theorem, and texts with the repeats collapsed.

A run is a stretch that repeats a block of words and can't be extended. Every run holds a Lyndon root:
the longest Lyndon word at the root's first position, for one of the two orders of the words. So

1. the words of a slice of documents become one sequence of integers, each document closed by a
   symbol of its own; its inverse suffix array is made by doubling, where only unsettled ranks are sorted again;
2. the longest Lyndon word at each position ends before the next smaller value of the inverse suffix
   array, for the reversed order before the next greater one;
3. each root is extended to both sides by longest common extensions: minima over the LCP array, by a
   sparse table over blocks. Only documents with a root that repeats get LCP values.

Documents stay where they are: one pass of ``mapInArrow``, no shuffle. Working memory is some 300 bytes a
word of a slice of 2 MB of text, or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices, words

#: A reported run has at least so many words, and so many of its periods.
MIN_LENGTH, MIN_EXPONENT = 6, 4
_BLOCK = 32
_QUERIES = 1 << 16


def suffix_ranks(seq: np.ndarray) -> np.ndarray:
    """Inverse suffix array. No stretch that occurs twice may reach the end of ``seq``: end it with a symbol of its own."""
    n, base = len(seq), int(seq.max(initial=0)) + 1
    depth = next(d for d in (3, 2, 1) if base**d < 1 << 62)
    key = seq.astype(np.int64)
    for k in range(1, depth):
        key *= base
        key[: n - k] += seq[k:]
    act = np.argsort(key)
    key = key[act]
    rank = np.zeros(n, np.int64)
    while len(act):
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        at = np.arange(len(act))
        old = rank[act]
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
        rank[act] = old + np.maximum.accumulate(np.where(fresh, at, 0)) - group
        act = act[~(fresh & np.concatenate([fresh[1:], [True]]))]
        key = rank[act] * n + rank[act + depth]
        order = np.argsort(key)
        act, key, depth = act[order], key[order], 2 * depth
    return rank


def lyndon_ends(rank: np.ndarray, closers: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the longest Lyndon word at each position ends, for both orders; ranks below ``closers`` close a document.

    In the reversed order a closing symbol is the greatest, so a word without a next greater rank in its
    document has no root there; its end is given as its own place.
    """
    values = rank.tolist()
    low, high = list(range(len(values))), list(range(len(values)))
    falling: list[int] = []
    rising: list[int] = []
    for i, x in enumerate(values):
        if x < closers:
            for k in falling:
                low[k] = i
            falling.clear()
            rising.clear()
            continue
        while falling and values[falling[-1]] > x:
            low[falling.pop()] = i
        falling.append(i)
        while rising and values[rising[-1]] < x:
            high[rising.pop()] = i
        rising.append(i)
    return np.array(low, np.int64), np.array(high, np.int64)


class Extensions:
    """Longest common extensions of positions of a sequence, from its inverse suffix array."""

    def __init__(self, seq: np.ndarray, rank: np.ndarray):
        self.rank = rank
        sa = np.empty(len(rank), np.int64)
        sa[rank] = np.arange(len(rank))
        self.lcp = lcp = np.zeros(len(seq), np.int32)
        text, place, before, h = seq.tolist(), rank.tolist(), sa.tolist(), 0
        for i, r in enumerate(place):
            if r == 0:
                h = 0
                continue
            j = before[r - 1]
            while text[i + h] == text[j + h]:  # a closing symbol ends it
                h += 1
            lcp[r] = h
            if h:
                h -= 1
        whole = -(-len(lcp) // _BLOCK) * _BLOCK
        level = np.concatenate([lcp, np.full(whole - len(lcp), np.iinfo(np.int32).max, np.int32)]).reshape(-1, _BLOCK).min(axis=1)
        self.table = [level]
        while 2 << (len(self.table) - 1) <= len(level):
            last, step = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-step], last[step:]))

    def _least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of the LCP values from ``lo`` to ``hi``, both included."""
        steps = np.arange(_BLOCK)
        out = np.minimum(self.lcp[np.minimum(lo[:, None] + steps, hi[:, None])].min(axis=1), self.lcp[np.maximum(hi[:, None] - steps, lo[:, None])].min(axis=1))
        first, count = lo // _BLOCK + 1, hi // _BLOCK - lo // _BLOCK - 1
        for k, level in enumerate(self.table):
            own = np.flatnonzero((count >= 1 << k) & (count < 2 << k))
            if len(own):
                out[own] = np.minimum(out[own], np.minimum(level[first[own]], level[first[own] + count[own] - (1 << k)]))
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b)
        parts = [self._least(lo[k : k + _QUERIES], hi[k : k + _QUERIES]) for k in range(0, len(lo), _QUERIES)]
        return np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)


def find_runs(code: np.ndarray, row: np.ndarray, n_rows: int, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of all runs, by row, start and period. ``code`` holds the words of all rows one after the other, ``row`` each word's row, in order; starts count from the row's first word."""
    none = (np.empty(0, np.int64),) * 4
    if not len(code):
        return none
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count + 1)])[:-1]  # places in the sequence with closing symbols
    seq = np.empty(len(code) + n_rows, np.int64)
    seq[first + count] = np.arange(n_rows)
    seq[np.arange(len(code)) + row] = code + n_rows
    rank = suffix_ranks(seq)
    ends = lyndon_ends(rank, n_rows)
    i = np.concatenate([np.flatnonzero(e > np.arange(len(e))) for e in ends])
    p = np.concatenate([e[e > np.arange(len(e))] for e in ends]) - i
    for k in range(1, min_exponent - 1):  # a run's first root is followed by as many equal ones
        ok = i + k * p < len(seq)
        i, p = i[ok], p[ok]
        ok = seq[i] == seq[i + k * p]
        i, p = i[ok], p[ok]
    if not len(i):
        return none
    # LCP values only of the documents with such roots
    doc = np.searchsorted(first, i, side="right") - 1
    own = np.zeros(n_rows, bool)
    own[doc] = True
    place = np.flatnonzero(np.repeat(own, count + 1))
    shrunk = np.cumsum(np.repeat(own, count + 1)) - 1
    local = np.empty(len(place), np.int64)
    local[np.argsort(rank[place])] = np.arange(len(place))
    extend = Extensions(seq[place], local)
    i, low = shrunk[i], shrunk[first[doc]]
    right = extend(i, i + p)
    ok = right >= (min_exponent - 2) * p
    i, p, doc, low, right = i[ok], p[ok], doc[ok], low[ok], right[ok]
    # greatest x up to the period with equal x words before the root and before its repeat
    least, most = np.zeros(len(i), np.int64), np.minimum(p, i - low)
    while np.any(least < most):
        x = (least + most + 1) // 2
        ok = extend(i - x, i + p - x) >= x
        least, most = np.where(ok, x, least), np.where(ok, most, x - 1)
    length = least + p + right
    ok = (least < p) & (length >= np.maximum(min_length, min_exponent * p))  # only a run's first root
    found = np.unique(np.stack([doc[ok], (i - least - low)[ok], length[ok], p[ok]], axis=1), axis=0)
    found = found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]
    return tuple(found.T)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, source: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    r"""doc_id, n_words, runs (array of start, length, period, by start and period) and collapsed of every row.

    Words are ``[^\x20\x09-\x0D]+``. A run has at least ``min_length`` words and ``min_exponent`` (2 or more) periods.
    ``collapsed`` joins by one space the words that aren't in any run behind its first period. ``source``, if given,
    maps (id, number of words) to the numbers of the words that stand at each place instead. Null, empty and blank
    texts have no words, no runs and an empty ``collapsed``; repeated and null ids are rows like others. Other columns are ignored.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                row, code, dictionary = words(b.column("text"), lower=False)
                count = np.bincount(row, minlength=len(b))
                first = np.concatenate([[0], np.cumsum(count)])
                code = code.astype(np.int64)
                if source:
                    for k, i in enumerate(b.column("doc_id").to_pylist()):
                        if count[k] and (order := source(i, int(count[k]))) is not None:
                            code[first[k] : first[k + 1]] = code[first[k] + order]
                doc, start, length, period = find_runs(code, row, len(b), min_length, min_exponent)
                gone = np.zeros(len(code) + 1, np.int64)
                np.add.at(gone, first[doc] + start + period, 1)
                np.add.at(gone, first[doc] + start + length, -1)
                kept = np.cumsum(gone)[:-1] == 0
                lists = lambda rows: pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(b)))]).astype(np.int32))
                text = pc.binary_join(pa.ListArray.from_arrays(lists(row[kept]), dictionary.take(pa.array(code[kept]))), " ")
                runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(count.astype(np.int64)), pa.ListArray.from_arrays(lists(doc), runs), text], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exact exponent (least start, then period) and digests of all runs and of the collapsed text."""
    better = "a.length * b.period > b.length * a.period or (a.length * b.period = b.length * a.period and (a.start, a.period) < (b.start, b.period))"
    best = F.expr(f"array_sort(runs, (a, b) -> case when {better} then -1 when a = b then 0 else 1 end)")
    found = found.withColumn("best", F.when(F.size("runs") > 0, F.get(best, F.lit(0))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: The query's planted repeats, then every stretch of each period by equal words at a distance; of a stretch's periods the smallest counts.
SQL = r"""
with tab as materialized (select list(c order by n) as t from (select n, list_reduce(list_prepend(n::bigint, [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: if(c & 1 = 1, xor(3988292384, c >> 1), c >> 1)) as c from (select unnest(range(256)) as n))),
raw as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
  xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h from documents, tab),
placed as (select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as planted, (h // 10) % greatest(1, len(w)) as a, 3 + (h // 10) % 8 as d from raw),
docs as (select doc_id, case when planted then list_transform(range(n), lambda i: w[1 + if(i < a, i, a + (i - a) % (1 + (n - a) // d))]) else w end as w from placed),
words as (select doc_id, unnest(w) as x, unnest(range(len(w))) as i, len(w) as n from docs),
pairs as (select a.doc_id, b.i - a.i as q, a.i as i from words a join words b on a.doc_id = b.doc_id and a.x = b.x and b.i > a.i and 4 * (b.i - a.i) <= a.n),
marked as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as g from pairs),
stretches as (select doc_id, q, min(i) as s, count(*) + q as len from marked group by doc_id, q, g having count(*) + q >= greatest(6, 4 * q)),
runs as materialized (select doc_id, s as start, len as length, min(q) as period from stretches group by all),
best as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines,
  arg_min({start: start, length: length, period: period}, (-length::double / period, start, period)) as b from runs group by doc_id),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (select doc_id, string_agg(x, ' ' order by i) as text from words anti join gone using (doc_id, i) group by doc_id)
select docs.doc_id, coalesce(n_runs, 0) as n_runs, b.start as start, b.length as length, b.period as period, 1000 * b.length // b.period as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
from docs left join best using (doc_id) left join kept using (doc_id)
"""
