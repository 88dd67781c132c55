r"""Similarity join of documents on word shingles: rare-first prefix filtering.

Sets are the distinct 5-word shingles of a text, as 64-bit hashes; two documents link when the
Jaccard similarity of their sets is 0.8 or more. The result names each document's component.

1. Documents with equal sets form one class; only its smallest document goes on.
2. A cheap exact test. With the first ``|x| - need + l`` shingles of each set in hash order, two
   linked sets share at least ``l`` of them. ``l`` grows with the set, so a document must share
   as many as the smallest set that it can link to asks for. Most documents end here, after
   moving a quarter of their shingles.
3. Shingles that occur in exactly the same documents are one token with a weight, so a shared line or
   passage is one token. Tokens are ordered rare first, by document frequency; shingles of one document
   come before all others and match nothing.
4. Length and positional filters deal prefix tokens out to lists: a list holds one token and one narrow class of
   lengths. The longer document of a pair looks from its whole prefix, the shorter one is found by a shorter
   prefix, so that a pair meets only where both can still share enough.
5. Each list is compared with one hub first; then, with the components known so far, what lies in
   different components is. A large group of near copies thus costs as many pairs as it has members.
6. A list that stays long is not compared pair by pair: its documents go to longer lists of keys, one for
   each further prefix token that they can share, up to ``DEPTH`` tokens. Documents whose tokens so far
   are enough to link go to the one of them with the smallest set: if any of them are linked by these tokens alone, they are with it.
7. Each candidate pair is verified once: by its first common token, a suffix filter behind it, then the exact overlap.

Joins on one token or list are left to adaptive execution's skew joins, which split a key with very many rows.

What stays: documents that share most of ``DEPTH``-token combinations without links are compared in lists that have
shrunk with each token, but are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._text import mix64, row_identity, sized, slices, words
from .components import components

SIZE, PERCENT = 5, 80
#: Part of a set that the first test reads beyond the plain prefix.
EXTRA = 0.05
#: Documents outside a list's largest component up to which its pairs are compared.
LONG = 48
#: Most prefix tokens that a list's key is made of.
DEPTH = 4
#: An entry's deeper keys cost so many comparisons each.
PAYS = 4
#: Ratio of the lengths within a class.
CLASS = 1.05
_M = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, sorted by row and hash."""
    row, code, dictionary = words(texts)
    by_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in dictionary.to_pylist()), np.uint64, len(dictionary))
    h = by_word[code]
    count = np.bincount(row, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)])[:-1]

    def chain(starts: np.ndarray, k: int) -> np.ndarray:
        acc = np.zeros(len(starts), np.uint64)
        for j in range(k):
            acc = mix64(acc * _M + h[starts + j] + np.uint64(j + 1))
        return acc

    whole = np.arange(max(0, len(h) - size + 1))
    whole = whole[row[whole] == row[whole + size - 1]]
    rows, hashes = [row[whole]], [chain(whole, size)]
    for k in range(1, size):
        short = np.flatnonzero(count == k)
        rows.append(short)
        hashes.append(chain(first[short], k))
    r, x = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((x, r))
    r, x = r[order], x[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    return r[keep], x[keep]


def _lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _probes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc, n, two sums that tell sets apart, the first shingles in hash order and how many must be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                r, x = shingle_sets(b.column("text"), size)
                n = np.bincount(r, minlength=len(b))
                first = np.concatenate([[0], np.cumsum(n)])[:-1]
                need = -(-percent * n // 100)
                extra = lambda k: np.maximum(1, np.ceil(EXTRA * k).astype(int))
                length = np.where(n > 0, np.minimum(n, n - need + extra(n)), 0)
                s1, s2 = np.zeros(len(b), np.uint64), np.zeros(len(b), np.uint64)
                if len(r):
                    s1[n > 0] = np.add.reduceat(x, first[n > 0])
                    s2[n > 0] = np.add.reduceat(mix64(x ^ _M), first[n > 0])
                head = np.arange(len(r)) - first[r] < length[r]
                cols = [b.column(0), pa.array(n), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(np.where(n > 0, extra(need), 0)), _lists(x[head], r[head], len(b))]
                yield pa.RecordBatch.from_arrays(cols, ["doc", "n", "s1", "s2", "least", "probe"])

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {kind}, n bigint, s1 bigint, s2 bigint, least bigint, probe array<bigint>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                r, x = shingle_sets(b.column("text"), size)
                yield pa.RecordBatch.from_arrays([b.column(0), _lists(x, r, len(b))], ["doc", "tokens"])

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {kind}, tokens array<bigint>")


def hamming_bound(a: np.ndarray, b: np.ndarray, most: int, depth: int = 3, wa: np.ndarray | None = None, wb: np.ndarray | None = None) -> int:
    """Suffix filter: a lower bound of the symmetric difference of two sorted sets, by halving at medians.

    ``wa`` and ``wb`` are the weights summed up to each element, 0 first; without them all elements weigh one.
    """
    wa = np.arange(len(a) + 1) if wa is None else wa
    wb = np.arange(len(b) + 1) if wb is None else wb
    if not len(a) or not len(b) or not depth:
        return abs(int(wa[-1] - wa[0]) - int(wb[-1] - wb[0]))
    mid = len(b) // 2
    at = int(np.searchsorted(a, b[mid]))
    same = at < len(a) and a[at] == b[mid]
    alone = 0 if same else int(wb[mid + 1] - wb[mid])
    left = (a[:at], b[:mid]), (wa[: at + 1], wb[: mid + 1])
    right = (a[at + same :], b[mid + 1 :]), (wa[at + same :], wb[mid + 1 :])
    rest = abs(int(right[1][0][-1] - right[1][0][0]) - int(right[1][1][-1] - right[1][1][0])) + alone
    low = hamming_bound(*left[0], most - rest, depth - 1, *left[1])
    if low + rest > most:
        return low + rest
    return low + alone + hamming_bound(*right[0], most - low - alone, depth - 1, *right[1])


def needed(na: int, nb: int, percent: int = PERCENT) -> int:
    """Least overlap of sets of two sizes that link."""
    return -(-percent * (na + nb) // (100 + percent))


def linked(na: int, a: np.ndarray, wa: np.ndarray, nb: int, b: np.ndarray, wb: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two documents link, by their tokens in one order of all tokens, rare first, and the tokens' weights."""
    need = needed(na, nb, percent)
    first, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(first):
        return False
    # behind the first common token: what is left must overlap enough, and the suffix filter may already rule it out
    i, j = int(at.min()), int(to.min())
    sa, sb = np.argsort(a[i:]), np.argsort(b[j:])
    ca, cb = np.concatenate([[0], np.cumsum(wa[i:][sa])]), np.concatenate([[0], np.cumsum(wb[j:][sb])])
    most = int(ca[-1] + cb[-1]) - 2 * need
    if most < 0 or hamming_bound(a[i:][sa], b[j:][sb], most, 3, ca, cb) > most:
        return False
    return int(wa[at].sum()) >= need


def _verified(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The linked ones of distinct pairs (a, b)."""
    side = lambda s: profiles.select(F.col("doc").alias(s), F.col("n").alias(f"n{s}"), F.col("tokens").alias(f"t{s}"), F.col("weights").alias(f"w{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = [(b.column(f"n{s}").to_numpy(), b.column(f"t{s}"), b.column(f"w{s}")) for s in "ab"]
            ok = [linked(int(na), ta.values.to_numpy(), wa.values.to_numpy(), int(nb), tb.values.to_numpy(), wb.values.to_numpy(), percent) for na, ta, wa, nb, tb, wb in zip(*sides[0], *sides[1])]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    kind = profiles.schema["doc"].dataType.simpleString()
    return joined.select("a", "b", *(f"{c}{s}" for s in "ab" for c in "ntw")).mapInArrow(run, f"a {kind}, b {kind}")


def _profiles(sets: DataFrame, percent: int) -> DataFrame:
    """doc, n, and the common tokens rare first with their weights and ``rests``, the weight from each token to the end.

    Documents without a token whose rest could still make a link are left out.
    """
    exploded = sets.select("doc", F.size("tokens").cast("bigint").alias("n"), F.explode("tokens").alias("token"))
    # the documents of a shingle by their number and two sums of hashes without carry
    who = [F.bit_xor(F.xxhash64("doc", F.lit(k))) for k in range(2)]
    where = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.xxhash64(F.count(F.lit(1)), *who).alias("name")).where("df > 1")
    common = exploded.join(materialize(where, "where"), "token").groupBy("doc", "n").agg(F.sort_array(F.collect_list(F.struct("df", "name"))).alias("common"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, sizes, out = b.column("doc"), b.column("n").to_pylist(), []
            for k, (n, x) in enumerate(zip(sizes, b.column("common"))):
                name = x.values.field("name").to_numpy()
                start = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
                weight = np.diff(np.append(start, len(name)))
                rest = np.cumsum(weight[::-1])[::-1]
                if 100 * rest[0] >= percent * n:
                    out.append((k, n, name[start], weight, rest))
            rows = pa.array([k for k, *_ in out], pa.int32())
            yield pa.RecordBatch.from_arrays([docs.take(rows), pa.array([n for _, n, *_ in out], pa.int64()), *(pa.array([r[c] for r in out], pa.list_(pa.int64())) for c in (2, 3, 4))], ["doc", "n", "tokens", "weights", "rests"])

    kind = sets.schema["doc"].dataType.simpleString()
    return common.mapInArrow(run, f"doc {kind}, n bigint, tokens array<bigint>, weights array<bigint>, rests array<bigint>")


def _need(x: Column, y: Column, percent: int) -> Column:
    return F.ceil(percent * (x + y) / (100 + percent) - 1e-9)


def _class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(CLASS) + 1e-9).cast("int")


def _entries(profiles: DataFrame, percent: int) -> DataFrame:
    """key, doc, n, finds, class, at, left, used, most, need: prefix tokens dealt out to lists; ``left`` more follow in the prefix.

    ``finds``: the entry looks for sets no longer than its own, else it is one to be found. ``used`` is the weight of the
    key's tokens, ``most`` bounds the overlap with a document that shares none before, ``need`` is the least that a link in this list asks for.
    """
    n = F.col("n")
    low = F.greatest(F.ceil(percent * n / 100 - 1e-9), F.lit(1))
    finds = profiles.withColumn("class", F.explode(F.sequence(_class(low), _class(n)))).withColumns({"finds": F.lit(True), "need": _need(n, F.greatest(low, F.floor(F.pow(F.lit(CLASS), F.col("class").cast("double"))) - 1), percent)})
    found = profiles.withColumns({"class": _class(n), "finds": F.lit(False), "need": _need(n, n, percent)}).select(finds.columns)
    both = finds.unionByName(found)
    inside = F.slice("tokens", F.lit(1), F.size(F.filter("rests", lambda r: r >= F.col("need"))))
    each = both.select("doc", "n", "class", "finds", "need", "weights", "rests", F.size(inside).alias("_in"), F.posexplode(inside).alias("at", "token"))
    return each.select(F.xxhash64("token", "class").alias("key"), "doc", "n", "finds", "class", "at", (F.col("_in") - F.col("at") - 1).alias("left"), F.get("weights", F.col("at")).alias("used"), F.get("rests", F.col("at")).alias("most"), "need")


def _deeper(long: DataFrame, profiles: DataFrame) -> DataFrame:
    """The lists' entries under keys of one more token."""
    joined = long.select("key", "doc", "finds", "class", "at", "used", "need").join(profiles.select("doc", "n", "tokens", "weights", "rests"), "doc")
    last = F.size(F.filter("rests", lambda r: F.col("used") + r >= F.col("need")))
    each = joined.withColumn("_in", last).where(F.col("_in") > F.col("at") + 1).withColumn("to", F.explode(F.sequence(F.col("at") + 1, F.col("_in") - 1)))
    own = lambda c: F.get(c, F.col("to"))
    return each.select(F.xxhash64("key", own("tokens")).alias("key"), "doc", "n", "finds", "class", F.col("to").alias("at"), (F.col("_in") - F.col("to") - 1).alias("left"), (F.col("used") + own("weights")).alias("used"), (F.col("used") + own("rests")).alias("most"), "need")


def _pairs(x: DataFrame, y: DataFrame, percent: int, also=None) -> DataFrame:
    """(a, b) of a list's entries that the length and positional filters leave: ``x`` finds ``y``."""
    nx, ny = F.col("x.n"), F.col("y.n")
    fits = (F.col("x.key") == F.col("y.key")) & (F.col("x.doc") != F.col("y.doc")) & (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & (F.least("x.most", "y.most") >= _need(nx, ny, percent))
    joined = x.alias("x").join(y.alias("y"), fits if also is None else fits & also)
    return joined.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b"))


def _across(entries: DataFrame, profiles: DataFrame, group: DataFrame, percent: int) -> DataFrame | None:
    """Candidate pairs (a, b) of entries of a list in different components, perhaps repeated; None if there are none."""
    out, level = [], entries
    apart = (F.col("x.component") != F.col("y.component")) & ((F.col("y.n") < F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.doc") < F.col("x.doc"))))
    for depth in range(1, DEPTH + 1):
        placed = level.join(sized(group.withColumnRenamed("node", "doc")), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        if depth > 1:
            placed = materialize(placed, "deeper")
        per = placed.groupBy("key", "component").agg(F.count_if("finds").alias("p"), F.count_if(~F.col("finds")).alias("q"), F.sum("left").alias("left"))
        per = per.groupBy("key").agg(F.sum("left").alias("left"), F.count(F.lit(1)).alias("k"), F.sum("p").alias("p"), F.sum("q").alias("q"), F.max(F.struct((F.col("p") + F.col("q")).alias("c"), "component", "p", "q")).alias("top"))
        others = F.greatest(F.col("p") - F.col("top.p"), F.col("q") - F.col("top.q"))
        # deeper keys pay where an entry has fewer of them than documents to be compared with
        deep = (others > F.greatest(F.lit(LONG), PAYS * F.col("left") / (F.col("p") + F.col("q")))) if depth < DEPTH else F.lit(False)
        lists = per.where("k > 1 and p > 0 and q > 0").select("key", F.col("top.component").alias("largest"), deep.alias("deep"))
        lists = materialize(lists, "lists")
        if lists.isEmpty():
            break
        mixed = materialize(placed.join(lists, "key"), "mixed")
        short = mixed.where("not deep")
        finds, found = short.where("finds"), short.where("not finds")
        out.append(_pairs(finds.where("component <> largest"), found, percent, apart))
        out.append(_pairs(finds.where("component = largest"), found.where("component <> largest"), percent, apart))
        long = mixed.where("deep")
        if depth == DEPTH or long.isEmpty():
            break
        # enough in common already: if two of them link by these tokens alone, both link with the smallest
        full = long.where("used >= need")
        hubs = full.groupBy("key").agg(F.min(F.struct("n", "doc", "most", "component")).alias("h"), F.count(F.lit(1)).alias("size")).where("size > 1").select("key", "h.*", "size")
        out.append(_pairs(full, hubs, percent, F.col("x.component") != F.col("y.component")))
        level = _deeper(long, profiles)
    return reduce(DataFrame.unionByName, out) if out else None


def _links(docs: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Links (a, b) between class representatives that connect all that are similar; None if there are none."""
    tokens = reps.select("doc", F.explode("probe").alias("token"))
    shared = tokens.groupBy("token").count().where("count > 1")
    hits = tokens.join(materialize(shared.select("token"), "shared"), "token").groupBy("doc").agg(F.count(F.lit(1)).alias("hits"))
    survivors = materialize(reps.select("doc", "least").join(hits, "doc").where("hits >= least").select("doc"), "survivors")
    if survivors.isEmpty():
        return None
    sets = materialize(_sets(docs.join(sized(survivors), "doc", "left_semi"), size), "sets")
    profiles = materialize(_profiles(sets, percent), "profiles")
    entries = materialize(_entries(profiles, percent), "entries")
    hubs = entries.where("not finds").groupBy("key").agg(F.min(F.struct(F.col("n") - F.col("most"), "doc", "n", "most")).alias("h")).select("key", "h.doc", "h.n", "h.most")
    links = materialize(_verified(_pairs(entries.where("finds"), hubs, percent).distinct(), profiles, percent), "links")
    group = materialize(components(links), "components")
    pairs = _across(entries, profiles, group, percent)
    return links if pairs is None else links.unionByName(_verified(pairs.distinct(), profiles, percent))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every row.

    A text of fewer words than ``size`` has one shingle, its whole sequence; null, empty and
    blank texts have none and link to nothing. ``id_col`` is the key: rows that repeat an id
    share its links; a null id stays alone and gets a null component. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    base = materialize(_probes(docs, size, percent), "probes")
    key = ["n", "s1", "s2"]
    filled = base.where("n > 0 and doc is not null")
    classes = materialize(filled.groupBy(*key).agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "classes")
    classes = sized(classes)
    reps = filled.join(classes, key, "left").where("rep is null or rep = doc").select("doc", "least", "probe")
    links = _links(docs, reps, size, percent)
    members = base.select("doc", *key).join(classes, key, "left").withColumn("rep", F.when(F.col("n") > 0, F.coalesce("rep", "doc")).otherwise(F.col("doc")))
    if links is None:
        return members.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("rep").alias("component_id"))
    group = materialize(components(links), "groups")
    return members.join(sized(group.withColumnRenamed("node", "rep")), "rep", "left").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with exactly one row of each component of rows, all columns kept.

    Rows are told apart by a written number: repeats of an id and null ids link by their texts
    like all others. The row kept has the smallest id (null last). Wordless rows link to nothing;
    of those that repeat an id one is left.
    """
    rows, key = row_identity(docs, id_col)
    if key == id_col:  # wordless rows are components of their own, and the least id names each
        gone = near_duplicates(rows, id_col=key, **options).where("doc_id <> component_id").select(F.col("doc_id").alias("gone"))
    else:
        found = near_duplicates(rows, id_col=key, **options).withColumnRenamed("doc_id", key)
        found = materialize(found.join(rows.select(key, F.col(id_col).alias("id")), key), "found")
        wordless = F.col("n_shingles") == 0
        group = [F.when(~wordless, F.col("component_id")), F.when(wordless, F.col("id")), F.when(wordless & F.col("id").isNull(), F.col(key))]
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", key))
        kept = found.groupBy(*(g.alias(f"by{k}") for k, g in enumerate(group))).agg(first[key].alias(key)).select(key)
        gone = found.select(F.col(key).alias("gone")).join(kept, F.col("gone") == F.col(key), "left_anti")
    gone = sized(materialize(gone, "gone"))
    return rows.join(gone, rows[key] == gone["gone"], "left_anti").select(docs.columns)


SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as g from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
e as (select a, b from l union select b, a from l),
r(a, b) as (select doc_id, doc_id from w union select r.a, e.b from r join e on r.b = e.a)
select w.doc_id, coalesce(n, 0) as n_shingles, m as component_id from w left join n using (doc_id) join (select a as doc_id, min(b) as m from r group by a) using (doc_id)
"""
