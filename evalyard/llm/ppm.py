"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes. A symbol seen in its longest
context costs its share there; otherwise an escape (method C: as many escapes as distinct
symbols) leads to the next shorter context, where the symbols of the longer one are excluded,
down to a uniform choice among the bytes that are left. A text starts after ``ORDER`` start
bytes and ends with an end byte; neither occurs in UTF-8, so the probabilities of all texts
sum to at most one.

Pretrained scoring (``score_corpus``) keeps the trie as a table of (order, context and symbol,
count) over the whole training corpus, aggregated with map-side combining. The cost of a
context and symbol doesn't depend on the document, so it is computed once for each distinct
one, by joins between the orders. Documents then look costs up: entries that hold over
1/HEAD of all positions are at most HEAD many and travel by broadcast; the rest goes through
one shuffle join. Words of the unigram base are handled the same way. Nothing is capped or
pruned; what is gathered grows with the corpus and stays in tables.

Adaptive scoring (``score_adaptive``) starts each document with an empty trie and learns from
what it has read of it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._text import mix64, slices, words

ORDER = 4
START, END = 0xFE, 0xFF
#: Most entries of a broadcast head, and the longest word in it.
HEAD_GRAMS, HEAD_WORDS, HEAD_WORD_BYTES = 1 << 23, 1 << 20, 64
#: Distinct entries that a task gathers before it passes them on, and bytes of text that it works on at once.
FLUSH, PIECE = 3 << 19, 1 << 19


def grams(texts: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(row, context and symbol packed into an integer) of every position of every text, the end included."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    n = len(texts)
    size = pc.binary_length(texts).to_numpy().astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = int(texts.offset and texts.buffers()[1] and np.frombuffer(texts.buffers()[1], np.int32)[texts.offset])
    whole = np.full(int(size.sum()) + n * (order + 1), START, np.uint8)
    row = np.repeat(np.arange(n, dtype=np.int32), size + 1)
    at = np.arange(len(row), dtype=np.int32) + (row + 1) * np.int32(order)  # where each symbol lies once the start bytes are in
    ends = np.cumsum(size + 1) - 1
    whole[at[ends]] = END
    inner = np.ones(len(row), bool)
    inner[ends] = False
    whole[at[inner]] = data[first : first + int(size.sum())]
    packed = np.zeros(len(whole) - order, np.int64)
    for j in range(order + 1):
        packed <<= 8
        packed |= whole[j : len(whole) - order + j]
    return row, packed[at - order]


class Lookup:
    """Vectorised hash table from distinct 64-bit keys to their positions, in levels without probing."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.int64)
        self.levels: list[np.ndarray] = []
        left = np.arange(len(keys), dtype=np.int32)
        while len(left):  # about a fifth of a level's keys go on to the next, smaller one
            slot = np.full(1 << max(4, int(np.ceil(np.log2(len(left) * 2)))), -1, np.int32)
            h = self._slots(self.keys[left], len(self.levels), len(slot))
            slot[h] = left  # the last of equal slots stays
            self.levels.append(slot)
            left = left[slot[h] != left]

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys.view(np.uint64) + np.uint64(level * 0x9E3779B9)) & np.uint64(size - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 for those that aren't there."""
        keys = np.ascontiguousarray(keys, np.int64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, slot in enumerate(self.levels):
            got = slot[self._slots(keys[todo], level, len(slot))].astype(np.int64)
            hit = got >= 0
            hit[hit] = self.keys[got[hit]] == keys[todo[hit]]
            out[todo[hit]] = got[hit]
            todo = todo[~hit]
            if not len(todo):
                break
        return out


_LOOKUPS: dict[str, tuple[Lookup, Lookup]] = {}


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = np.concatenate([p[0] for p in parts])
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], *(np.add.reduceat(np.concatenate([p[i] for p in parts])[order], first) for i in (1, 2))


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, n (training positions), other (held-out positions) over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in batches:
            for b in slices(batch, limit=PIECE):
                held = b.column("held_out").to_numpy(zero_copy_only=False)
                for side in (False, True):
                    own = b.column("text").filter(pa.array(held == side))
                    if len(own):
                        key, count = np.unique(grams(own, order)[1], return_counts=True)
                        zero = np.zeros(len(key), np.int64)
                        parts.append((key, zero, count) if side else (key, count, zero))
                        waiting += len(key)
                if waiting > FLUSH:
                    parts = [_summed(parts)]
                    waiting = len(parts[0][0])
                    if waiting > FLUSH // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], ["gram", "n", "other"])
                        parts, waiting = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(parts)], ["gram", "n", "other"])

    counted = docs.select("held_out", "text").mapInArrow(run, "gram bigint, n bigint, other bigint")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("other").alias("other"))


def count_words(docs: DataFrame) -> DataFrame:
    """word, n over the training documents; the empty word stands for the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in batches:
            for b in slices(batch, limit=PIECE):
                _, code, dictionary = words(b.column("text"))
                count = np.bincount(code, minlength=len(dictionary))
                used = count > 0
                parts.append(pa.table({"word": pa.concat_arrays([dictionary.filter(pa.array(used)).cast(pa.string()), pa.array([""])]), "n": np.append(count[used], len(b))}))
                waiting += len(parts[-1])
                if waiting > FLUSH // 4:
                    yield from (merged := _by_word(parts)).to_batches()
                    parts, waiting = [], 0
        if parts:
            yield from _by_word(parts).to_batches()

    return docs.where("not held_out").select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _by_word(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def costs(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, uses and cost (log10 probability of the symbol after its context) for every counted gram."""
    # the trie: each order's context and symbol with its training count
    levels = F.explode(F.sequence(F.lit(0), F.lit(order)))
    keep = "gram & if(level >= 7, -1L, shiftleft(1L, 8 * (level + 1)) - 1)"
    trie = counted.where("n > 0").select("gram", "n", levels.alias("level")).groupBy("level", F.expr(keep).alias("gram")).agg(F.sum("n").alias("n"))
    trie = materialize(trie, "trie")
    shorter = trie.select((F.col("level") + 1).alias("level"), F.col("gram").alias("tail"), F.col("n").alias("below"))
    tail = F.expr("gram & (shiftleft(1L, 8 * level) - 1)").alias("tail")
    # a context's total and distinct symbols, and what its symbols count for one order below
    contexts = (
        trie.select("level", "gram", "n", tail)
        .join(shorter, ["level", "tail"], "left")
        .groupBy("level", F.shiftright("gram", 8).alias("context"))
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum(F.coalesce("below", F.lit(0))).alias("excluded"))
    )
    contexts = materialize(contexts, "contexts")

    top = contexts.where(F.col("level") == order).select("context", "total", "kinds", "excluded")
    rows = counted.withColumn("context", F.shiftright("gram", 8)).join(top, "context", "left")
    uses = F.col("n") + F.col("other")
    seen = rows.where("n > 0").select("gram", uses.alias("uses"), F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("cost"))

    escape = F.when(F.col("total").isNotNull(), F.log10(F.col("kinds") / (F.col("total") + F.col("kinds")))).otherwise(F.lit(0.0))
    state = rows.where("n = 0").select("gram", uses.alias("uses"), escape.alias("cost"), F.lit(False).alias("done"), F.coalesce("kinds", F.lit(0)).alias("gone"), F.coalesce("excluded", F.lit(0)).alias("excluded"))
    for level in range(order - 1, -1, -1):
        low = F.expr(f"gram & {(1 << 8 * (level + 1)) - 1}L")
        here = trie.where(F.col("level") == level).select(F.col("gram").alias("low"), F.col("n").alias("c"))
        about = contexts.where(F.col("level") == level).select(F.col("context").alias("ctx"), "total", "kinds", F.col("excluded").alias("next_excluded"))
        if level < 2:  # at most 256 to the power of 2 rows, and few keys that would gather all of the state
            here, about = F.broadcast(here), F.broadcast(about)
        state = state.withColumn("low", low).join(here, "low", "left").withColumn("ctx", F.shiftright("low", 8)).join(about, "ctx", "left")
        free = F.coalesce("total", F.lit(0)) - F.col("excluded")
        kinds = F.coalesce("kinds", F.lit(0)) - F.col("gone")
        step = F.when(F.col("done"), 0.0).when(F.col("c").isNotNull(), F.log10(F.col("c") / (free + kinds))).when(kinds > 0, F.log10(kinds / (free + kinds))).otherwise(0.0)
        state = state.select(
            "gram",
            "uses",
            (F.col("cost") + step).alias("cost"),
            (F.col("done") | F.col("c").isNotNull()).alias("done"),
            F.coalesce("kinds", F.col("gone")).alias("gone"),
            F.coalesce("next_excluded", F.lit(0)).alias("excluded"),
        )
    novel = state.select("gram", "uses", F.when(F.col("done"), F.col("cost")).otherwise(F.col("cost") - F.log10(256 - F.col("gone"))).alias("cost"))
    return seen.unionByName(novel)


def _head(table: DataFrame, size: str, most: int, columns: list[str], total: int) -> pa.Table:
    """Rows that hold over 1/most of ``total``: fewer than ``most`` of them, whatever the corpus."""
    return table.where(F.col(size) * most > total).select(*columns).toArrow()


def _look_up(docs: DataFrame, head_grams: pa.Table, head_words: pa.Table, unit: float, unknown: float, order: int) -> DataFrame:
    """One row per document with its sums over the heads, and what is left for the joins."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((head_grams["gram"].to_numpy(), head_grams["cost"].to_numpy(), head_words["word"].combine_chunks() if len(head_words) else pa.array([], pa.string()), head_words["n"].to_numpy()))
    kind = docs.schema["doc_id"].dataType.simpleString()
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram_keys, gram_costs, known, known_n = shared.value
        hashes = lambda a: np.fromiter((xxhash.xxh64_intdigest(w) for w in a.to_pylist()), np.uint64, len(a)).view(np.int64)
        if name not in _LOOKUPS:  # built once a worker; another head's lookups go
            _LOOKUPS.clear()
            _LOOKUPS[name] = Lookup(gram_keys), Lookup(hashes(known))
        gram_at, word_at = _LOOKUPS[name]
        known_cost = np.log10(known_n + 0.1) - unit
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for b in slices(batch, limit=PIECE):
                n, text = len(b), b.column("text")
                row, code, dictionary = words(text)
                found = word_at.find(hashes(dictionary))
                if len(known) and len(dictionary):  # a hash only points; the words decide
                    same = pc.equal(dictionary.cast(pa.string()), known.take(pa.array(np.maximum(found, 0)))).to_numpy(zero_copy_only=False)
                    found = np.where(same, found, -1)
                at = found[code]
                hit = at >= 0
                base = np.bincount(row[hit], known_cost[at[hit]], n).astype(float)
                n_known = np.bincount(row[hit], minlength=n)
                pair, times = np.unique(row[~hit] * max(1, len(dictionary)) + code[~hit], return_counts=True)
                word_row = pair // max(1, len(dictionary))
                tail_words = dictionary.cast(pa.string()).take(pa.array(pair % max(1, len(dictionary))))

                grow, gram = grams(text, order)
                at = gram_at.find(gram)
                hit = at >= 0
                score = np.bincount(grow[hit], gram_costs[at[hit]], n).astype(float)
                grow, gram = grow[~hit], gram[~hit]
                by = np.lexsort((gram, grow))
                grow, gram = grow[by], gram[by]
                first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (grow[1:] != grow[:-1])])) if len(gram) else np.zeros(0, np.int64)
                gram_times = np.diff(np.append(first, len(gram)))
                ends = lambda r: pa.array(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=n))]).astype(np.int32))
                lists = [(word_row, tail_words), (word_row, pa.array(times)), (grow[first], pa.array(gram[first])), (grow[first], pa.array(gram_times))]
                cols = [pa.array(rid + np.arange(n)), b.column("doc_id"), b.column("held_out"), pa.array(np.bincount(row, minlength=n) + 1), pa.array(n_known), pa.array(base), pa.array(score)]
                cols += [pa.ListArray.from_arrays(ends(r), v) for r, v in lists]
                rid += n
                yield pa.RecordBatch.from_arrays(cols, ["rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "words", "word_times", "grams", "gram_times"])

    schema = f"rid bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, words array<string>, word_times array<bigint>, grams array<bigint>, gram_times array<bigint>"
    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def score_corpus(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Score every row with models trained on the rows for which ``held_out`` (a Column) is false.

    Gives doc_id, held_out, n_tokens, n_known, train_tokens, base_score (word unigram, add 0.1)
    and score (byte model), both log10 probabilities. Null counts as the empty text, whose one
    token is its end; ``order`` is 1 to 7; a null ``held_out`` counts as false. Repeated rows are counted and scored
    each; with no training rows every word is unknown and the byte model is uniform.
    """
    if not 1 <= order <= 7:
        raise ValueError("a context and its symbol are 8 bytes at most")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    vocabulary = materialize(count_words(docs), "words")
    n, v = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    unit = math.log10(n + 0.1 * (v + 1))
    counted = materialize(count_grams(docs, order), "grams")
    priced = materialize(costs(counted, order), "costs")
    positions = priced.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]

    head_grams = _head(priced, "uses", HEAD_GRAMS, ["gram", "cost"], positions)
    short = vocabulary.where(F.octet_length("word") <= HEAD_WORD_BYTES)
    head_words = _head(short, "n", HEAD_WORDS, ["word", "n"], n)
    looked = materialize(_look_up(docs, head_grams, head_words, unit, math.log10(0.1) - unit, order), "looked")

    tail = looked.select("rid", F.explode(F.arrays_zip("words", "word_times")).alias("x")).select("rid", F.col("x.words").alias("word"), F.col("x.word_times").alias("times"))
    by_word = tail.join(vocabulary, "word", "left").groupBy("rid").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 0.1) - unit)).alias("more_base"),
    )
    tail = looked.select("rid", F.explode(F.arrays_zip("grams", "gram_times")).alias("x")).select("rid", F.col("x.grams").alias("gram"), F.col("x.gram_times").alias("times"))
    by_gram = tail.join(priced.select("gram", "cost"), "gram").groupBy("rid").agg(F.sum(F.col("times") * F.col("cost")).alias("more_score"))
    ends = vocabulary.where("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = looked.drop("words", "word_times", "grams", "gram_times").join(by_word, "rid", "left").join(by_gram, "rid", "left")
    zero = F.lit(0)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero) + (1 if ends else 0)).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + (math.log10(ends + 0.1) - unit)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


class Trie:
    """Byte contexts of one text stream; ``update`` learns a symbol, ``cost`` prices it."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.counts: dict[bytes, dict[int, int]] = {}

    def cost(self, context: bytes, symbol: int) -> float:
        gone: set[int] = set()
        total = 0.0
        for k in range(self.order, -1, -1):
            seen = self.counts.get(context[len(context) - k :] if k else b"")
            if not seen:
                continue
            free = {s: c for s, c in seen.items() if s not in gone}
            if not free:
                continue
            n = sum(free.values()) + len(free)
            if symbol in free:
                return total + math.log10(free[symbol] / n)
            total += math.log10(len(free) / n)
            gone |= set(free)
        return total - math.log10(256 - len(gone))

    def update(self, context: bytes, symbol: int) -> None:
        for k in range(self.order + 1):
            seen = self.counts.setdefault(context[len(context) - k :] if k else b"", {})
            seen[symbol] = seen.get(symbol, 0) + 1


def code_length(text: str | None, order: int = ORDER, trie: Trie | None = None, learn: bool = True) -> float:
    """log10 probability of a text, learning from it on the way if ``learn``."""
    trie = trie or Trie(order)
    data = bytes([START] * order) + (text or "").encode("utf-8", "surrogatepass") + bytes([END])
    total = 0.0
    for i in range(order, len(data)):
        context = data[i - order : i]
        total += trie.cost(context, data[i])
        if learn:
            trie.update(context, data[i])
    return total


def score_adaptive(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id and score of each row under a trie that starts empty and learns as it reads; null counts as empty."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([code_length(t.as_py(), order) for t in b.column(1)], pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, score double")
