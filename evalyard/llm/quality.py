"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins and a few pairs of features have tables over
both; a document's log odds are the sum of its table entries. The tables are learned by
cyclic boosting: round after round, every feature in turn adds a shallow tree fitted to the
gradient in its bins, then the pairs with the strongest remaining signal do the same on two
features. Training sees at most ``SAMPLE`` labelled rows, chosen by hash, whatever the size of the corpus.

Features are taken from whole texts where they are scanned: once for the sample's rows, and once,
with the scores, for all rows. Nothing is shuffled but the sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import sized, slices, words

#: Most labelled rows that training reads: those with the smallest hash of their id.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 48, 8, 6
ROUNDS, RATE = 240, 0.15
FEATURES = ("log_bytes", "upper", "marks", "exclaim", "pipe", "digit", "blank", "stop", "high", "line", "word_bytes", "distinct", "repeat", "top_word", "shape_change")

_CLASS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "marks": b"#$%&*+/<=>@[\\]^_`{}~",
    "exclaim": b"!?",
    "pipe": b"|",
    "digit": b"0123456789",
    "blank": b" \t\r\x0b\x0c",
    "stop": b".,;:",
    "high": bytes(range(128, 256)),
    "line": b"\n",
}


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text; null counts as empty, whose features are all zero."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    n = len(texts)
    size = pc.binary_length(texts).to_numpy().astype(np.int64)
    data = b"".join(t.encode("utf-8", "surrogatepass") for t in texts.to_pylist())
    raw = np.frombuffer(data, np.uint8)
    row = np.repeat(np.arange(n), size)
    some = np.maximum(size, 1)
    group = np.zeros(256, np.int64)
    for k, chars in enumerate(_CLASS.values(), 1):
        group[list(chars)] = k
    kinds = len(_CLASS) + 1
    table = np.bincount(row * kinds + group[raw], minlength=n * kinds).reshape(n, kinds)
    out = {"log_bytes": np.log1p(size)} | {name: table[:, k] / some for k, name in enumerate(_CLASS, 1)}
    wrow, code, dictionary = words(texts)
    count = np.bincount(wrow, minlength=n)
    per = np.maximum(count, 1)
    lengths = pc.binary_length(dictionary).to_numpy() if len(dictionary) else np.zeros(0, np.int64)
    out["word_bytes"] = np.bincount(wrow, lengths[code], n) / per if len(code) else np.zeros(n)
    pair, times = np.unique(wrow * max(1, len(dictionary)) + code, return_counts=True)
    prow = pair // max(1, len(dictionary))
    out["distinct"] = np.bincount(prow, minlength=n) / per
    same = (code[1:] == code[:-1]) & (wrow[1:] == wrow[:-1])
    out["repeat"] = np.bincount(wrow[1:][same], minlength=n) / per
    top = np.zeros(n)
    np.maximum.at(top, prow, times)
    out["top_word"] = top / per
    # how often letters, marks, digits and blanks take turns
    turn = (group[raw][1:] != group[raw][:-1]) & (row[1:] == row[:-1]) if len(raw) > 1 else np.zeros(0, bool)
    out["shape_change"] = np.bincount(row[1:][turn], minlength=n) / some
    return np.stack([out[f] for f in FEATURES], axis=1).astype(float)


def _mapped(docs: DataFrame, text: str, keep: list[str], column: T.StructField, made: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """The columns ``keep`` of every row and one made from its text, slice by slice in the scan's own tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, text):
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), made(b.column(text))], [*keep, column.name])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in keep), column]))


def _lists(x: np.ndarray) -> pa.Array:
    ends = pa.array((np.arange(len(x) + 1) * x.shape[1]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(x.ravel()))


@dataclass
class Additive:
    """Bin edges per feature, one table per feature, tables per pair, and the intercept."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    intercept: float = 0.0
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, k], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"), np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2, least: float = 5.0) -> np.ndarray:
    """Leaf value of each bin for the shallow tree that best splits summed gradients and hessians."""
    out = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if not depth or len(g) < 2:
        return out
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl > least * 0.05) & (hr > least * 0.05), gl**2 / (hl + 1) + gr**2 / (hr + 1), -1)
    at = int(gain.argmax())
    if gain[at] <= g.sum() ** 2 / (h.sum() + 1):
        return out
    return np.concatenate([_tree(g[: at + 1], h[: at + 1], depth - 1, least), _tree(g[at + 1 :], h[at + 1 :], depth - 1, least)])


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of the best two cuts, one on each axis, over two-dimensional sums."""
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts_g = [cg[:-1, :-1], cg[-1:, :-1] - cg[:-1, :-1], cg[:-1, -1:] - cg[:-1, :-1]]
    parts_h = [ch[:-1, :-1], ch[-1:, :-1] - ch[:-1, :-1], ch[:-1, -1:] - ch[:-1, :-1]]
    parts_g.append(cg[-1, -1] - sum(parts_g))
    parts_h.append(ch[-1, -1] - sum(parts_h))
    gain = sum(a**2 / (b + 1) for a, b in zip(parts_g, parts_h)) - cg[-1, -1] ** 2 / (ch[-1, -1] + 1)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    leaf = [float(a[i, j] / (b[i, j] + 1)) for a, b in zip(parts_g, parts_h)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[i + 1 :, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, j + 1 :] = leaf
    return float(gain[i, j]), out


def train(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fit to rows of features and labels 0 or 1; without rows every score is 0.5."""
    if not len(y):
        return Additive([np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES))
    n, k = x.shape
    edges = [_edges(x[:, j], BINS) for j in range(k)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    prior = (y.sum() + 0.5) / (n + 1)
    intercept = float(np.log(prior / (1 - prior)))
    total = np.full(n, intercept)

    def sides():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(k):
            g, h = sides()
            step = RATE * _tree(np.bincount(bins[j], g, len(tables[j])), np.bincount(bins[j], h, len(tables[j])))
            tables[j] += step
            total += step[bins[j]]
    pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]

    def sums(a, b, v):
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        return np.bincount(coarse[a] * shape[1] + coarse[b], v, shape[0] * shape[1]).reshape(shape)

    g, h = sides()
    ranked = sorted(combinations(range(k), 2), key=lambda p: (-_quadrants(sums(*p, g), sums(*p, h))[0], p))[:PAIRS]
    pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in ranked]
    for _ in range(ROUNDS // 4):
        for t, (a, b) in enumerate(ranked):
            g, h = sides()
            step = RATE * _quadrants(sums(a, b, g), sums(a, b, h))[1]
            pair_tables[t] += step
            total += step[coarse[a], coarse[b]]
    return Additive(edges, tables, intercept, ranked, pair_edges, pair_tables)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels training never sees."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """Train on at most ``sample`` labelled rows that aren't held out. Null ids or labels are passed over.

    Only the texts of those rows are turned into features; their ids go to the scan.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    # a hash threshold first: each task then sends its part of the sample, not a whole one
    share = min(1.0, 1.2 * sample / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    chosen = docs.select("doc_id", "text").join(sized(known), "doc_id")
    table = _mapped(chosen, "text", ["doc_id", "quality"], T.StructField("x", T.ArrayType(T.DoubleType())), lambda t: _lists(features(t)))
    rows = table.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id", "x", "quality").limit(sample).select("x", "quality").collect()
    return train(np.array([r.x for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r.quality for r in rows], float))


def score(docs: DataFrame, text: str, model: Additive, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``score`` (0 to 1) of every row, by bin lookups and additions."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return _mapped(docs, text, keep, T.StructField("score", T.DoubleType()), lambda t: pa.array(shared.value.score(features(t))))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; other columns are ignored.

    Null and empty texts score like any other; a null id is never held out; repeated rows repeat;
    without labels every score is 0.5; an empty table gives an empty result.
    """
    scored = score(docs.select("doc_id", "text"), "text", fit(docs, labels, sample), ["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, all columns kept, whatever their names; one pass, no shuffle.

    Each row is judged by its text, so repeats of a text share their fate; ties at 0.5 stay.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    scored = score(docs.toDF(*names), names[docs.columns.index("text")], fit(docs, labels), names)
    return scored.where("score >= 0.5").select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
