"""Language of a text by byte trigrams, learned from labelled texts.

A model is one log-probability per trigram bucket and language. Learning sums one bounded table over all
labelled rows, combined in each task first; scoring adds up table rows. Both go through an Arrow batch in pieces of
``PIECE`` bytes, also within a text, so the working memory beyond the batch itself doesn't grow with it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime below 2^16: the buckets of the trigrams' 24-bit values.
BUCKETS = 65_521
SMOOTH = 0.5
#: Bytes of text whose trigrams are held at once, some 50 bytes for each.
PIECE = 1 << 19
#: Rows of an Arrow batch whose texts are Python strings at once.
ROWS = 256
#: Neighbouring trigrams share bytes, so a text's evidence is divided by so many.
OVERLAP = 3.0
#: Below this probability of the best language a text's language is unknown.
CONFIDENCE = 0.9


def _trigrams(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(piece's number, bucket) of every byte trigram of each piece."""
    size = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32)
    row = np.repeat(np.arange(len(raw), dtype=np.int32), size)
    if len(data) < 3:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    inside = row[2:] == row[:-2]
    return row[2:][inside], ((data[:-2] << 16) + (data[1:-1] << 8) + data[2:])[inside] % BUCKETS


def _pieces(texts: Iterable[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Groups of at most some ``PIECE`` bytes: (numbers of the texts, their bytes between two spaces). A longer text is cut
    into pieces that share two bytes, so that each of its trigrams is in one of them."""
    at, raw, held = [], [], 0
    for k, t in enumerate(texts):
        whole = b" %s " % (t or "").encode("utf-8", "surrogatepass")
        for start in range(0, max(len(whole) - 2, 1), PIECE):
            own = whole[start : start + PIECE + 2]
            if raw and held + len(own) > PIECE:
                yield at, raw
                at, raw, held = [], [], 0
            at.append(k)
            raw.append(own)
            held += len(own)
    if raw:
        yield at, raw


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    weights: np.ndarray  # buckets x languages, float64

    def detect(self, texts: list[str | None]) -> list[tuple[str, float] | None]:
        """The likeliest language and its probability; None for texts without letters and without known languages."""
        if not self.names:
            return [None] * len(texts)
        total = np.zeros((len(texts), len(self.names)))
        for at, raw in _pieces(texts):
            row, bucket = _trigrams(raw)
            for k in range(len(self.names)):
                np.add.at(total[:, k], at, np.bincount(row, self.weights[bucket, k], len(raw)))
        total /= OVERLAP
        total -= total.max(axis=1, keepdims=True)
        best, share = total.argmax(axis=1), 1 / np.exp(total).sum(axis=1)
        return [(self.names[b], float(p)) if t and any(map(str.isalpha, t)) else None for t, b, p in zip(texts, best, share)]

    def of(self, text: Column, confidence: float = CONFIDENCE) -> Column:
        """The language of a text, in any case; null below ``confidence`` and for texts without letters."""
        return F.element_at(self.of_all(F.array(text), confidence), 1)

    def of_all(self, texts: Column, confidence: float = CONFIDENCE) -> Column:
        """The language of each text of an array."""
        model = self

        @F.arrow_udf("array<string>")
        def run(lists: pa.Array) -> pa.Array:
            out = []
            for start in range(0, len(lists), ROWS):
                part = lists.slice(start, ROWS).to_pylist()
                found = iter(model.detect([t for x in part if x is not None for t in x]))
                for x in part:
                    own = None if x is None else [next(found) for _ in x]
                    out.append(None if x is None else [f[0] if f and f[1] >= confidence else None for f in own])
            return pa.array(out, pa.list_(pa.string()))

        return run(F.transform(texts, F.lower))


def learn(labelled: DataFrame, text: str = "text", language: str = "lang") -> Languages:
    """A model of the languages of ``labelled``; rows without a text or a language teach nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            names = b.column("l").to_pylist()
            for at, raw in _pieces(t.as_py() for t in b.column("t")):
                row, bucket = _trigrams(raw)
                own = np.array([names[k] for k in at], dtype=object)
                for name in set(own):
                    have = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                    have += np.bincount(bucket[(own == name)[row]], minlength=BUCKETS)
        for name, have in counts.items():
            at = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(have[at])], ["l", "bucket", "n"])

    rows = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(F.lower(text).alias("t"), F.col(language).cast("string").alias("l"))
    found = rows.mapInArrow(run, "l string, bucket bigint, n bigint").groupBy("l", "bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS a language
    names = tuple(sorted(found["l"].unique()))
    counts = np.zeros((BUCKETS, len(names)))
    for k, name in enumerate(names):
        own = found[found["l"] == name]
        counts[own["bucket"].to_numpy(), k] = own["n"].to_numpy()
    return Languages(names, np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * BUCKETS)))
