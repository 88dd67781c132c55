"""Byte-level BPE encoding and decoding.

A short word is merged over a contiguous rank array: its part boundaries lie in one list and
the rank of each adjacent pair in another; the smallest rank is found by scanning, the
boundary between its two parts is deleted, and the ranks of the two neighbours are refreshed.
Words longer than ``SHORT`` bytes would make that scan quadratic; they take a heap over the
same ranks with the same result.

Both directions are one ``mapInArrow`` pass without a shuffle. Each Python worker keeps a
bounded cache of encoded chunks, so memory does not follow the vocabulary of the corpus.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices

SHORT = 256
#: Entries of each cache of a worker, and the longest text that enters one.
CACHE, CHUNK = 300_000, 64
NONE = 1 << 60
#: The public byte-level pre-token pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""


def byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the rest take 256 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.tokens: dict[int, bytes] = {i: raw(t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.byte_id = [0] * 256
        for t, i in vocab.items():
            if len(t) == 1:
                self.byte_id[letters[t]] = i
        #: (left id, right id) -> rank, and -> merged id
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = rank
            self.merged[vocab[a], vocab[b]] = vocab[a + b]
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        #: Two adjacent white-space characters; without them each space before a word starts a chunk.
        self.double = re.compile(r"\s\s")
        #: Ids as bytes of whole chunks, and of the words of chunks that have several.
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        size = max(self.tokens) + 1
        self.piece_len = np.zeros(size, np.int64)
        for i, t in self.tokens.items():
            self.piece_len[i] = len(t)
        self.piece_at = np.concatenate([[0], np.cumsum(self.piece_len)])[:-1]
        self.pieces = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), np.uint8)

    def word(self, data: bytes) -> list[int]:
        """Token ids of one pre-token."""
        ids = [*map(self.byte_id.__getitem__, data)]
        if len(ids) > SHORT:
            return self._long(ids)
        rank, merged = self.rank.get, self.merged
        ranks = [*map(rank, zip(ids, ids[1:]), repeat(NONE))]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            k = ranks.index(least)
            ids[k] = merged[ids[k], ids.pop(k + 1)]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank((ids[k], ids[k + 1]), NONE)
            if k:
                ranks[k - 1] = rank((ids[k - 1], ids[k]), NONE)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        n, rank = len(ids), self.rank
        after, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        heap = [(rank[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = self.merged[a, b], False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and (y := after[x]) >= 0 and (p := (ids[x], ids[y])) in rank:
                    heapq.heappush(heap, (rank[p], x, *p))
        return [t for t, ok in zip(ids, alive) if ok]

    def _encoded(self, word: str) -> bytes:
        return array("i", self.word(word.encode("utf-8", "replace"))).tobytes()

    def chunk(self, text: str) -> bytes:
        """Ids of ordinary text as int32 bytes, through the caches when the text is short."""
        if (found := self.cache.get(text)) is not None:
            return found
        parts = self.pattern.findall(text)
        if len(text) > CHUNK:
            return b"".join(map(self._encoded, parts))
        if len(parts) == 1:
            out = self._encoded(text)
        else:
            known = self.words
            for w in parts:
                if w not in known:
                    if len(known) >= CACHE:
                        known.clear()
                    known[w] = self._encoded(w)
            out = b"".join([known.get(w) or self._encoded(w) for w in parts])
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[text] = out
        return out

    def _plain(self, text: str) -> list[bytes]:
        if self.double.search(text):
            get, pattern = self.chunk, self.pattern
            return [get(w) for w in pattern.findall(text)]
        get, miss = self.cache.get, self.chunk
        head, *rest = text.split(" ")
        out = [miss(head)] if head else []
        for w in rest:
            w = " " + w
            out.append(get(w) or miss(w))
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian int32 bytes; special tokens in the text take their ids."""
        text = text or ""
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(self._plain(text))
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(np.int32(self.special[m[0]]).tobytes())
            at = m.end()
        return b"".join(out + self._plain(text[at:]))

    def decode(self, ids: np.ndarray) -> str:
        """Text of token ids: their bytes joined; what isn't UTF-8 becomes U+FFFD. Unknown ids are an error."""
        if not len(ids):
            return ""
        length = self.piece_len[ids]
        end = np.cumsum(length)
        at = np.repeat(self.piece_at[ids] - (end - length), length) + np.arange(end[-1])
        return self.pieces[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _loaded(name: str) -> ByteBpe:
    with open(SparkFiles.get(name), encoding="utf-8") as f:
        return ByteBpe(f.read())


def _ship(docs: DataFrame, path: str) -> str:
    """Send the vocabulary file (a few MB, whatever the corpus) to the executors once."""
    docs.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id and ids (array<int>) of each row; with ``decoded`` also the text decoded from those ids.

    Null counts as empty and has no ids. Repeated rows give repeated results, an empty table
    an empty one, and other columns are ignored. ``vocab_path`` is readable by the driver.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    name = _ship(docs, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(name)
        for batch in batches:
            for b in slices(batch):
                found = [bpe.encode(t.as_py()) for t in b.column(1)]
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
                flat = np.frombuffer(b"".join(found), np.int32)
                cols = [b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if decoded:
                    cols.append(pa.array([bpe.decode(flat[s:e]) for s, e in zip(ends, ends[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "ids", "decoded"][: len(cols)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(tokens: DataFrame, vocab_path: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids decode to the empty text."""
    name = _ship(tokens, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(name)
        for b in batches:
            text = [bpe.decode(np.asarray(x.values.to_numpy(zero_copy_only=False) if x.is_valid else [], np.int32)) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
