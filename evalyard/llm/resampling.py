r"""Target-distribution importance resampling over hashed word and word-pair features.

Documents that look like the target texts get high weights, and a draw without replacement (noise
of a Gumbel distribution added to log weights) takes a share of the corpus.

1. Identical texts collapse: rows are grouped by their full text, combined in each task first, so
   a text that a third of all rows share moves once a task. Its features are made once.
2. Bucket counts of the corpus are those of distinct texts times their multiplicity, summed in each
   task to one vector; the gains are one bounded vector of ``buckets`` numbers.
3. A text's weight is the floored mean of its features' gains, made once for each distinct text.
4. Weights join back to the documents by the text's SHA-256; texts with over 1/``HOT`` of all rows
   are fewer than ``HOT`` and are broadcast. Only then each document's own noise is added.
5. Ranks are numbered over written ranges; no task sees all rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rows import row_numbers
from ..session import materialize
from ._text import ALNUM_WORDS, join_counted, slices

BUCKETS, ORDER, SEED = 10_000, 2, "7"
MIN_WORDS, PERCENT = 20, 25
#: Bytes of a text whose words are lists at one time.
PIECE = 1 << 20


def features(text: str | None, buckets: int = BUCKETS, order: int = ORDER) -> tuple[int, np.ndarray]:
    """(words, bucket of every run of 1 to ``order`` consecutive words); a long text goes piece by piece."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(ALNUM_WORDS)
    out, n_words, at = [], 0, 0
    before: list[bytes] = []  # the last words of the piece before
    while at < len(raw):
        stop = len(raw) if len(raw) - at <= PIECE else raw.find(b" ", at + PIECE)
        stop = len(raw) if stop < 0 else stop
        own = raw[at:stop].split()
        at, n_words = stop, n_words + len(own)
        words = before + own
        state = list(map(zlib.crc32, words))
        out.append(np.array(state[len(before) :], np.int64))
        for k in range(1, order):  # state: checksums of the runs of k words
            spaced = list(map(zlib.crc32, repeat(b" "), state))
            state = list(map(zlib.crc32, words[k:], spaced))
            out.append(np.array(state[max(0, len(before) - k) :], np.int64))
        before = words[len(words) - order + 1 :] if order > 1 and len(words) >= order else words[: order - 1]
    return n_words, np.concatenate(out) % buckets if out else np.empty(0, np.int64)


def _featured(texts: DataFrame, buckets: int, order: int) -> DataFrame:
    """digest, copies, n_words, n_features and the features' buckets of distinct texts."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                found = [features(t.as_py(), buckets, order) for t in b.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [b.column("digest"), b.column("copies"), pa.array([n for n, _ in found], pa.int64()), pa.array([len(x) for _, x in found], pa.int64()), pa.array([x.astype(kind).tobytes() for _, x in found], pa.binary())],
                    ["digest", "copies", "n_words", "n_features", "features"],
                )

    return texts.mapInArrow(run, "digest string, copies bigint, n_words bigint, n_features bigint, features binary")


def _collapsed(docs: DataFrame, text: str) -> DataFrame:
    """Distinct texts with their multiplicity; null counts as the empty text."""
    return docs.select(F.coalesce(text, F.lit("")).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select("text", "copies", F.sha2("text", 256).alias("digest"))


def bucket_counts(featured: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, multiplicity included: one vector from each task, summed by Spark."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x, copies in zip(b.column("features"), b.column("copies").to_pylist()):
                total += copies * np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in featured.select("copies", "features").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of each bucket, shares smoothed by one."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weighted(featured: DataFrame, gain: np.ndarray) -> DataFrame:
    kind = np.dtype("<u2") if len(gain) <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = [int(gain[np.frombuffer(x.as_buffer(), kind)].sum()) for x in b.column("features")]
            means = [s // n if n else 0 for s, n in zip(sums, b.column("n_features").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("digest", "copies", "n_words", "n_features")] + [pa.array(means, pa.int64())], ["digest", "copies", "n_words", "n_features", "weight"])

    return featured.mapInArrow(run, "digest string, copies bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """floor(1000 x a Gumbel draw) fixed by the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS, order: int = ORDER, seed: str = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null where not drawn) of every row of ``docs``.

    Null and wordless texts have no features and weight 0; they aren't drawn, as they have fewer words than
    ``min_words``. Rows that repeat an id count and are drawn one by one, with the same noise; of rows that tie in
    score and id the smaller weight, then the fewer features, rank first. A null id has no noise: its score and rank
    are null and it doesn't count in the draw. Without target texts all gains follow the corpus alone. An empty
    table gives an empty result. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    featured = materialize(_featured(_collapsed(docs, "text"), buckets, order), "features", compression="zstd")
    aim = _featured(_collapsed(target.select(F.col(target_text).alias("text")), "text"), buckets, order)
    gain = gains(bucket_counts(featured, buckets), bucket_counts(aim, buckets))
    weights = materialize(_weighted(featured, gain), "weights")
    ids = materialize(docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")), "digests")
    scored = join_counted(ids, weights, "digest", "copies").withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(scored.select("doc_id", "n_words", "n_features", "weight", "score"), "scored")
    fit = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    pool = scored.where(fit)
    drawn = percent * pool.count() // 100
    ranked = row_numbers(pool, [F.desc("score"), F.asc("doc_id"), F.asc("weight"), F.asc("n_features")], "nth")
    rank = F.when(F.col("nth") < drawn, F.col("nth") + 1)
    out = ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
    return out.unionByName(scored.where(~fit).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; rows that repeat an id are drawn together if one of them is."""
    ids = resample(docs, target, id_col=id_col, **options).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, docs[id_col] == ids["_drawn"], "left_semi")


#: The CRC-32 table is built from its polynomial; no other way to compute it in SQL.
SQL = r"""
with tab as materialized (select list(c order by n) as t from (select n, list_reduce(list_prepend(n::bigint, [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: if(c & 1 = 1, xor(3988292384, c >> 1), c >> 1)) as c from (select unnest(range(256)) as n))),
docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
aims as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
df as (select doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from docs),
tf as (select unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from aims),
dn as (select doc_id, f, count(*) as k from df group by all),
names as (select distinct f from (select f from dn union all select f from tf)),
hexed as (select f, hex(encode(f)) as x from names),
hashed as (select f, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, (len(x) / 2)::bigint), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket from hexed, tab),
s as (select bucket, sum(k) as s from dn join hashed using (f) group by bucket),
t as (select bucket, count(*) as t from tf join hashed using (f) group by bucket),
g as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select coalesce(sum(s), 0) from s) + 10000)::double / ((s + 1)::double * ((select coalesce(sum(t), 0) from t) + 10000)::double)))::bigint as gain from s left join t using (bucket)),
sums as (select doc_id, sum(k) as n, sum(k * gain) as total from dn join hashed using (f) join g using (bucket) group by doc_id),
scored as (select doc_id, len(w) as n_words, coalesce(n, 0)::bigint as n_features, coalesce(floor(total::double / n), 0)::bigint as weight,
  coalesce(floor(total::double / n), 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from docs left join sums using (doc_id)),
pool as (select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scored where n_words >= 20)
select scored.doc_id, n_features, weight, score, case when r <= 25 * n // 100 then r end as rank from scored left join pool on scored.doc_id = pool.doc_id
"""
