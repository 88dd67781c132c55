import random
import zlib

import pytest
from pyspark.sql import functions as F

from evalyard.llm import queries, resharding

from .oracle import SF


def test_flow_is_cheapest_on_small_networks():
    import itertools

    rng = random.Random(4)
    for _ in range(60):
        m, n = rng.randint(1, 3), rng.randint(1, 3)
        supply = [rng.randint(0, 3) for _ in range(m)]
        cap = [rng.randint(0, 3) for _ in range(n)]
        if sum(supply) > sum(cap):
            continue
        cost = [[rng.randint(0, 4) for _ in range(n)] for _ in range(m)]
        flow = resharding.min_cost_flow(supply, cap, cost)
        got = sum(f * c for fs, cs in zip(flow, cost) for f, c in zip(fs, cs))
        assert [sum(f) for f in flow] == supply and all(sum(f[t] for f in flow) <= cap[t] for t in range(n)) and all(x >= 0 for f in flow for x in f)
        units = [s for s, k in enumerate(supply) for _ in range(k)]
        best = min((sum(cost[s][t] for s, t in zip(units, to)) for to in itertools.product(range(n), repeat=len(units)) if all(to.count(t) <= cap[t] for t in range(n))), default=0)
        assert got == best


def check(rows, shards, total_rows):
    assert len(rows) == total_rows
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {k: sum(r.size for r in v) for k, v in by.items()}


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_resharding"](spark, SF).collect()
    size = check(rows, 24, len(docs))
    assert all(r.size == len((docs[r.doc_id] or "").encode()) + 8 and r.text_crc32 == zlib.crc32((docs[r.doc_id] or "").encode()) for r in rows)
    most = max(r.size for r in rows)
    mean = sum(size.values()) / 24
    assert all(abs(size.get(k, 0) - mean) <= 2 * most for k in range(24))
    moved = sum(r.size for r in rows if r.shard != r.old_shard)
    old = {}
    for r in rows:
        old[r.old_shard] = old.get(r.old_shard, 0) + r.size
    need = sum(max(0, v - mean) for v in old.values())
    assert moved <= need + 16 * most


def test_near_equal_with_a_hot_shard_nulls_and_repeats(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, "x" * rng.randint(0, 50), 0 if i % 3 else i % 5, "q") for i in range(3000)] + [(7, None, None, "q"), (7, None, None, "q"), (None, "n", 2, "q")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, at int, slot string")
    plan = resharding.reshard(resharding.sized(df, carry={"home": F.col("at")}), F.col("home"), 5, 7, blocks=8)
    size = check(plan.collect(), 7, len(rows))
    mean = sum(size.values()) / 7
    assert all(abs(v - mean) < 0.02 * mean for v in size.values())
    out = str(tmp_path / "out")
    resharding.rewrite(df.select("doc_id", "text"), plan, out)
    hit = {r.shard for r in plan.where("old <> shard").collect()} | {r.old for r in plan.where("old <> shard").collect()}
    assert {r.shard for r in spark.read.parquet(out).select("shard").distinct().collect()} == {s for s in hit if s in size}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert resharding.reshard(resharding.sized(df), F.lit(0), 1, 3).count() == 0


def test_rewrite_in_place_writes_the_rows_of_the_plan(spark, tmp_path):
    from evalyard.session import row_keys

    rows = [(i, "x" * (i % 40), i % 3) for i in range(600)] + [(7, None, 0)] * 3 + [(7, "aa", 1), (7, "aa", 2), (None, "n", 2), (None, "n", 2), (None, "m", 0)] + [(i, "y", 4) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, home int")
    for key in (None, "row_key"):
        docs = row_keys(df)[0] if key else df
        carry = {"home": F.col("home")} | ({key: F.col(key)} if key else {})
        # shard 3 neither gives nor takes, shard 4 loses all
        plan = resharding.reshard(resharding.sized(docs, carry=carry), F.col("home"), 5, 3, blocks=8)
        out = str(tmp_path / f"out{key}")
        start = docs.select("doc_id", "text", *([key] if key else []), F.lit(0).alias("slot"), F.col("home").alias("shard"))
        start.union(start.limit(1).withColumn("shard", F.lit(3))).write.partitionBy("shard").parquet(out)
        resharding.rewrite(spark.read.parquet(out).where("shard <> 3"), plan, out, key=key)
        got = [(r.doc_id, len(r.text or "") + 8, r.shard, r.slot) for r in spark.read.parquet(out).where("shard <> 3").collect()]
        want = [(r.doc, r.size, r.shard, r.slot) for r in plan.collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        assert spark.read.parquet(out).where("shard = 3").count() == 1


def test_places_against_a_plain_walk(spark):
    rng = random.Random(6)
    rows = [(i, "x" * rng.randint(0, 60), rng.choice([0, 0, 0, 1, 3])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, home int")
    sized = resharding.sized(df, carry={"home": F.col("home")})
    block = {r.doc: r.b for r in sized.select("doc", F.pmod(F.xxhash64("doc", "size"), F.lit(8)).cast("int").alias("b")).collect()}
    size = {i: len(t) + 8 for i, t, _ in rows}
    supply = [sum(size[i] for i, _, h in rows if h == s) for s in range(4)]
    room = resharding.equal_capacities(sum(supply), 6)
    flow = resharding.min_cost_flow(supply, room, [[int(s != t) for t in range(6)] for s in range(4)])
    want, filled = {}, [0] * 6
    walk = []
    for s in range(4):
        byte = 0
        for i in sorted((i for i, _, h in rows if h == s), key=lambda i: (block[i], i)):
            left = byte  # the destination whose stretch of the old shard's bytes holds the row's first byte; what stays comes first
            for t in sorted(range(6), key=lambda t: (t != s, t)):
                if left < flow[s][t]:
                    break
                left -= flow[s][t]
            walk.append((t, s, block[i], byte, i))
            byte += size[i]
    for t, _, _, _, i in sorted(walk):
        want[i] = (t, filled[t])
        filled[t] += 1
    got = {r.doc: (r.shard, r.slot) for r in resharding.reshard(sized, F.col("home"), 4, 6, blocks=8).collect()}
    assert got == want
    with pytest.raises(ValueError, match="shard 3"):
        resharding.reshard(sized, F.col("home"), 3, 6)
