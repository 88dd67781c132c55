"""Minimum-cost-flow resharding: move the fewest bytes from an old layout to new shard capacities.

Sizes are summed per (old shard, block), a bounded table, and prefix sums over it place every
block on its shard's byte line. The flow network has a source arc per old shard (its bytes), a
sink arc per new shard (its capacity) and arcs between them whose cost per byte is 0 for
staying and 1 for moving; it is solved on the driver over shards only. Its flows cut each old
shard's line into one run per destination, and a document follows the run in which it begins.
Only the prefix sums inside one block are a window over rows, so no task gets a whole shard.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

#: Blocks over which each old shard's rows are hashed; old shards x blocks rows reach the driver.
BLOCKS = 512
OVERHEAD = 8


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow matrix of least total cost that ships all supply within the capacities.

    Successive shortest paths with potentials: each round augments along a cheapest residual
    path from a shard with supply left to one with room. The capacities must hold the supply.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities are smaller than the supply")
    m, n = len(supply), len(capacity)
    flow = [[0] * n for _ in range(m)]
    left, room, price = list(supply), list(capacity), [0] * (m + n)
    while any(left):
        dist, back = [None] * (m + n), [-1] * (m + n)
        heap = [(0, s) for s in range(m) if left[s]]
        for _, s in heap:
            dist[s] = 0
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            if u < m:
                arcs = [(m + t, cost[u][t]) for t in range(n)]
            else:
                arcs = [(s, -cost[s][u - m]) for s in range(m) if flow[s][u - m]]
            for v, c in arcs:
                e = d + c + price[u] - price[v]
                if dist[v] is None or e < dist[v]:
                    dist[v], back[v] = e, u
                    heapq.heappush(heap, (e, v))
        goals = [t for t in range(n) if room[t] and dist[m + t] is not None]
        end = m + min(goals, key=lambda t: dist[m + t] + price[m + t])
        far = max(x for x in dist if x is not None)
        price = [p + (far if x is None else x) for p, x in zip(price, dist)]
        path = [end]
        while back[path[-1]] >= 0:
            path.append(back[path[-1]])
        path.reverse()
        arcs = list(zip(path, path[1:]))
        amount = min([left[path[0]], room[end - m], *(flow[v][u - m] for u, v in arcs if u >= m)])
        for u, v in arcs:
            if u < m:
                flow[u][v - m] += amount
            else:
                flow[v][u - m] -= amount
        left[path[0]] -= amount
        room[end - m] -= amount
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """doc, size (UTF-8 bytes of the text, none for null, plus 8), text_crc32 and ``carry``; texts go no further."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc"), (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *(c.alias(k) for k, c in (carry or {}).items()))


def _pick(runs: list[tuple[int, int, int]]) -> Column:
    """Destination of (old, at): runs are (old shard, first byte, destination), a bounded list."""
    by_old: dict[int, list[tuple[int, int]]] = {}
    for s, at, t in runs:
        by_old.setdefault(s, []).append((at, t))
    out = F.lit(None).cast("int")
    for s, own in by_old.items():
        inner = F.lit(own[0][1])
        for at, t in own[1:]:
            inner = F.when(F.col("at") >= at, F.lit(t)).otherwise(inner)
        out = F.when(F.col("old") == s, inner).otherwise(out)
    return out


def reshard(rows: DataFrame, old: Column, old_shards: int, new_shards: int, capacities: list[int] | None = None, cost: list[list[int]] | None = None, blocks: int = BLOCKS) -> DataFrame:
    """All columns of ``rows`` (doc, size, ...) plus old, shard and slot (gapless from 0 in each shard).

    ``old`` gives each row's present shard, 0 to ``old_shards - 1``, another one is an error; null counts as 0. By default the
    capacities are equal and moving a byte costs 1. Rows that share an id and size are kept apart
    by their other columns only; all of them get a slot. An empty table gives an empty result.
    """
    block = F.pmod(F.xxhash64("doc", "size"), F.lit(blocks)).cast("int")
    rows = materialize(rows.withColumns({"old": F.coalesce(old.cast("int"), F.lit(0)), "block": block}), "sized")
    sums = rows.groupBy("old", "block").agg(F.sum("size").alias("bytes")).collect()  # old shards x blocks rows at most
    line: dict[int, dict[int, int]] = {s: {} for s in range(old_shards)}
    for r in sums:
        if r.old not in line:
            raise ValueError(f"a row lies in shard {r.old}, and there are {old_shards}")
        line[r.old][r.block] = r.bytes
    supply = [sum(line[s].values()) for s in range(old_shards)]
    capacities = capacities or equal_capacities(sum(supply), new_shards)
    cost = cost or [[int(s != t) for t in range(new_shards)] for s in range(old_shards)]
    flow = min_cost_flow(supply, capacities, cost)

    runs = []
    for s, to in enumerate(flow):
        order = sorted(range(new_shards), key=lambda t: (t != s, t))  # what stays comes first
        ends = list(accumulate(to[t] for t in order))
        runs += [(s, end - to[t], t) for end, t in zip(ends, order) if to[t]]
    starts = [(s, b, end - own[b]) for s, own in line.items() for b, end in zip(sorted(own), accumulate(own[b] for b in sorted(own)))]
    spark = rows.sparkSession
    starts = spark.createDataFrame(starts, "old int, block int, start bigint")
    others = sorted(c for c in rows.columns if c not in ("doc", "size", "old", "block"))
    inside = Window.partitionBy("old", "block").orderBy("doc", "size", *others)
    at = F.col("start") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = rows.join(F.broadcast(starts), ["old", "block"]).withColumn("at", at).withColumn("shard", _pick(runs) if runs else F.lit(0))
    placed = placed.withColumn("nth", F.row_number().over(Window.partitionBy("old", "block", "shard").orderBy("at", "doc", "size", *others)))
    placed = materialize(placed.drop("at", "start"), "placed")
    # rows per (shard, old shard, block): bounded, so one small window orders them within a shard
    counts = placed.groupBy("shard", "old", "block").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("shard").orderBy("old", "block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    return placed.join(F.broadcast(counts), ["shard", "old", "block"]).withColumn("slot", F.col("base") + F.col("nth") - 1).drop("base", "nth")


def rewrite(docs: DataFrame, plan: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", key: str | None = None) -> None:
    """Write the files that the plan affects: for each shard that lost or got rows, its new content under ``path/shard=k``.

    Shards that neither give nor take keep their old files and aren't written. ``key`` names a column
    of both tables that is each row's own. Without it rows meet by id, size and checksum, nulls
    included, one to one; shards that hold such repeats of another shard's rows are written too, so
    no row is lost or written twice whichever of the repeats a shard gets. ``docs`` may be what lies
    under ``path`` now; its columns shard and slot are replaced.
    """
    docs = docs.drop("shard", "slot")
    same = [key] if key else ["doc", "size", "text_crc32"]
    moved = plan.where("old <> shard")
    affected = moved.select(F.col("shard").alias("hit")).union(moved.select("old"))
    if not key:
        spread = plan.groupBy(*same).agg(F.array_distinct(F.flatten(F.array(F.collect_set("shard"), F.collect_set("old")))).alias("shards")).where("size(shards) > 1")
        affected = affected.union(spread.select(F.explode("shards")))
    hit = sorted(r.hit for r in affected.distinct().collect())  # shards only
    part = plan.select(*(F.col(c).alias(f"to_{c}") for c in same), "shard", "slot")
    if key:
        rows = docs.withColumn(f"to_{key}", F.col(key))
    else:
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = docs.withColumns({"to_doc": F.col(id_col), "to_size": (F.octet_length(text) + OVERHEAD).cast("bigint"), "to_text_crc32": F.crc32(text.cast("binary"))})
        each = Window.partitionBy(*(f"to_{c}" for c in same))
        part = part.withColumn("to_nth", F.row_number().over(each.orderBy("shard", "slot")))
        rows = rows.withColumn("to_nth", F.row_number().over(each.orderBy(text_col)))
        same = [*same, "nth"]
    part = part.where(F.col("shard").isin(hit))
    part = part.select(*(F.col(f"to_{c}").alias(f"plan_{c}") for c in same), "shard", "slot")
    joined = rows.join(part, [F.col(f"to_{c}").eqNullSafe(F.col(f"plan_{c}")) for c in same]).drop(*(f"{k}_{c}" for c in same for k in ("to", "plan")))
    # written before the target is touched: the rows may come from its own files
    joined = materialize(joined, "rewritten")
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    full = {r.shard for r in joined.select("shard").distinct().collect()}
    context = docs.sparkSession.sparkContext
    for k in set(hit) - full:  # a shard that has lost all its rows
        gone = context._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={k}")
        gone.getFileSystem(context._jsc.hadoopConfiguration()).delete(gone, True)
