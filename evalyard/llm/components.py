"""Connected components of a link table, by alternating large-star and small-star steps; a small table in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Links up to which one task joins them; the steps give the same result at any number.
SMALL = 1 << 17


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over undirected edges (a > b). Neighbours are never gathered: a minimum and a join."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
    joined = both.join(least, "a")
    out = joined.where("b <> m" if small else "b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _joined(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def top(x):
            while (y := up.setdefault(x, x)) != x:
                up[x] = x = up[y]
            return x

        for b in batches:
            for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
                x, y = top(x), top(y)
                up[max(x, y)] = min(x, y)
        nodes = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(c, edges_type) for c in (nodes, [top(x) for x in nodes])], ["node", "component"])

    kind = edges.schema["a"].dataType.simpleString()
    edges_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    return edges.coalesce(1).mapInArrow(run, f"node {kind}, component {kind}")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches. Nodes without links aren't listed."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if edges.count() <= SMALL:
        return _joined(edges)
    state = None
    while True:
        edges = materialize(_star(materialize(_star(edges, small=False), "large"), small=True), "edges")
        # order-free fingerprint of the edge set
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = now
