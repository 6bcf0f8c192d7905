"""Connected components of a distributed edge list."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored

EDGES_IN_ONE_TASK = 500_000     # 16 bytes each


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over all edges of a partition."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = root(u), root(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
    nodes = list(parent)
    for k in range(0, len(nodes), 50_000):
        part = nodes[k:k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())],
                                         names=["node", "label"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         one_task: int = EDGES_IN_ONE_TASK) -> DataFrame:
    """(node, label): the smallest node of each node's component, for all nodes of ``edges``.

    Up to ``one_task`` edges, counted first, are joined by union-find in one executor task. Beyond
    that:

    Alternating large-star and small-star steps: each node is tied to the smallest node known
    around it until every edge joins a node to its component's smallest. The number of
    rounds is logarithmic in practice whatever the shape; every round is a map-side-combined
    minimum and one join, written to the shared folder. A node with very many edges is a
    skewed join key, which adaptive execution splits.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    pairs, before = stored(pairs, "edges"), None
    if pairs.count() <= one_task:
        return stored(pairs.coalesce(1).mapInArrow(_label, "node long, label long"), "labels")
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: every node's smaller neighbours, itself included, go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        step = stored(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                      .union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        sums = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
        now, pairs = step.agg(*sums).first(), step
        if now == before:
            break
        before = now
    return (pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .union(pairs.select(F.col("v"), F.col("v")).distinct()))
