"""Approximate nearest neighbours by a permutation index.

Every vector is represented by its ``prefix`` nearest pivots in order of distance. Per block of
vectors these prefixes are posted in inverted files: for each pivot, the vectors that hold it and
the place it has there. A query reads the files of its own prefix and sums, per vector, how much
nearer than the worst case each shared pivot's places are; that ranks the vectors by Spearman
footrule distance. The best of the ranking are reranked by exact Euclidean distance.

``candidates`` vectors are reranked, or ``share`` of all if that is more, spread over the blocks.
The pivots are the bounded sample that the index is fitted on (``PIVOTS``, the ids with the
smallest hash); every vector is indexed. Recall against brute force on unit vectors without any
structure (the hardest case): see the tests, at least 0.9.

Scale: index blocks have ``BLOCK_ROWS`` vectors and query blocks ``QUERY_ROWS`` queries, and a
task handles one of each, so memory is bounded. A task returns ``k`` rows a query.

Defined cases: vectors NULL, empty, zero, or with NULL or non-finite components take no part, nor
do vectors of another length than the most frequent one (ties: the longer); rows with a NULL id
take no part; rows that share an id are all candidates (their id may appear again in a result) but
ask once, with the least vector, and are never their own neighbours; ties go to the smaller id; with
fewer than k candidates all are returned; other columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 1024
PREFIX = 128
CANDIDATES = 2000
SHARE = 0.05
BLOCK_ROWS = 16384
QUERY_ROWS = 2048


def usable(vec: Column) -> Column:
    """Whether a vector can take part."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _matrix(vecs: pd.Series) -> np.ndarray:
    return np.stack(vecs.to_numpy()).astype(np.float64) if len(vecs) else np.empty((0, 0))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each row's nearest pivots, nearest first (ties: the pivot that comes first)."""
    far = (pivots ** 2).sum(axis=1) - 2 * (x @ pivots.T)
    return np.argsort(far, axis=1, kind="stable")[:, :prefix]


class InvertedFiles:
    """Per pivot: the vectors that have it in their prefix, and its place there."""

    def __init__(self, order: np.ndarray, pivots: int):
        self.rows, self.prefix = order.shape
        pivot = order.ravel()
        by_pivot = np.argsort(pivot, kind="stable")
        self.starts = np.searchsorted(pivot[by_pivot], np.arange(pivots + 1))
        self.vector = (by_pivot // self.prefix).astype(np.int32)
        self.place = (by_pivot % self.prefix).astype(np.int32)

    def ranked(self, order: np.ndarray) -> np.ndarray:
        """All vectors by footrule distance to a query's prefix; ties in the order of the block."""
        near = np.zeros(self.rows, np.int32)
        for k, p in enumerate(order.tolist()):
            a, z = self.starts[p], self.starts[p + 1]
            near[self.vector[a:z]] += self.prefix - np.abs(self.place[a:z] - k)
        return np.argsort(-near, kind="stable")


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = 10, pivots: int = PIVOTS, prefix: int = PREFIX, candidates: int = CANDIDATES,
           share: float = SHARE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, nearest first.

    ``is_query`` is a condition on the columns of ``vectors``.
    """
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where(F.col("id").isNotNull() & usable(F.col("vec"))))
    lengths = rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    found = lengths.orderBy(F.desc("c"), F.desc("n")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    length, total = found["n"], found["c"]
    each = (rows.where(F.size("vec") == length)        # rows that repeat whole are kept once, with their number
            .groupBy("id", "vec").agg(F.count(F.lit(1)).alias("times"), F.max("asks").alias("asks")))
    rows = each.groupBy("id").agg(F.min("vec").alias("vec"), F.max("asks").alias("asks"))
    fitted = rows.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(pivots).toPandas()
    centre = _matrix(fitted["vec"])
    depth = min(prefix, len(centre))
    blocks = max(1, ceil(total / block_rows))
    wanted = ceil(max(candidates, share * total) / blocks)

    index = each.select("id", "vec", F.least("times", F.lit(k)).alias("times"), F.xxhash64("vec").alias("turn"),
                        F.pmod(F.xxhash64(F.lit(3), "id", "vec"), F.lit(blocks)).cast("int").alias("block"))
    asked = rows.where("asks").select("id", "vec")
    groups = max(1, ceil(asked.count() / QUERY_ROWS))
    asked = (asked.withColumn("part", F.pmod(F.xxhash64(F.lit(4), "id"), F.lit(groups)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def nearest(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(queries):
            own = own.sort_values(["id", "turn"], kind="stable")
            ids, x, times = own["id"].to_numpy(), _matrix(own["vec"]), own["times"].to_numpy()
            files = InvertedFiles(nearest_pivots(x, centre, depth), len(centre))
            asks = _matrix(queries["vec"])
            for q, a, order in zip(queries["id"].to_numpy(), asks, nearest_pivots(asks, centre, depth)):
                best = files.ranked(order)
                best = np.sort(best[ids[best] != q][:wanted])
                apart = np.sqrt(((x[best] - a) ** 2).sum(axis=1))
                first = np.argsort(apart, kind="stable")[:k]
                first = np.repeat(first, times[best[first]])[:k]
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids[best[first]], "score": apart[first]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    near = (index.groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
            .applyInPandas(nearest, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
