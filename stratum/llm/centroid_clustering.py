"""Centroid clustering of integer vectors: exact Lloyd rounds that skip work by distance bounds.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound of the
distance to any other. After a round the upper bound grows by the move of the own centroid. The
lower bound would have to shrink by the largest move of any other (the full drift); here it shrinks
by less, from the geometry of the plane through the centre of the vector's cluster sphere and the line
of a move. With c moved to c', D apart, m halfway, and a vector x seen from m under the angle t to
the direction of the move::

    |x - c| - |x - c'| = 2 D |x - m| cos t / (|x - c| + |x - c'|) <= D cos t        (t <= 90 degrees)

as the two distances add up to 2 |x - m| at least, and it is at most 0 beyond 90 degrees. A sphere of
radius r around a, with |a - m| > r, is seen from m under angles of at least t(a) - asin(r / |a - m|),
so no vector of it comes nearer to the moved centroid than D times the cosine of that. A vector whose
upper bound stays below its lower bound, or below half the way from its centroid to the next one,
keeps its centroid without looking; if its exact distance does not settle it either, it is scanned
against all centroids. Comparisons leave ``SLACK`` for rounding, and distances are exact integers, so
the result is that of plain Lloyd rounds.

Scale: vectors travel in blocks of ``BLOCK_ROWS`` with their bounds; a round is one pass over the blocks
that writes them with new bounds to the shared folder (and then drops those of the round before), so
nothing is shuffled but one sum a task of k x dims numbers, and a lost executor repeats its blocks of
one round. Only centroids, counts and radii (k x dims numbers) reach the driver.

Defined cases (:func:`grid`): vectors that are NULL, of another length, or hold a NULL or non-finite
component take no part, nor do those with a component beyond ``LIMIT``, whose squared distances a
long cannot hold; rows with a NULL id take part and keep it; repeated rows each take part; rows of one
id are told apart by their components when they are seeds; ties go to the smaller cluster; an empty
table gives an empty result; fewer rows than k give fewer clusters; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.hashed_words import release_memory
from stratum.session import delete_path, scratch_path

BLOCK_ROWS = 4096
LIMIT = 1 << 27             # of a component's size: 64 squares of twice as much fit a long
SLACK = 1e-9
LARGEST = (1 << 63) - 1

_BLOCK = ("ids array<long>, points binary, cluster binary, upper binary, lower binary, "
          "counts array<long>, sums array<long>, radius array<double>")
_TOTALS = "counts array<long>, sums array<long>, radius array<double>"


def usable(vec: Column, dims: int, scale: int) -> Column:
    """Whether a vector of doubles takes part."""
    fits = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LIMIT))
    return F.coalesce((F.size(vec) == dims) & fits, F.lit(False))


def grid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64,
         scale: int = 256) -> DataFrame:
    """(id, point): usable vectors with every component x as floor(scale * x)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return (rows.where(usable(F.col("vec"), dims, scale))
            .select("id", F.transform("vec", lambda x: F.floor(x * scale).cast("long")).alias("point")))


# -- geometry ------------------------------------------------------------------------------------

def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows x centroids) of integer vectors."""
    largest = int(np.abs(points).max(initial=0)) + int(np.abs(centroids).max(initial=0))
    if points.shape[1] * largest ** 2 < 1 << 53:        # every sum below is a whole number that a double holds
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        far = (p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)
        return far.astype(np.int64)
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def own_squared(points: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """Exact squared distance of each vector to its own centroid."""
    return ((points - centroids[cluster]) ** 2).sum(axis=1)


def half_gaps(centroids: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to the next one (infinite for a single one)."""
    apart = squared(centroids, centroids).astype(np.float64)
    np.fill_diagonal(apart, np.inf)
    return np.sqrt(apart.min(axis=1)) / 2


def drift(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return np.sqrt(((new - old) ** 2).sum(axis=1).astype(np.float64))


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, how much nearer than before any other moved centroid can be to its vectors,
    which lie within ``radius`` of its old centroid."""
    moved, k = drift(old, new), len(old)
    axis = (new - old) / np.where(moved > 0, moved, 1)[:, None]
    middle = (old + new) / 2
    out = np.zeros(k)
    for i in range(k):
        way = old[i] - middle
        apart = np.sqrt((way ** 2).sum(axis=1))
        cos = np.divide((way * axis).sum(axis=1), apart, out=np.ones(k), where=apart > 0)
        spread = np.arcsin(np.divide(radius[i], apart, out=np.ones(k), where=apart > radius[i]))
        angle = np.maximum(np.arccos(np.clip(cos, -1, 1)) - spread, 0)
        nearer = moved * np.where(apart > radius[i], np.maximum(np.cos(angle), 0), 1)
        nearer[i] = 0
        out[i] = nearer.max(initial=0)
    return out


# -- rounds --------------------------------------------------------------------------------------

@dataclass
class Move:
    """Centroids of a round, and how far bounds of the round before give way (None at first)."""
    centroids: np.ndarray
    own: np.ndarray | None = None
    others: np.ndarray | None = None


def _first(points: np.ndarray, move: Move):
    far = squared(points, move.centroids)
    cluster = far.argmin(axis=1).astype(np.int32)
    rows = np.arange(len(points))
    upper = np.sqrt(far[rows, cluster].astype(np.float64))
    rest = far.astype(np.float64)
    rest[rows, cluster] = np.inf
    return cluster, upper, np.sqrt(rest.min(axis=1))


def reassign(points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, move: Move):
    """(cluster, upper, lower, vectors scanned) after a move; only what the bounds leave open is looked at."""
    upper = (upper + move.own[cluster]) * (1 + SLACK)
    lower = np.maximum(lower - move.others[cluster], 0) * (1 - SLACK)
    cluster = cluster.copy()
    safe = np.maximum(lower, half_gaps(move.centroids)[cluster]) * (1 - SLACK)
    open_ = np.flatnonzero(upper >= safe)
    upper[open_] = np.sqrt(own_squared(points[open_], move.centroids, cluster[open_]).astype(np.float64)) * (1 + SLACK)
    open_ = open_[upper[open_] >= safe[open_]]
    if len(open_):
        cluster[open_], upper[open_], lower[open_] = _first(points[open_], move)
    return cluster, upper, lower, len(open_)


def _sums(points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, k: int):
    order = np.argsort(cluster, kind="stable")
    present, starts = np.unique(cluster[order], return_index=True)
    counts, sums, radius = np.zeros(k, np.int64), np.zeros((k, points.shape[1]), np.int64), np.zeros(k)
    counts[:] = np.bincount(cluster, minlength=k)
    if len(present):
        sums[present] = np.add.reduceat(points[order], starts, axis=0)
        radius[present] = np.maximum.reduceat(upper[order], starts) * (1 + SLACK)
    return counts, sums, radius


def _block(ids: pa.Array, points: np.ndarray, cluster, upper, lower, k: int) -> dict:
    counts, sums, radius = _sums(points, cluster, upper, k)
    return {"ids": ids.to_pylist(), "points": points.tobytes(), "cluster": cluster.astype(np.int32).tobytes(),
            "upper": upper.tobytes(), "lower": lower.tobytes(), "counts": counts.tolist(),
            "sums": sums.ravel().tolist(), "radius": radius.tolist()}


_BLOCK_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("points", pa.binary()), ("cluster", pa.binary()),
                          ("upper", pa.binary()), ("lower", pa.binary()), ("counts", pa.list_(pa.int64())),
                          ("sums", pa.list_(pa.int64())), ("radius", pa.list_(pa.float64()))])


def _packer(move: Move, dims: int):
    """Rows to blocks, with the first assignment."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                points = part.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                block = _block(part.column("id"), points, *_first(points, move), len(move.centroids))
                yield pa.RecordBatch.from_pylist([block], schema=_BLOCK_ARROW)
        release_memory()
    return pack


def _opened(row: dict, dims: int):
    points = np.frombuffer(row["points"], np.int64).reshape(-1, dims)
    return (points, np.frombuffer(row["cluster"], np.int32), np.frombuffer(row["upper"]),
            np.frombuffer(row["lower"]))


def _stepper(move: Move, dims: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                points, *state = _opened(row, dims)
                cluster, upper, lower, _ = reassign(points, *state, move)
                block = _block(batch.column("ids").slice(k, 1).flatten(), points, cluster, upper, lower,
                               len(move.centroids))
                yield pa.RecordBatch.from_pylist([block], schema=_BLOCK_ARROW)
        release_memory()
    return step


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, "clusters")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _totals(blocks: DataFrame, k: int, dims: int):
    """Counts, sums and radii over all blocks: one row a task, then sums by place."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, radius = np.zeros(k, np.int64), np.zeros(k * dims, np.int64), np.zeros(k)
        for batch in batches:
            wide = [batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    for c in ("counts", "sums", "radius")]
            counts, sums = counts + wide[0].sum(axis=0), sums + wide[1].sum(axis=0)
            radius = np.maximum(radius, wide[2].max(axis=0, initial=0))
        row = {"counts": counts.tolist(), "sums": sums.tolist(), "radius": radius.tolist()}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([_BLOCK_ARROW.field(c) for c in row]))

    tasks = blocks.select("counts", "sums", "radius").mapInArrow(total, _TOTALS)
    places = tasks.select(F.posexplode(F.concat("counts", "sums")).alias("at", "n"), "radius").select(
        "at", "n", F.get("radius", F.col("at")).alias("r"))
    rows = places.groupBy("at").agg(F.sum("n").alias("n"), F.max("r").alias("r")).collect()    # k x (dims + 1)
    found, radius = np.zeros(k * (dims + 1), np.int64), np.zeros(k)
    for r in rows:
        found[r["at"]] = r["n"]
        if r["at"] < k:
            radius[r["at"]] = r["r"]
    return found[:k], found[k:].reshape(k, dims), radius


@dataclass
class Clusters:
    """``assigned``: (id, point, cluster, distance). By cluster: its centroid, the number of its vectors
    and the sum of their squared distances."""
    assigned: DataFrame
    centroids: np.ndarray
    counts: list[int]
    inertia: list[int]

    def centroid_sha256(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def _unpacker(centroids: np.ndarray, dims: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                points, cluster, _, _ = _opened(row, dims)
                flat = pa.array(points.ravel())
                offsets = pa.array(np.arange(0, len(flat) + 1, dims, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(k, 1).flatten(), pa.ListArray.from_arrays(offsets, flat),
                     pa.array(cluster), pa.array(own_squared(points, centroids, cluster))],
                    names=["id", "point", "cluster", "distance"])
        release_memory()
    return unpack


def cluster(points: DataFrame, seed_order: list[Column], k: int = 40, rounds: int = 5) -> Clusters:
    """Lloyd's clusters of (id long, point array<long> of one length).

    The first k rows by ``seed_order`` (then by their components) are the first centroids. Each round
    assigns every vector to its nearest centroid and moves every centroid with vectors to their mean,
    rounded down by component; then vectors are assigned once more.
    """
    spark = points.sparkSession
    seeds = [r["point"] for r in points.orderBy(*seed_order, "point").select("point").limit(k).collect()]
    if not seeds:
        empty = spark.createDataFrame([], "id long, point array<long>, cluster int, distance long")
        return Clusters(empty, np.zeros((0, 0), np.int64), [], [])
    k, dims = len(seeds), len(seeds[0])
    move = Move(np.array(seeds, np.int64))
    blocks, path = _stored(points.select("id", "point").mapInArrow(_packer(move, dims), _BLOCK))
    for _ in range(rounds):
        counts, sums, radius = _totals(blocks, k, dims)
        old = move.centroids
        new = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], old)
        move = Move(new, drift(old, new), loosening(old, new, radius))
        blocks, newer = _stored(blocks.select(*blocks.columns).mapInArrow(_stepper(move, dims), _BLOCK))
        delete_path(spark, path)
        path = newer
    assigned = blocks.select("ids", "points", "cluster", "upper", "lower").mapInArrow(
        _unpacker(move.centroids, dims), "id long, point array<long>, cluster int, distance long")
    found = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    counts, inertia = [0] * k, [0] * k
    for r in found:
        counts[r["cluster"]], inertia[r["cluster"]] = r["n"], int(r["inertia"])
    return Clusters(assigned, move.centroids, counts, inertia)


def report(found: Clusters) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector; a sum that a
    long cannot hold is NULL. The k rows of clusters are broadcast."""
    spark = found.assigned.sparkSession
    whole = sum(found.inertia)
    rows = [(c, i if i <= LARGEST else None, whole if whole <= LARGEST else None, sha)
            for c, (i, sha) in enumerate(zip(found.inertia, found.centroid_sha256()))]
    by_cluster = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.assigned.select("id", "cluster", "distance").join(F.broadcast(by_cluster), "cluster")
            .select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
