import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import centroid_clustering as cc
from stratum.llm.registry import op12_centroid_clustering


def lloyd(points, seeds, rounds):
    """Plain rounds in Python integers: (cluster of each point, centroids)."""
    def assign(centroids):
        return [min(range(len(centroids)), key=lambda c: (sum((a - b) ** 2 for a, b in zip(p, centroids[c])), c))
                for p in points]
    centroids = [list(s) for s in seeds]
    for _ in range(rounds):
        own = assign(centroids)
        for c in range(len(centroids)):
            mine = [p for p, o in zip(points, own) if o == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return assign(centroids), centroids


def by_hash(col="id"):
    return F.sha2(F.concat(F.lit("2:"), F.col(col).cast("string")), 256).asc_nulls_last()


def test_query_against_plain_rounds(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    points = {r.vec_id: [math.floor(256 * x) for x in r.embedding] for r in rows}
    order = sorted(points, key=lambda v: hashlib.sha256(f"2:{v}".encode()).hexdigest())
    ids = list(points)
    own, centroids = lloyd([points[v] for v in ids], [points[v] for v in order[:40]], 5)
    apart = [sum((a - b) ** 2 for a, b in zip(points[v], centroids[c])) for v, c in zip(ids, own)]
    found = {r.vec_id: r for r in op12_centroid_clustering(spark, sf).collect()}
    assert len(found) == len(rows)
    for v, c, d in zip(ids, own, apart):
        r = found[v]
        assert (r.cluster, r.distance, r.inertia) == (c, d, sum(apart))
        assert r.cluster_inertia == sum(x for x, o in zip(apart, own) if o == c)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()


@pytest.mark.parametrize("spread", [3, 300, 1 << 26])
def test_bounds_change_nothing_and_save_scans(spread):
    """Rounds by bounds over blobs, over ties (small spread) and over values that doubles cannot hold."""
    rng = np.random.default_rng(spread)
    blobs = np.repeat(rng.integers(-spread, spread, (12, 6)), 50, axis=0)
    points = blobs + rng.integers(-(spread // 6) - 1, spread // 6 + 1, (600, 6))
    move = cc.Move(points[rng.choice(600, 15, replace=False)])
    cluster, upper, lower = cc._first(points, move)
    scanned = 0
    for _ in range(8):
        counts, sums, radius = cc._sums(points, cluster, upper, 15)
        new = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], move.centroids)
        move = cc.Move(new, cc.drift(move.centroids, new), cc.loosening(move.centroids, new, radius))
        cluster, upper, lower, looked = cc.reassign(points, cluster, upper, lower, move)
        scanned += looked
        far = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in new] for p in points], object)
        assert cluster.tolist() == far.argmin(axis=1).tolist()
        true = np.sqrt(far.astype(np.float64))
        rows = np.arange(600)
        assert (upper >= true[rows, cluster] * (1 - 1e-12)).all()
        true[rows, cluster] = np.inf
        assert (lower <= true.min(axis=1) * (1 + 1e-12) + 1e-9).all()
    if spread > 3:
        assert scanned < 8 * 600 / 2


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000))
def test_loosening_holds_and_is_less_than_the_drift(seed):
    rng = np.random.default_rng(seed)
    old, dims = rng.normal(size=(6, 4)) * 10, 4
    new = old + rng.normal(size=(6, 4)) * rng.choice([0, 0.1, 5], (6, 1))
    radius = np.abs(rng.normal(size=6)) * rng.choice([0.1, 5])
    loose, full = cc.loosening(old, new, radius), cc.drift(old, new)
    for i in range(6):
        others = np.arange(6) != i
        assert loose[i] <= full[others].max() + 1e-9
        way = rng.normal(size=(400, dims))
        x = old[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.uniform(size=(400, 1)) ** 0.25
        gain = np.linalg.norm(x[:, None] - old, axis=2) - np.linalg.norm(x[:, None] - new, axis=2)
        assert gain[:, others].max() <= loose[i] + 1e-9


def test_far_spheres_loosen_less():
    old = np.array([[0, 0], [100, 0], [0, 300]])
    new = np.array([[0, 0], [100, 40], [0, 300]])
    loose = cc.loosening(old, new, np.array([5.0, 5.0, 5.0]))
    assert loose[0] < 0.3 * 40 and loose[1] == 0      # seen from the side; its own move does not count


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.5]), (1, [1.0, 0.5]), (1, [0.0, -0.001]), (2, None), (3, []), (4, [nan, 0.0]), (5, [inf, 0.0]),
            (6, [None, 1.0]), (7, [1.0]), (None, [2.0, 2.0]), (8, [1e30, 0.0]), (9, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {"cluster": F.lit("x"), "id": F.lit(0), "point": F.lit(1), "distance": F.lit(None)})
    points = cc.grid(df, dims=2)
    assert sorted((r.id or 0, r.point) for r in points.collect()) == [
        (0, [512, 512]), (1, [0, -1]), (1, [256, 128]), (1, [256, 128]), (9, [0, 0])]
    found = cc.report(cc.cluster(points, [by_hash()], k=3)).collect()
    assert len(found) == 5 and {r.cluster for r in found} <= {0, 1, 2}
    own = {}
    for r in found:
        own.setdefault(r.cluster, []).append(r.distance)
    assert all(r.cluster_inertia == sum(own[r.cluster]) for r in found)
    # more clusters than rows; equal seeds: the smaller number takes the rows, the other stays empty
    few = cc.cluster(points.where("id = 1"), [by_hash()], k=40)
    assert len(few.counts) == 3 and sorted(few.counts) == [0, 1, 2]
    assert cc.report(cc.cluster(points.where("id = -1"), [by_hash()])).count() == 0


def test_sums_beyond_a_long_are_null(spark):
    far = [(i, [float((1 << 18) * (-1) ** i)] * 64) for i in range(40)]
    points = cc.grid(spark.createDataFrame(far, "vec_id long, embedding array<double>"))
    found = cc.cluster(points, [by_hash()], k=1)
    assert found.counts == [40] and found.inertia[0] > cc.LARGEST
    assert {r.inertia for r in cc.report(found).collect()} == {None}
