import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import permutation_index
from stratum.llm.registry import op5_nearest_vectors


def brute(rows, queries, k=10):
    out = {}
    for q in queries:
        near = sorted((float(np.sqrt(((np.array(rows[v]) - np.array(rows[q])) ** 2).sum())), v) for v in rows if v != q)
        out[q] = near[:k]
    return out


def test_small_table_is_exact(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = {r.vec_id: [float(x) for x in r.embedding] for r in table.collect()}
    want = brute(rows, [v for v in rows if v % 100 == 0])
    found = op5_nearest_vectors(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == sum(map(len, want.values()))
    for r in found:
        score, vec = want[r.query_id][r.rank - 1]
        assert r.vec_id == vec and r.score == pytest.approx(score, rel=1e-12)


def test_recall_on_unit_vectors_without_structure(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = permutation_index.search(df, F.pmod(F.col("vec_id"), F.lit(100)) == 0, candidates=700,
                                     block_rows=2_000).collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q, ids in got.items():
        apart = ((x - x[q]) ** 2).sum(axis=1)
        apart[q] = np.inf
        hits.append(len(ids & set(np.argsort(apart)[:10].tolist())) / 10)
    assert len(got) == 60 and np.mean(hits) >= 0.9


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (100, [0.0, 1.0]), (200, [0.0, -1.0]), (200, [0.0, -1.0]),
            (None, [1.0, 1.0]), (300, [0.0, 0.0]), (400, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1)).withColumn("id", F.lit("x"))
    found = permutation_index.search(df, F.pmod(F.col("vec_id"), F.lit(100)) == 0, k=3).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    two = round(math.sqrt(2), 9)
    assert got == {0: [(1, 0.0), (2, 0.0), (100, two)], 100: [(0, two), (1, two), (2, two)], 200: [(0, two), (1, two), (2, two)]}


def test_fewer_than_k_and_none(spark):
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert permutation_index.search(one, F.lit(True)).collect() == []
    assert permutation_index.search(one.where("vec_id > 5"), F.lit(True)).collect() == []


def test_footrule_ranking_equals_its_definition():
    rng = random.Random(2)
    order = np.array([rng.sample(range(12), 5) for _ in range(40)])
    files, query = permutation_index.InvertedFiles(order, 12), order[7]
    place = [{p: k for k, p in enumerate(row.tolist())} for row in order]
    far = [sum(abs(row[p] - k) if p in row else 5 for k, p in enumerate(query.tolist())) for row in place]
    assert files.ranked(query).tolist() == sorted(range(40), key=lambda i: (far[i], i))


@pytest.mark.parametrize("width, least", [(64, 0.97), (128, 0.9)])
def test_recall_with_the_shipped_defaults(spark, width, least):
    """More vectors than the candidates of every block cover: 5 % of them decide."""
    rng, n = np.random.default_rng(6), 45_000
    x = rng.normal(size=(n, width)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert permutation_index.SHARE * n > permutation_index.CANDIDATES
    vecs = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float32()))
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(n)), "embedding": vecs}))
    got = {}
    for r in permutation_index.search(df, F.pmod(F.col("vec_id"), F.lit(750)) == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q, ids in got.items():
        apart = ((x - x[q]) ** 2).sum(axis=1)
        apart[q] = np.inf
        hits.append(len(ids & set(np.argsort(apart)[:10].tolist())) / 10)
    print(f"recall at width {width}: {np.mean(hits):.3f}")
    assert len(got) == 60 and np.mean(hits) >= least


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 5.0]), (1, [3.0, 0.0]), (1, [1.0, 1.0]), (1, [3.0, 0.0]), (2, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = permutation_index.search(df, F.col("vec_id") == 0, k=10).collect()
    got = [(r.vec_id, round(r.score, 9)) for r in sorted(found, key=lambda r: r.rank)]
    # the query is the least vector of id 0, [0, 5]
    at = lambda x, y: round(math.hypot(x, y - 5), 9)
    assert got == [(2, at(1, 2)), (1, at(1, 1)), (1, at(3, 0)), (1, at(3, 0))]
    assert [r.rank for r in sorted(found, key=lambda r: r.rank)] == [1, 2, 3, 4]
