"""Property tests against brute force on random data (hot keys included)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators.dedupe import dedupe_latest
from stratum.operators.rollup import Measure, rollup_through_dimension
from stratum.sources.incremental import page_numbers

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),   # key, hot and NULL included
                             st.integers(0, 5), st.integers(-3, 3)),
                   min_size=1, max_size=60)


@SETTINGS
@given(rows_st)
def test_dedupe_latest_matches_brute_force(spark, rows):
    data = [(k, t, v, i) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, t int, v int, uid int")
    got = dedupe_latest(df, ["k"], [F.col("t").desc(), F.col("uid").desc()]).collect()
    best = {}
    for k, t, v, i in data:
        if k not in best or (t, i) > (best[k][1], best[k][3]):
            best[k] = (k, t, v, i)
    assert sorted(map(tuple, got), key=str) == sorted(best.values(), key=str)


@SETTINGS
@given(rows_st, st.sampled_from(["left", "inner"]))
def test_rollup_through_dimension_matches_join_then_group(spark, rows, how):
    fact = spark.createDataFrame(rows, "fk string, t int, v int")
    dim = spark.createDataFrame([("a", "G1"), ("b", "G1"), ("d", "G2")], "pk string, g string")
    ms = [Measure("n", "count"), Measure("s", "sum", "v"),
          Measure("c", "count_if", F.col("v") > 0), Measure("m", "avg", "t")]
    group = [F.coalesce("g", F.lit("?")).alias("g")]
    got = rollup_through_dimension(fact, dim, "fk", "pk", group, ms, how=how)
    direct = fact.join(dim, fact.fk == dim.pk, how).groupBy(*group).agg(*[m.direct() for m in ms])

    def norm(df):
        return sorted((r.g, r.n, r.s, r.c, None if r.m is None else round(r.m, 9)) for r in df.collect())
    assert norm(got) == norm(direct)


@SETTINGS
@given(st.lists(st.integers(0, 4), min_size=1, max_size=80), st.integers(1, 7), st.integers(1, 6))
def test_page_numbers_match_sorted_position(spark, days, size, parts):
    data = [(d, i) for i, d in enumerate(days)]
    df = spark.createDataFrame(data, "d int, k int")
    got = {r.k: (r.row_no, r.page_no) for r in page_numbers(df, ["d", "k"], size, parts).collect()}
    for pos, (d, k) in enumerate(sorted(data)):
        assert got[k] == (pos + 1, pos // size)
