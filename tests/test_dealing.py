"""Large row groups are dealt over several tasks, and the rows that the dedupe sorts are narrow."""

import datetime as dt

from pyspark.sql import functions as F

from stratum.plans import collisions as C
from stratum.plans import registry as R
from stratum.sources import dealing
from stratum.sources.raw import RAW_COLUMNS
from stratum.sources.adapter import collisions_feed


def _lineitem(spark, folder, n):
    day = dt.datetime(1996, 1, 1)
    rows = [(i * 7 % 400, i * 13 % 900, i * 5 % 70, day + dt.timedelta(days=i % 300)) for i in range(n)] + [(None,) * 4] * 3
    (spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp_ntz")
     .coalesce(1).write.parquet(f"{folder}/lineitem.parquet"))
    return f"{folder}/lineitem.parquet"


def _sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_a_large_row_group_is_dealt_in_runs(spark, tmp_path, monkeypatch):
    path = _lineitem(spark, tmp_path, 4000)
    monkeypatch.setattr(dealing, "MAX_ROWS_A_TASK", 1000)
    monkeypatch.setattr(dealing, "RUN_BITS", 7)
    dealt = R.feed(spark, str(tmp_path))
    sizes = _sizes(dealt)
    assert len(sizes) > 8 and max(sizes) <= 1000 and sum(sizes) == 4003
    plain = collisions_feed(spark.read.parquet(path))
    assert dealt.exceptAll(plain).count() == 0 and plain.exceptAll(dealt).count() == 0
    assert C.silver(dealt, wall_clock=False).exceptAll(C.silver(plain, wall_clock=False)).count() == 0


def test_small_and_empty_tables_are_left_as_they_are(spark, tmp_path):
    df = spark.read.parquet(_lineitem(spark, tmp_path, 100))
    assert dealing.deal_large_parts(df) is df
    empty = df.limit(0)
    assert dealing.deal_large_parts(empty, most=1) is empty


def test_rows_are_sorted_with_numbers_and_a_fingerprint_of_16_bytes(spark):
    raw = spark.createDataFrame(
        [tuple("2024-01-0%d" % i if c == "crash_date" else "x" if c == "latitude" else str(i) for c in RAW_COLUMNS)
         + (dt.datetime(2024, 1, i),) for i in (1, 2)],
        ", ".join(f"{c} string" for c in RAW_COLUMNS) + f", {C.INGESTION_TS} timestamp_ntz")
    df = C.sortable(raw)
    kinds = dict(df.dtypes)
    assert kinds["crash_date"] == "date" and kinds["latitude"] == "double" and kinds[C.FINGERPRINT] == "binary"
    assert all(kinds[c] == "int" for c, _ in C.COUNT_COLUMNS)
    assert [len(r[0]) for r in df.select(C.FINGERPRINT).collect()] == [16, 16]
    hexed = sorted(r[0] for r in C.typed(raw).select(C.FINGERPRINT).collect())
    assert [bytes(r[0]).hex() for r in df.select(C.FINGERPRINT).orderBy(C.FINGERPRINT).collect()] == hexed


def test_runs_of_one_row_group_are_dealt_evenly(spark, tmp_path):
    df = spark.read.parquet(_lineitem(spark, tmp_path, 4000))
    sizes = _sizes(dealing.deal_large_parts(df, most=1000, run_bits=7))
    assert sorted(sizes) == [4003 % 128] + [128] * 31


def test_runs_share_tasks_up_to_the_most_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dealing, "TASKS", 8)
    df = spark.read.parquet(_lineitem(spark, tmp_path, 4000))
    eight = dealing.deal_large_parts(df, most=1000, run_bits=5)          # 126 runs, 15 or 16 a task
    assert len(_sizes(eight)) == 8 and max(_sizes(eight)) <= 16 * 32
    more = dealing.deal_large_parts(df, most=200, run_bits=5)            # 8 tasks would get more than 200 rows
    assert len(_sizes(more)) == 21 and max(_sizes(more)) <= 200
    for dealt in (eight, more):
        assert dealt.exceptAll(df).count() == 0 and df.exceptAll(dealt).count() == 0


def test_parts_of_unlike_sizes_are_dealt_over_all_tasks(spark):
    parts = [spark.range(0, 3200, 1, 1)] + [spark.range(10_000 + 32 * i, 10_032 + 32 * i, 1, 1) for i in range(20)]
    df = parts[0]
    for p in parts[1:]:
        df = df.union(p)
    dealt = dealing.deal_large_parts(df, most=1000, run_bits=5)          # 100 runs of one part, one each of 20
    sizes = _sizes(dealt)
    assert sum(sizes) == 3840 and max(sizes) <= 2 * 32
    assert dealt.distinct().count() == 3840 and dealt.exceptAll(df).count() == 0
