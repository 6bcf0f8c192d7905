"""Operator-level tests: incremental window, mark, paging, spine, keys, rollups, checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.functions.columns import compose_timestamp, rate_per_100, surrogate_key
from stratum.operators import checks as Q
from stratum.operators.dimension import date_spine, spine_length
from stratum.operators.rollup import Measure, bounded_broadcast, rollup_through_dimension
from stratum.plans import collisions as C
from stratum.sources.incremental import (
    high_water_mark,
    incremental_window,
    load_window,
    page,
    page_numbers,
    read_page_index,
    write_page_index,
)

from paths import SF001


# --- L1 / L2 -----------------------------------------------------------------------------------

def test_load_window_rules():
    today = dt.date(2024, 1, 25)
    start, end = load_window(today)
    assert end == dt.datetime(2024, 1, 24, 23, 59, 59)
    assert start == dt.datetime(2023, 1, 25)
    assert load_window(today, mark="2024-01-10") == (dt.datetime(2024, 1, 10), end)
    assert load_window(today, mark="2024-01-10", full_reload=True)[0] == dt.datetime(2023, 1, 25)
    assert load_window(today, mark="2024-01-10", lookback_days=3)[0] == dt.datetime(2024, 1, 7)
    assert load_window(today, mark="2024-01-25") is None


def test_window_is_half_open_and_pushed_down(spark):
    rows = [(1, dt.datetime(2024, 1, 10)), (2, dt.datetime(2024, 1, 10, 0, 0, 1)),
            (3, dt.datetime(2024, 1, 24, 23, 59, 59)), (4, dt.datetime(2024, 1, 24, 23, 59, 59, 500000))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    got = incremental_window(df, "ts", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 24, 23, 59, 59))
    assert sorted(r.id for r in got.collect()) == [2, 3]
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    plan = incremental_window(ev, "ts", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "GreaterThan(ts" in text


def test_high_water_mark_cases(spark):
    end = dt.datetime(2024, 1, 24, 23, 59, 59)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 12, 5),), (None,)], "ts timestamp_ntz")
    (r,) = high_water_mark(df, "ts", end, old_mark="2024-01-10").collect()
    assert (r.batch_rows, r.new_mark) == (2, dt.date(2024, 1, 12))
    empty = df.where("false")
    (r,) = high_water_mark(empty, "ts", end, old_mark="2024-01-10").collect()
    assert (r.batch_rows, r.new_mark) == (0, dt.date(2024, 1, 24))
    nulls = df.where("ts is null")
    (r,) = high_water_mark(nulls, "ts", end, old_mark="2024-01-10").collect()
    assert (r.batch_rows, r.new_mark) == (1, dt.date(2024, 1, 10))


# --- L3 ------------------------------------------------------------------------------------------

def test_page_numbers_match_global_row_number(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey", "o_orderdate")
    got = page_numbers(orders, ["o_orderdate", "o_orderkey"], size=700, partitions=5)
    brute = sorted(orders.collect(), key=lambda r: (r.o_orderdate, r.o_orderkey))
    expect = {r.o_orderkey: i + 1 for i, r in enumerate(brute)}
    rows = got.collect()
    assert len(rows) == len(brute)
    assert all(r.row_no == expect[r.o_orderkey] and r.page_no == (r.row_no - 1) // 700 for r in rows)


def test_page_numbers_split_a_hot_day(spark):
    # one day holds a third of all rows: it must spread over several range partitions
    day0 = dt.date(2024, 1, 1)
    rows = [(i, day0 if i % 3 == 0 else day0 + dt.timedelta(days=1 + i % 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, d date")
    got = page_numbers(df, ["d", "k"], size=100, partitions=8)
    per_part = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_part) < 1000
    assert sorted(r.row_no for r in got.collect()) == list(range(1, 3001))


def test_ordered_page(spark):
    df = spark.range(0, 25).withColumn("g", F.lit(1))
    assert [r.id for r in page(df, ["id"], size=10, n=2).collect()] == list(range(20, 25))
    # numbered pages return the same rows in the same order, whatever the columns are called
    deep = page(df.withColumnRenamed("g", "row_no"), ["id"], size=10, n=1, strategy="numbered")
    assert deep.columns == ["id", "row_no"]
    assert [r.id for r in deep.collect()] == list(range(10, 20))
    assert page(df, ["id"], size=10, n=9, strategy="numbered").collect() == []
    with pytest.raises(ValueError):
        page_numbers(df.withColumnRenamed("g", "row_no"), ["id"])


def test_registered_orders(spark):
    from stratum.plans import registry as R
    sf = "/root/testdata/sf0.01"
    for name in ("ordered_page", "deep_page"):
        rows = [(r.ts, r.event_id) for r in R.QUERIES[name](spark, sf).collect()]
        assert len(rows) == 1000 and rows == sorted(rows)
    months = [(r.year, r.month) for r in R.q_monthly_metrics(spark, sf).collect()]
    assert len(months) > 1 and months == sorted(months)
    totals = [r.total_collisions for r in R.q_borough_metrics(spark, sf).collect()]
    assert len(totals) > 1 and totals == sorted(totals, reverse=True)


def test_fingerprints_of_different_rows_differ(spark):
    from stratum.functions.columns import row_fingerprint
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("~", "x"), ("", "x"), ("1:a", ""), ("a", "1:")]
    df = spark.createDataFrame(rows, "p string, q string")
    assert df.select(row_fingerprint("p", "q").alias("f")).distinct().count() == len(rows)


def test_fingerprints_look_up_the_lengths_of_short_values(spark):
    import hashlib
    from stratum.functions.columns import row_fingerprint
    values = [None, "", "a", "é€𐍈", "a|b", ",", "x" * 9, "x" * 63, "x" * 64, "é" * 65, "x" * 1000]
    rows = [(p, q) for p in values for q in values]
    df = spark.createDataFrame(rows, "p string, q string")
    made = df.select("p", "q", row_fingerprint("p", "q").alias("f"))
    for p, q, f in made.collect():
        text = "|".join("~" if v is None else f"{len(v)}:{v}" for v in (p, q))
        assert f == hashlib.md5(text.encode()).hexdigest()
    # constant texts, so no length is written out for a short value
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "[0:,1:,2:" in plan and "[|0:,|1:,|2:" in plan and "split(" not in plan


def test_lookup_is_broadcast_only_with_a_known_length(spark):
    from stratum.plans import collisions as C
    boroughs = spark.createDataFrame([("QUEENS", 1)], "borough string, n int")
    lookup = C.borough_lookup(spark)
    hinted = C.with_borough_lookup(boroughs, lookup, 6)._jdf.queryExecution().logical().toString()
    free = C.with_borough_lookup(boroughs, lookup)._jdf.queryExecution().logical().toString()
    large = C.with_borough_lookup(boroughs, lookup, 10 ** 9)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" in hinted and "ResolvedHint" not in free and "ResolvedHint" not in large


# --- G1 / P19 / P22 -----------------------------------------------------------------------------

def test_date_spine_end_exclusive(spark):
    dd = C.dim_date(spark)
    rows = dd.agg(F.count("*"), F.min("full_date"), F.max("full_date")).first()
    assert tuple(rows) == (3286, dt.date(2022, 1, 1), dt.date(2030, 12, 30))
    assert spine_length(C.SPINE_START, C.SPINE_END) == 3286
    r = dd.where("full_date = date'2024-01-07'").first()
    assert (r.date_id, r.day_of_week, r.day_name, r.is_weekend, r.quarter, r.week_of_year) == \
        (20240107, 1, "Sunday", True, 1, 1)
    assert date_spine(spark, "2024-01-01", "2024-01-01").count() == 0


def test_surrogate_key_matches_md5_convention(spark):
    df = spark.createDataFrame([("QUEENS", None)], "b string, z string")
    (k,) = df.select(surrogate_key("b", "z")).first()
    import hashlib
    assert k == hashlib.md5(b"QUEENS-_dbt_utils_surrogate_key_null_").hexdigest()
    (k2,) = df.select(surrogate_key("b", "z", length_prefixed=True)).first()
    assert k2 != k


def test_rate_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(5, 8), (1, 3), (12023, 4390)], "s long, n long")
    got = [r[0] for r in df.select(rate_per_100("s", "n")).collect()]
    assert got == [62.5, 33.33, 273.87]


def test_compose_timestamp_is_zone_free(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 10), "2:30")], "d date, t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        (v,) = df.select(compose_timestamp("d", "t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert v == dt.datetime(2024, 3, 10, 2, 30)


def test_bounded_broadcast_needs_a_proven_bound(spark):
    df = spark.range(10)
    assert "broadcast" in bounded_broadcast(df, 10)._jdf.queryExecution().analyzed().toString().lower()
    assert bounded_broadcast(df, None) is df
    assert bounded_broadcast(df, 10**9) is df


def test_rollup_through_dimension_equals_join_then_group(spark):
    fact = spark.createDataFrame([(1, 2), (1, 3), (2, 0), (3, 5), (None, 1)], "fk int, v int")
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (4, "b")], "pk int, g string")
    ms = [Measure("n", "count"), Measure("s", "sum", "v"), Measure("pos", "count_if", F.col("v") > 0),
          Measure("avg_pos", "avg", F.when(F.col("v") > 0, F.col("v")))]
    got = rollup_through_dimension(fact, dim, "fk", "pk", [F.coalesce("g", F.lit("?")).alias("g")], ms)
    joined = fact.join(dim, fact.fk == dim.pk, "left").groupBy(F.coalesce("g", F.lit("?")).alias("g"))
    expect = joined.agg(*[m.direct() for m in ms])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))
    inner = rollup_through_dimension(fact, dim, "fk", "pk", [F.col("g")], ms, how="inner")
    assert {r.g: r.n for r in inner.collect()} == {"a": 3}


# --- Q1-Q7 -------------------------------------------------------------------------------------

def test_check_semantics(spark):
    df = spark.createDataFrame(
        [(1, "A", 5), (2, "B", -1), (2, "Z", None), (None, None, 3), (4, "Y", 0), (5, "Y", 1)],
        "id int, code string, v int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    checks = [Q.not_null("id"), Q.unique("id"), Q.accepted_values("code", ["A", "B"]),
              Q.accepted_values("code", ["A", "B"], where="v > 0", name="av_scoped"),
              Q.expression_is_true("v", ">= 0"), Q.relationships("id", parent, "pk"),
              Q.relationships("id", parent, "pk", where="v > 3", name="rel_scoped")]
    got = {r.check_name: r.failures for r in Q.check_counts(df, checks, "t").collect()}
    assert got == {
        "not_null_t_id": 1,                    # one NULL id
        "unique_t_id": 1,                      # id 2 repeats (one duplicated value)
        "accepted_values_t_code": 2,           # distinct bad values 'Z' and 'Y'; NULL passes
        "av_scoped": 1,                        # only 'Y' (v = 1) is in scope
        "expression_is_true_t_v_ge_0": 1,      # v = -1 fails, NULL passes
        "relationships_t_id": 2,               # ids 4 and 5 have no parent; NULL passes
        "rel_scoped": 0,                       # only id 1 (v = 5) is in scope
    }


def test_run_checks_stores_failing_rows_then_raises(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,), (None,)], "id int")
    with pytest.raises(Q.ChecksFailed) as err:
        Q.run_checks({"t": (df, [Q.not_null("id")])}, audit_path=str(tmp_path))
    assert err.value.failures == [("t", "not_null_t_id", 2)]
    assert spark.read.parquet(str(tmp_path / "not_null_t_id")).count() == 2
    ok = Q.run_checks({"t": (df.where("id is not null"), [Q.not_null("id")])})
    assert ok.first().failures == 0


def test_row_level_checks_share_one_aggregate(spark):
    df = spark.range(100).withColumn("v", F.col("id") - 5)
    checks = [Q.not_null("id"), Q.expression_is_true("v", ">= 0"), Q.accepted_values("id", [1, 2])]
    plan = Q.check_counts(df, checks, "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") <= 1 or plan.count("Range") == 1


def test_cluster_conf_sizes_partitions():
    from stratum.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (512 * 1024 ** 2))
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "200"
    assert conf["spark.sql.codegen.hugeMethodLimit"] == "8000"


def test_relationship_failing_rows_are_the_orphans(spark, tmp_path):
    child = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (None, "d"), (4, "e")], "fk int, x string")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    check = Q.relationships("fk", parent, "pk")
    rows = sorted((r.fk, r.x) for r in Q.failing_rows(child, check).collect())
    assert rows == [(3, "b"), (3, "c"), (4, "e")]
    with pytest.raises(Q.ChecksFailed):
        Q.run_checks({"child": (child, [check])}, audit_path=str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "relationships_child_fk")).count() == 3


def test_several_unique_checks_share_one_aggregate(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "b", 3), (None, None, 3), (3, "c", 3)],
                               "x int, y string, z int")
    checks = [Q.unique("x"), Q.unique("y"), Q.unique("z"), Q.unique("x", where="z > 1", name="ux_scoped")]
    got = {r.check_name: r.failures for r in Q.check_counts(df, checks, "t").collect()}
    assert got == {"unique_t_x": 1, "unique_t_y": 1, "unique_t_z": 1, "ux_scoped": 0}
    read = Q.check_counts(df, checks[:3], "t").inputFiles()      # the keys stored by the one aggregate, not the table
    assert read and all("/check-keys-" in f for f in read) and len({f.split("/_gid=")[0] for f in read}) == 1


@pytest.fixture
def counted(spark, tmp_path):
    """(table, function that gives the rows read since it was last asked) of a table whose reads are counted."""
    rows = [(1, 10, "a", 1.0), (2, 10, "b", -1.0), (2, 99, "z", None), (None, 98, "z", -2.0), (5, None, "y", 3.0),
            (6, 99, "a", -9.0)]
    spark.createDataFrame(rows, "id int, fk int, kind string, x double").repartition(3).write.parquet(str(tmp_path / "t"))
    read = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        read.add(1)
        return True
    table = spark.read.parquet(str(tmp_path / "t")).where(seen.asNondeterministic()(F.lit(1)))

    def since():
        n, read.value = read.value, 0
        return n
    return table, since


def audit_rows(spark, path, *columns):
    return sorted((tuple(r) for r in spark.read.parquet(str(path)).select(*columns).collect()),
                  key=lambda r: tuple((x is not None, x) for x in r))


def test_failing_rows_of_all_checks_take_one_read(spark, tmp_path, counted):
    table, read_since = counted
    parent = spark.createDataFrame([(10,)], "k int")
    checks = [Q.not_null("id"), Q.not_null("fk"), Q.not_null("kind"), Q.unique("id"), Q.unique("kind", where="kind <> 'a'"),
              Q.accepted_values("kind", ["a", "b"]), Q.expression_is_true("x", ">= 0"),
              Q.expression_is_true("x", "> 0", where="id > 1"), Q.relationships("fk", parent, "k"),
              Q.relationships("id", spark.createDataFrame([(1,), (2,)], "k int"), "k", where="id < 6")]
    out = tmp_path / "audit"
    with pytest.raises(Q.ChecksFailed):
        Q.run_checks({"t": (table, checks)}, audit_path=str(out))
    assert read_since() == 3 * 6          # row-level counts, keys, and the failing rows of all of them
    names = {Q.check_name(c, "t"): c for c in checks}
    assert {p.name for p in out.iterdir()} == set(names) - {"not_null_t_kind"}
    assert audit_rows(spark, out / "not_null_t_id", "id", "fk", "kind", "x") == [(None, 98, "z", -2.0)]
    assert audit_rows(spark, out / "expression_is_true_t_x_ge_0", "x") == [(-9.0,), (-2.0,), (-1.0,)]
    assert audit_rows(spark, out / "expression_is_true_t_x_gt_0", "x") == [(-9.0,), (-1.0,)]
    assert audit_rows(spark, out / "accepted_values_t_kind", "value_field", "n_records") == [("y", 1), ("z", 2)]
    assert audit_rows(spark, out / "unique_t_id", "unique_field", "n_records") == [(2, 2)]
    assert audit_rows(spark, out / "unique_t_kind", "unique_field", "n_records") == [("z", 2)]
    assert audit_rows(spark, out / "relationships_t_fk", "id", "fk") == [(None, 98), (2, 99), (6, 99)]
    assert audit_rows(spark, out / "relationships_t_id", "id") == [(5,)]
    for name, c in names.items():           # the same as check by check
        if name != "not_null_t_kind":
            one = Q.failing_rows(table, c)
            assert audit_rows(spark, out / name, *one.columns) == sorted(
                (tuple(r) for r in one.collect()), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("number", [1, 3])
def test_one_failing_check_costs_as_much_as_many(spark, tmp_path, counted, number):
    table, read_since = counted
    checks = [Q.expression_is_true("x", "> 0"), Q.not_null("id"), Q.accepted_values("kind", ["a"])][:number]
    Q.run_checks({"t": (table, checks)}, audit_path=str(tmp_path / "audit"), raise_on_failure=False)
    assert read_since() == 2 * 6
    assert len(list((tmp_path / "audit").iterdir())) == number


def test_stored_failing_rows_of_an_earlier_run_are_replaced(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "id int, v string")
    checks = [Q.not_null("id"), Q.accepted_values("v", ["a"]), Q.unique("id")]
    for rows, want in (([(None, "a"), (None, "b"), (1, "a"), (1, "c")], 2), ([(None, "a"), (2, "b"), (2, "a")], 1)):
        Q.run_checks({"t": (make(rows), checks)}, audit_path=str(tmp_path), raise_on_failure=False)
        assert spark.read.parquet(str(tmp_path / "not_null_t_id")).count() == want
    assert audit_rows(spark, tmp_path / "accepted_values_t_v", "value_field", "n_records") == [("b", 1)]
    assert audit_rows(spark, tmp_path / "unique_t_id", "unique_field") == [(2,)]


def test_a_page_is_read_from_its_own_files(spark, tmp_path):
    """Numbered once; every page, shallow or deep, reads the parts that it lies in and no others."""
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as int) as g", "cast('2024-01-01' as date) as hot_day",
                                      "case when id % 5 = 0 then null else concat('t', id) end as t")
    index = write_page_index(df.repartition(5), ["hot_day", "g", "id"], str(tmp_path / "pages"), size=90, partitions=6)
    assert index == read_page_index(spark, str(tmp_path / "pages"))
    assert index.total == 1000 and index.pages == 12 and len(index.rows) > 3      # one day, yet several parts
    want = [tuple(r) for r in df.orderBy("hot_day", "g", "id").collect()]
    seen = []
    for n in range(index.pages):
        got = index.page(spark, n)
        assert got.columns == df.columns
        seen += [tuple(r) for r in got.collect()]
        touched = {f.split("/__part=")[1].split("/")[0] for f in got.inputFiles()}
        assert touched == {str(k) for k, _, _ in index.parts_of(n)} and len(touched) <= 2
    assert seen == want
    assert index.page(spark, 12).collect() == [] and index.page(spark, 99).columns == df.columns
    plan = index.page(spark, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "__at" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_page_index_of_an_empty_table_and_of_a_killed_write(spark, tmp_path, monkeypatch):
    from stratum.sources import incremental
    df = spark.range(20).selectExpr("id", "id as size")
    none = write_page_index(df.limit(0), ["id"], str(tmp_path / "none"), size=5)
    assert none.pages == 0 and none.page(spark, 0).collect() == []
    monkeypatch.setattr(incremental, "put_new_file", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        write_page_index(df, ["id"], str(tmp_path / "half"), size=5)
    with pytest.raises(Exception, match="does not exist|FileNotFound"):
        read_page_index(spark, str(tmp_path / "half"))
