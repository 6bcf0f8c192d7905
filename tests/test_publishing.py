"""All published names move together, by one pointer."""

import pytest

from stratum.sinks import publishing as P


def build_of(spark, base, number, names=("a", "b", "c", "d"), rows=None, extra=None):
    """Tables of one build: a, b, c plain and d by day, all of them with the build's number in every row."""
    tables = {}
    for name in names:
        df = spark.range(rows or number * 10).selectExpr("id", f"{number} as n", "cast(id % 3 as string) as day")
        if extra:
            df = df.selectExpr("*", extra)
        path = f"{base}/{number}/{name}"
        if name == "d":
            df.write.partitionBy("day").parquet(path)
            tables[name] = P.stored_table(spark, df, path, "day")
        else:
            df.write.parquet(path)
            tables[name] = P.stored_table(spark, df, path)
    return tables


def shown(spark, prefix, names=("a", "b", "c", "d")):
    return {name: {r.n for r in spark.table(f"{prefix}{name}").select("n").distinct().collect()} for name in names}


def test_a_publish_that_fails_half_way_leaves_all_names_on_one_build(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    P.publish_build(spark, "fi_", "build1", build_of(spark, base, 1), f"{base}/1")
    assert shown(spark, "fi_") == {n: {1} for n in "abcd"}
    second = build_of(spark, base, 2)
    for step, fails_at in (("_add_build", 3), ("_show", 3), ("_move_pointer", 1)):
        calls, real = [], getattr(P, step)

        def failing(*args):
            calls.append(args)
            if len(calls) >= fails_at:
                raise RuntimeError("killed")
            return real(*args)
        with monkeypatch.context() as patch:
            patch.setattr(P, step, failing)
            with pytest.raises(RuntimeError):
                P.publish_build(spark, "fi_", "build2", second, f"{base}/2")
        assert shown(spark, "fi_") == {n: {1} for n in "abcd"} and P.published_build(spark, "fi_") == "build1"
    P.publish_build(spark, "fi_", "build2", second, f"{base}/2")      # done again, it goes through
    assert shown(spark, "fi_") == {n: {2} for n in "abcd"} and P.published_build(spark, "fi_") == "build2"
    assert {spark.table(f"fi_{n}").count() for n in "abcd"} == {20}


def test_a_first_publish_that_fails_shows_no_rows(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    tables = build_of(spark, base, 1)
    with monkeypatch.context() as patch:
        patch.setattr(P, "_move_pointer", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            P.publish_build(spark, "first_", "build1", tables, f"{base}/1")
    assert P.published_build(spark, "first_") is None and spark.table("first_d").count() == 0


def test_queries_read_the_published_build_only(spark, tmp_path):
    base = str(tmp_path)
    for k in (1, 2):
        P.publish_build(spark, "pr_", f"build{k}", build_of(spark, base, k, ("d",)), f"{base}/{k}")
    files = spark.sql("select distinct input_file_name() as f from pr_d where day = '1'").collect()
    assert files and all("/2/d/day=1/" in r.f for r in files)
    plan = spark.table("pr_d")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(build" in plan and "Subquery" in plan


def test_columns_may_come_but_not_change_their_type(spark, tmp_path):
    base = str(tmp_path)
    P.publish_build(spark, "col_", "build1", build_of(spark, base, 1), f"{base}/1")
    P.publish_build(spark, "col_", "build2", build_of(spark, base, 2, extra="'new' as lane"), f"{base}/2")
    assert {r.lane for r in spark.table("col_d").collect()} == {"new"}
    P.publish_build(spark, "col_", "build3", build_of(spark, base, 3), f"{base}/3")      # and go: NULL
    assert {r.lane for r in spark.table("col_a").collect()} == {None} and shown(spark, "col_")["d"] == {3}
    changed = build_of(spark, base, 4, extra="5 as lane")
    with pytest.raises(ValueError, match="lane was string and is now int"):
        P.publish_build(spark, "col_", "build4", changed, f"{base}/4")
    assert shown(spark, "col_") == {n: {3} for n in "abcd"}


def test_names_published_as_tables_before_become_views(spark, tmp_path):
    base = str(tmp_path)
    spark.range(3).write.parquet(f"{base}/old")
    spark.sql(f"CREATE TABLE was_a USING parquet LOCATION '{base}/old'")
    P.publish_build(spark, "was_", "build1", build_of(spark, base, 1, ("a",)), f"{base}/1")
    assert spark.table("was_a").count() == 10 and spark.read.parquet(f"{base}/old").count() == 3


def test_a_forgotten_build_leaves_the_tables(spark, tmp_path):
    base = str(tmp_path)
    for k in (1, 2):
        P.publish_build(spark, "fg_", f"build{k}", build_of(spark, base, k), f"{base}/{k}")
    P.forget_build(spark, f"{base}/1", list("abcd"))
    for name in "abcd":
        assert {r.build for r in spark.table(f"fg_{name}__builds").select("build").distinct().collect()} == {"build2"}
    assert shown(spark, "fg_") == {n: {2} for n in "abcd"}


def test_odd_partition_values(spark, tmp_path):
    rows = spark.createDataFrame([(1, "01001"), (2, "a b/c=d'e"), (3, None), (4, "é%")], "n int, zip string")
    rows.write.partitionBy("zip").parquet(str(tmp_path / "1" / "z"))
    table = P.stored_table(spark, rows, str(tmp_path / "1" / "z"), "zip")
    P.publish_build(spark, "odd_", "it's build 1", {"z": table}, str(tmp_path / "1"))
    assert sorted((r.n, r.zip) for r in spark.table("odd_z").collect()) == [
        (1, "01001"), (2, "a b/c=d'e"), (3, None), (4, "é%")]
