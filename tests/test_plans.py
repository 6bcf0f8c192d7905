"""Physical-plan shape: the scale properties the design relies on."""

import re

import pytest

from stratum.plans import collisions as C
from stratum.plans.registry import feed, table
from stratum.sources.incremental import incremental_window, load_window

from paths import SF001


def executed(df) -> str:
    """The plan that ran: an action on the frame itself, and of an adaptive plan its final part."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "AdaptiveSparkPlan" not in plan:
        return plan
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stg(spark):
    return C.staging(C.silver(feed(spark, SF001), wall_clock=False))


def test_silver_has_one_key_shuffle_with_partial_top1(spark):
    plan = executed(C.silver(feed(spark, SF001), wall_clock=False))
    keyed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(keyed) == 1 and keyed[0].startswith("collision_id")
    # partial top-1 per id runs before the exchange, final after it
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    # only the four lineitem columns the feed needs are read
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,"
                     r"l_shipdate:timestamp_ntz>", plan)


def test_fact_broadcasts_only_the_calendar(spark, stg):
    g = C.Gold(spark, stg)
    plan = executed(g.fact)
    assert plan.count("BroadcastExchange") == 1 and "BroadcastHashJoin" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1   # the dedupe only


def test_rollups_aggregate_by_key_before_any_exchange(spark, stg):
    g = C.Gold(spark, stg)
    for df in (g.borough, g.monthly):
        plan = executed(df)
        # every key exchange of the fact branch is preceded by a partial aggregate
        assert "Exchange hashpartitioning(date_sk" in plan or "Exchange hashpartitioning(location_sk" in plan
        assert "partial_count" in plan or "partial_sum" in plan


def test_window_filter_reaches_the_scan(spark):
    start, end = load_window("2024-01-25", mark="2024-01-10")
    plan = executed(incremental_window(table(spark, SF001, "events"), "ts", start, end))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_checks_fold_row_level_rules_into_one_scan(spark, stg):
    from stratum.operators import checks as Q
    checks = [Q.not_null("collision_id"), Q.not_null("crash_date"),
              Q.expression_is_true("total_injuries", ">= 0"),
              Q.accepted_values("borough", C.BOROUGHS, where="borough is not null")]
    plan = executed(Q.check_counts(stg, checks, "stg"))
    assert len(re.findall(r"FileScan parquet", plan)) == 1
