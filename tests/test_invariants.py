"""Invariants of the built star schema (sf0.01) and the reference data tests on our gold."""

import pytest
from pyspark.sql import functions as F

from stratum.operators.checks import run_checks
from stratum.plans import collisions as C
from stratum.plans.registry import feed

from paths import SF001


@pytest.fixture(scope="module")
def gold(spark):
    return C.Gold(spark, C.staging(C.silver(feed(spark, SF001), wall_clock=False)), materialize=True)


def test_expected_sizes(gold):
    assert gold.stg.count() == 14306
    assert (gold.dim_location.count(), gold.dim_vehicle.count()) == (76, 75)
    assert gold.fact.where("date_sk is null").count() == 161
    assert gold.monthly.count() == 83


def test_one_row_per_id(gold):
    assert gold.stg.groupBy("collision_id").count().where("count > 1").count() == 0


def test_every_fact_key_resolves(gold):
    for fk, dim, pk in [("location_sk", gold.dim_location, "location_sk"),
                        ("vehicle_sk", gold.dim_vehicle, "vehicle_sk")]:
        assert gold.fact.join(dim, gold.fact[fk] == dim[pk], "left_anti").count() == 0


def test_rollups_add_up(gold):
    n = gold.fact.count()
    b = gold.borough.agg(F.sum("total_collisions"), F.sum("total_injuries")).first()
    f = gold.fact.agg(F.sum("total_injuries")).first()
    assert b[0] == n and b[1] == f[0]
    dated = gold.fact.where("date_sk is not null").count()
    assert gold.monthly.agg(F.sum("total_collisions")).first()[0] == dated
    unknown = gold.borough.where("borough = 'Unknown'").first()
    assert (unknown.total_collisions, unknown.total_injuries, unknown.injury_rate_per_100) == \
        (4396, 12037, 273.82)


def test_reference_data_tests_pass_on_gold(gold):
    counts = run_checks(gold.check_suite())
    assert counts.count() == 53


def test_rollups_do_not_shuffle_the_fact(gold):
    # the stored rollup is a scan; look at the plan that made it
    plan = C.borough_metrics(gold.fact, gold.dim_location)._jdf.queryExecution().executedPlan().toString()
    # the fact is partially aggregated by key before any exchange
    assert "HashAggregate" in plan and "partial_count" in plan
