"""Hand-written edge rows with literal expectations (silver rules)."""

import datetime as dt

from stratum.plans import collisions as C


def _silver(raw_rows, rows):
    return {r.collision_id: r for r in C.silver(raw_rows(rows), wall_clock=False).collect()}


def test_time_composition(raw_rows):
    rows = [
        {"collision_id": "1", "crash_date": "2024-01-15T00:00:00.000", "crash_time": "3:10"},
        {"collision_id": "2", "crash_date": "2024-01-15T00:00:00.000", "crash_time": "03:10"},
        {"collision_id": "3", "crash_date": "2024-01-15T00:00:00.000"},
        {"collision_id": "4", "crash_date": "2024-01-15T00:00:00.000", "crash_time": ""},
        {"collision_id": "5", "crash_date": "2024-01-15T00:00:00.000", "crash_time": " 23:59 "},
    ]
    out = _silver(raw_rows, rows)
    assert out["1"].crash_datetime == dt.datetime(2024, 1, 15, 3, 10)
    assert out["2"].crash_datetime == dt.datetime(2024, 1, 15, 3, 10)
    assert out["3"].crash_datetime == dt.datetime(2024, 1, 15, 0, 0)
    assert out["4"].crash_datetime == dt.datetime(2024, 1, 15, 0, 0)
    assert out["5"].crash_datetime == dt.datetime(2024, 1, 15, 23, 59)
    assert out["5"].crash_time == "23:59"


def test_unparsable_times_keep_the_row(raw_rows):
    bad = ["24:00", "25:00", "12:60", "3:10:00", "3:1", "x"]
    rows = [{"collision_id": str(i), "crash_date": "2024-01-15", "crash_time": t}
            for i, t in enumerate(bad)]
    out = _silver(raw_rows, rows)
    assert len(out) == len(bad)
    assert all(r.crash_datetime is None for r in out.values())


def test_blank_time_stays_empty_string(raw_rows):
    out = _silver(raw_rows, [{"collision_id": "1", "crash_date": "2024-01-15", "crash_time": "   "}])
    assert out["1"].crash_time == ""


def test_zero_coordinates_are_independent(raw_rows):
    out = _silver(raw_rows, [{"collision_id": "1", "crash_date": "2024-01-15",
                              "latitude": "0", "longitude": "-73.9"}])
    assert out["1"].latitude is None and out["1"].longitude == -73.9


def test_bad_counts_become_null_and_add_zero(raw_rows):
    out = _silver(raw_rows, [{"collision_id": "1", "crash_date": "2024-01-15",
                              "number_of_persons_injured": "-1",
                              "number_of_pedestrians_injured": "x",
                              "number_of_cyclist_injured": "2",
                              "number_of_motorist_killed": "1"}])
    r = out["1"]
    assert r.persons_injured is None and r.pedestrians_injured is None
    assert r.motorists_injured is None
    assert r.total_injuries == 2 and r.total_fatalities == 1
    assert r.has_injuries is True and r.has_fatalities is True


def test_id_filter(raw_rows):
    rows = [{"collision_id": None, "crash_date": "2024-01-15"},
            {"collision_id": "None", "crash_date": "2024-01-15"},
            {"collision_id": "", "crash_date": "2024-01-15"},
            {"collision_id": "7"}]
    out = _silver(raw_rows, rows)
    assert set(out) == {""}


def test_filter_runs_before_dedupe(raw_rows):
    old = dt.datetime(2024, 1, 1)
    new = dt.datetime(2024, 1, 2)
    out = _silver(raw_rows, [
        {"collision_id": "9", "crash_date": "2024-01-15", "borough": "queens", "_ingestion_timestamp": old},
        {"collision_id": "9", "crash_date": None, "borough": "bronx", "_ingestion_timestamp": new},
    ])
    assert out["9"].borough == "QUEENS"


def test_latest_load_wins_and_ties_go_to_larger_fingerprint(spark, raw_rows):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    out = _silver(raw_rows, [
        {"collision_id": "9", "crash_date": "2024-01-15", "borough": "queens", "_ingestion_timestamp": old},
        {"collision_id": "9", "crash_date": "2024-01-15", "borough": "bronx", "_ingestion_timestamp": new},
    ])
    assert out["9"].borough == "BRONX"
    tied = [{"collision_id": "8", "crash_date": "2024-01-15", "zip_code": z} for z in ("10001", "10002")]
    raw = raw_rows(tied)
    fps = sorted(r[0] for r in C.typed(raw).select(C.FINGERPRINT).collect())
    winner = C.typed(raw).where(f"{C.FINGERPRINT} = '{fps[-1]}'").first().zip_code
    assert _silver(raw_rows, tied)["8"].zip_code == winner


def test_string_rules(raw_rows):
    out = _silver(raw_rows, [{
        "collision_id": "1", "crash_date": "2024-01-15", "borough": "  staten island ",
        "zip_code": " ", "contributing_factor_vehicle_1": " driver inattention/DISTRACTION ",
        "contributing_factor_vehicle_2": "", "vehicle_type_code1": " Taxi",
        "vehicle_type_code2": "", "on_street_name": " broadway 7 "}])
    r = out["1"]
    assert r.borough == "STATEN ISLAND"
    assert r.zip_code is None
    assert r.contributing_factor_vehicle_1 == "Driver Inattention/distraction"
    assert r.contributing_factor_vehicle_2 is None
    assert r.vehicle_type_code1 == "TAXI" and r.vehicle_type_code2 is None
    assert r.on_street_name == "BROADWAY 7"


def test_month_without_injuries_has_null_average(spark, raw_rows):
    raw = raw_rows([{"collision_id": str(i), "crash_date": "2024-03-0%d" % (i + 1),
                     "number_of_persons_injured": "0"} for i in range(3)])
    g = C.Gold(spark, C.staging(C.silver(raw, wall_clock=False)))
    (m,) = g.monthly.collect()
    assert m.total_collisions == 3 and m.total_injuries == 0
    assert m.avg_injuries_per_crash is None
    assert m.month_start_date == "2024-03-01" and m.month_name == "March"


def test_undated_fact_absent_from_monthly_present_in_borough(spark, raw_rows):
    raw = raw_rows([
        {"collision_id": "1", "crash_date": "2019-05-05", "borough": "queens"},
        {"collision_id": "2", "crash_date": "2024-05-05", "borough": "queens"},
    ])
    g = C.Gold(spark, C.staging(C.silver(raw, wall_clock=False)))
    facts = {r.collision_id: r.date_sk for r in g.fact.collect()}
    assert facts == {"1": None, "2": 20240505}
    assert sum(r.total_collisions for r in g.monthly.collect()) == 1
    (b,) = g.borough.collect()
    assert b.borough == "QUEENS" and b.total_collisions == 2


def test_total_columns_are_a_parameter(raw_rows):
    raw = raw_rows([{"collision_id": "1", "crash_date": "2024-01-15",
                     "number_of_persons_injured": "3", "number_of_pedestrians_injured": "1"}])
    (r,) = C.silver(raw, wall_clock=False, injury_columns=["persons_injured"]).collect()
    assert r.total_injuries == 3
    (r,) = C.silver(raw, wall_clock=False).collect()
    assert r.total_injuries == 4
