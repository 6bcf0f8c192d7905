"""Driver tables -> raw incident feed.

No collision table exists in the test data, so one raw record is derived from every
``lineitem`` row (k = l_orderkey, p = l_partkey, s = l_suppkey). The rules inject the dirt
the silver layer must clean: NULL / 'None' ids, missing dates, bad and padded times, blank
and mixed-case text, zero coordinates, negative and non-numeric counts, duplicate ids with
tied load times. The load time is the ship date. Pure column arithmetic: one projection over
the scan, work grows with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.sources.raw import INGESTION_TS

# --- fixed values: literal texts of the adapter rules ------------------------------------
BOROUGH_BY_S7 = [None, "  ", " bronx", "Brooklyn ", "MANHATTAN", "queens", "Staten Island"]
FACTOR1_BY_P3 = [" driver inattention/DISTRACTION ", "", "Unspecified"]
FACTOR2_BY_S3 = ["unsafe speed", None, " "]
VEHICLE1_BY_P4 = ["sedan", " Taxi", "pick-up truck", ""]
VEHICLE2_BY_S4 = ["suv", None, "BIKE ", ""]
DATE_SHIFT_DAYS = 9862
# -----------------------------------------------------------------------------------------


def _pick(idx: Column, values) -> Column:
    """values[idx] for a small literal list (NULL entries stay NULL)."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        out = F.when(idx == i, lit) if out is None else out.when(idx == i, lit)
    return out


def _txt(c: Column) -> Column:
    return c.cast("string")


def _pad3(c: Column) -> Column:
    return F.lpad(_txt(c), 3, "0")


def collisions_feed(lineitem: DataFrame) -> DataFrame:
    """29 STRING columns + ``_ingestion_timestamp`` per lineitem row."""
    lineitem = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    k, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")

    def when_k(mod: int, val: str, other: str | None = "0") -> Column:
        return F.when(k % mod == 0, F.lit(val)).otherwise(F.lit(other))

    shifted = F.date_add(F.to_date(F.col("l_shipdate")),
                         F.when(k % 89 == 0, F.lit(0)).otherwise(F.lit(DATE_SHIFT_DAYS)))
    hour_min = F.concat(_txt(k % 24), F.lit(":"), F.lpad(_txt(k % 60), 2, "0"))
    time_idx = k % 7
    return lineitem.select(
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 101 == 0, F.lit("None")).otherwise(_txt(k)).alias("collision_id"),
        F.when(k % 103 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.date_format(shifted, "yyyy-MM-dd"), F.lit("T00:00:00.000")))
         .alias("crash_date"),
        F.when(time_idx == 0, F.lit(None).cast("string")).when(time_idx == 1, F.lit(""))
         .when(time_idx == 2, F.lit("25:61")).when(time_idx == 3, F.lit(" 3:05 "))
         .otherwise(hour_min).alias("crash_time"),
        _pick(s % 7, BOROUGH_BY_S7).alias("borough"),
        F.when(s % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), _txt(s % 20 + 10000)))
         .alias("zip_code"),
        F.when(p % 11 == 0, F.lit("0")).when(p % 13 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("40."), _pad3(p % 1000))).alias("latitude"),
        F.when((p % 11 == 0) | (p % 17 == 0), F.lit("0")).when(p % 13 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("-73."), _pad3(p % 1000))).alias("longitude"),
        F.concat(F.lit('{"k":"'), _txt(p), F.lit('"}')).alias("location"),
        F.when(p % 2 == 0, F.concat(F.lit(" broadway "), _txt(p % 50), F.lit(" ")))
         .otherwise(F.lit("")).alias("on_street_name"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Ave "), _txt(k % 30))).alias("cross_street_name"),
        F.when(s % 3 == 0, F.lit(" 12 main st")).alias("off_street_name"),
        F.when(k % 29 == 0, F.lit("-1")).when(k % 31 == 0, F.lit("x"))
         .when(k % 37 == 0, F.lit(None).cast("string")).otherwise(_txt(p % 4))
         .alias("number_of_persons_injured"),
        F.when(k % 211 == 0, F.lit("1")).when(k % 29 == 0, F.lit("-2")).otherwise(F.lit("0"))
         .alias("number_of_persons_killed"),
        F.when(p % 6 == 0, F.lit("1")).when(p % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("0")).alias("number_of_pedestrians_injured"),
        when_k(401, "1").alias("number_of_pedestrians_killed"),
        F.when(p % 9 == 0, F.lit("2")).otherwise(F.lit("0")).alias("number_of_cyclist_injured"),
        when_k(503, "1").alias("number_of_cyclist_killed"),
        F.when(k % 37 == 0, F.lit("x")).otherwise(_txt(p % 3)).alias("number_of_motorist_injured"),
        when_k(307, "1").alias("number_of_motorist_killed"),
        _pick(p % 3, FACTOR1_BY_P3).alias("contributing_factor_vehicle_1"),
        _pick(s % 3, FACTOR2_BY_S3).alias("contributing_factor_vehicle_2"),
        F.when(p % 10 == 0, F.lit("glare")).alias("contributing_factor_vehicle_3"),
        F.when(k % 50 == 0, F.lit("other vehicular")).alias("contributing_factor_vehicle_4"),
        F.when(k % 100 == 0, F.lit("other vehicular")).alias("contributing_factor_vehicle_5"),
        _pick(p % 4, VEHICLE1_BY_P4).alias("vehicle_type_code1"),
        _pick(s % 4, VEHICLE2_BY_S4).alias("vehicle_type_code2"),
        F.when(p % 7 == 0, F.lit("bus")).alias("vehicle_type_code_3"),
        F.when(k % 41 == 0, F.lit("van")).alias("vehicle_type_code_4"),
        F.when(k % 83 == 0, F.lit("van")).alias("vehicle_type_code_5"),
        F.col("l_shipdate").alias(INGESTION_TS),
    )
