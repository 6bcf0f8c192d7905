"""Incident star schema: silver (T2), staging (T3), dimensions (T4-T6), fact (T7), rollups.

Every builder is a lazy ``DataFrame -> DataFrame`` function; nothing runs until a sink or
action. Silver has exactly one shuffle (dedupe by id); the gold builders add only small
aggregate shuffles (distinct dimensions, pre-aggregated rollups) and a broadcast of the
generated calendar, whose size is known from its parameters.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.columns import (
    compose_timestamp,
    filled_count,
    label,
    month_start_label,
    null_safe_sum,
    rate_per_100,
    row_fingerprint,
    surrogate_key,
    try_cast,
)
from stratum.functions.packed import pack, unpack
from stratum.operators import checks as Q
from stratum.operators.clean import clean, spec, valid_rows
from stratum.operators.dedupe import dedupe_latest
from stratum.operators.dimension import calendar, date_spine, distinct_dimension, spine_length
from stratum.operators.rollup import Measure, bounded_broadcast, rollup_through_dimension
from stratum.session import scratch_path
from stratum.sources.raw import INGESTION_TS, RAW_COLUMNS

# --- fixed values ------------------------------------------------------------------------
# raw count column -> silver name
COUNT_COLUMNS = [
    ("number_of_persons_injured", "persons_injured"),
    ("number_of_persons_killed", "persons_killed"),
    ("number_of_pedestrians_injured", "pedestrians_injured"),
    ("number_of_pedestrians_killed", "pedestrians_killed"),
    ("number_of_cyclist_injured", "cyclists_injured"),
    ("number_of_cyclist_killed", "cyclists_killed"),
    ("number_of_motorist_injured", "motorists_injured"),
    ("number_of_motorist_killed", "motorists_killed"),
]
FACTOR_COLUMNS = [f"contributing_factor_vehicle_{i}" for i in range(1, 6)]
RAW_VEHICLE_COLUMNS = ["vehicle_type_code1", "vehicle_type_code2", "vehicle_type_code_3",
                       "vehicle_type_code_4", "vehicle_type_code_5"]
VEHICLE_COLUMNS = [f"vehicle_type_{i}" for i in range(1, 6)]
BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND"]
# calendar spine: start inclusive, end exclusive
SPINE_START, SPINE_END = "2022-01-01", "2030-12-31"
# borough lookup seed: code, name, short
BOROUGH_LOOKUP = [
    ("BRONX", "The Bronx", "BX"),
    ("BROOKLYN", "Brooklyn", "BK"),
    ("MANHATTAN", "Manhattan", "MN"),
    ("QUEENS", "Queens", "QN"),
    ("STATEN ISLAND", "Staten Island", "SI"),
    ("Unknown", "Unknown", "N/A"),
]
BOROUGH_LOOKUP_COLUMNS = ["borough_code", "borough_name", "borough_short"]
# -----------------------------------------------------------------------------------------

INJURY_COLUMNS = ["persons_injured", "pedestrians_injured", "cyclists_injured", "motorists_injured"]
FATALITY_COLUMNS = ["persons_killed", "pedestrians_killed", "cyclists_killed", "motorists_killed"]
COUNT_TARGETS = [t for _, t in COUNT_COLUMNS]
FINGERPRINT = "_row_fingerprint"

SILVER_SPECS = (
    [spec("collision_id"),
     spec("crash_date", "date"),
     spec("crash_time", "trim"),
     spec("borough", "trim", "upper", "empty_to_null"),
     spec("zip_code", "trim", "empty_to_null"),
     spec("latitude", "double", "zero_to_null"),
     spec("longitude", "double", "zero_to_null")]
    + [spec(c, "trim", "upper", "empty_to_null")
       for c in ("on_street_name", "cross_street_name", "off_street_name")]
    + [spec(src, "int", "non_negative", target=dst) for src, dst in COUNT_COLUMNS]
    + [spec(c, "trim", "initcap", "empty_to_null") for c in FACTOR_COLUMNS]
    + [spec(c, "trim", "upper", "empty_to_null") for c in RAW_VEHICLE_COLUMNS]
)

SILVER_COLUMNS = (
    ["collision_id", "crash_date", "crash_time", "crash_datetime", "borough", "zip_code",
     "latitude", "longitude", "on_street_name", "cross_street_name", "off_street_name"]
    + COUNT_TARGETS
    + ["total_injuries", "total_fatalities", "has_injuries", "has_fatalities"]
    + FACTOR_COLUMNS + RAW_VEHICLE_COLUMNS
)


def typed(raw: DataFrame) -> DataFrame:
    """Casts, trims, case rules, NULL-ing of blanks / sentinels / negatives (P1-P10) in ONE
    projection, plus the composed timestamp (P4) and the raw-row fingerprint."""
    crash_datetime = compose_timestamp(try_cast("crash_date", "date"), F.col("crash_time"))
    return clean(raw, SILVER_SPECS, extra=[
        crash_datetime.alias("crash_datetime"),
        F.col(INGESTION_TS),
        row_fingerprint(*RAW_COLUMNS).alias(FINGERPRINT),
    ])


def with_totals(df: DataFrame, injury_columns=tuple(INJURY_COLUMNS),
                fatality_columns=tuple(FATALITY_COLUMNS)) -> DataFrame:
    """NULL-safe totals and their flags.

    By default persons + pedestrians + cyclists + motorists are added, as the reference does;
    pass narrower lists if "persons" already includes the other categories in a feed.
    """
    ti, tf = null_safe_sum(injury_columns), null_safe_sum(fatality_columns)
    return df.select("*", ti.alias("total_injuries"), tf.alias("total_fatalities")).select(
        "*", (F.col("total_injuries") > 0).alias("has_injuries"),
        (F.col("total_fatalities") > 0).alias("has_fatalities"))


def latest_per_id(df: DataFrame) -> DataFrame:
    """Newest load wins; ties (one load stamps every row alike) go to the larger
    fingerprint, so reruns and recomputation after executor loss pick the same row."""
    return dedupe_latest(df, ["collision_id"],
                         [F.col(INGESTION_TS).desc_nulls_last(), F.col(FINGERPRINT).desc()])


# steps that make a column narrower; the other steps of its spec give the same values after them
NARROWER = {s.source: s.steps[0] for s in SILVER_SPECS if s.steps and s.steps[0] in ("date", "double", "int")}


def sortable(raw: DataFrame) -> DataFrame:
    """Raw rows as the dedupe sorts and shuffles them: numbers and dates cast, the fingerprint (of the raw
    text) as 16 bytes, which are ordered as its hex digits are."""
    return raw.select(
        *[try_cast(c, NARROWER[c]).alias(c) if c in NARROWER else F.col(c) for c in RAW_COLUMNS],
        F.col(INGESTION_TS), F.unhex(row_fingerprint(*RAW_COLUMNS)).alias(FINGERPRINT))


def latest_dealt(rows: DataFrame) -> DataFrame:
    """:func:`latest_per_id` of whole rows, those of a crash date then together: what both shuffles move is packed."""
    packed = latest_per_id(pack(rows, ["collision_id", "crash_date", INGESTION_TS, FINGERPRINT]))
    return unpack(packed.drop(FINGERPRINT).hint("rebalance", "crash_date"), rows.drop(FINGERPRINT).schema)


def silver(raw: DataFrame, wall_clock: bool = True, injury_columns=tuple(INJURY_COLUMNS),
           fatality_columns=tuple(FATALITY_COLUMNS), dealt: bool = False) -> DataFrame:
    """Valid rows (before dedupe) -> latest per id -> typed -> totals -> audit columns.

    Rows are told apart as raw text, so only the one that is kept of each id is cleaned. With ``dealt`` (all
    columns are wanted, to be written by crash date) they are packed for the shuffles."""
    valid = valid_rows(sortable(raw), "collision_id", "crash_date")
    latest = latest_dealt(valid) if dealt else latest_per_id(valid)
    out = with_totals(typed(latest.drop(FINGERPRINT)).drop(FINGERPRINT), injury_columns, fatality_columns)
    audit = [F.col(INGESTION_TS)]
    if wall_clock:
        audit.append(F.current_timestamp().alias("_silver_timestamp"))
    audit.append(F.col("crash_date").alias("crash_date_partition"))
    return out.select(*SILVER_COLUMNS, *audit)


def staging(silver_df: DataFrame) -> DataFrame:
    """Select and rename (vehicle slots normalised to ``vehicle_type_1..5``)."""
    renamed = dict(zip(RAW_VEHICLE_COLUMNS, VEHICLE_COLUMNS))
    return silver_df.select(*[F.col(c).alias(renamed.get(c, c)) for c in SILVER_COLUMNS])


def dim_date(spark: SparkSession, start=SPINE_START, end=SPINE_END) -> DataFrame:
    """T4: one row per day in ``[start, end)`` with calendar attributes."""
    return calendar(date_spine(spark, start, end))


def dim_location(stg: DataFrame) -> DataFrame:
    """T5: distinct (borough, zip) incl. NULLs, hashed key, 'Unknown' labels."""
    return distinct_dimension(stg, ["borough", "zip_code"], "location_sk", extra=[
        label("borough").alias("borough_label"), label("zip_code").alias("zip_code_label")])


def dim_vehicle(stg: DataFrame) -> DataFrame:
    """Distinct 5-slot vehicle combination, primary type, filled-slot count."""
    return distinct_dimension(stg, VEHICLE_COLUMNS, "vehicle_sk", extra=[
        label("vehicle_type_1").alias("primary_vehicle_type"),
        filled_count(*VEHICLE_COLUMNS).alias("vehicles_involved_count")])


FACT_MEASURES = COUNT_TARGETS + ["total_injuries", "total_fatalities", "has_injuries", "has_fatalities"]


def fact(stg: DataFrame, dates: DataFrame, dates_rows: int | None = None) -> DataFrame:
    """One row per collision; ``date_sk`` from a left join to the calendar.

    Location and vehicle keys are re-hashed from the natural columns (same MD5 as the
    dimensions) instead of joined: two fewer joins, identical keys. The calendar is
    broadcast only when its row count is proven (``dates_rows``); otherwise adaptive
    execution picks the join from runtime sizes.
    """
    d = bounded_broadcast(dates.select("date_id", "full_date"), dates_rows)
    j = stg.join(d, stg["crash_date"] == d["full_date"], "left")
    return j.select(
        surrogate_key("collision_id").alias("collision_sk"),
        "collision_id",
        F.col("date_id").alias("date_sk"),
        surrogate_key("borough", "zip_code").alias("location_sk"),
        surrogate_key(*VEHICLE_COLUMNS).alias("vehicle_sk"),
        "crash_date", "crash_time", "crash_datetime", "latitude", "longitude",
        "on_street_name", "cross_street_name",
        *FACT_MEASURES, *FACTOR_COLUMNS)


def monthly_metrics(fact_df: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts per calendar month (inner join: undated facts drop out), ordered by month."""
    positive = F.when(F.col("total_injuries") > 0, F.col("total_injuries"))
    measures = [
        Measure("total_collisions", "count"),
        Measure("total_injuries", "sum", "total_injuries"),
        Measure("total_fatalities", "sum", "total_fatalities"),
        Measure("collisions_with_injuries", "count_if", "has_injuries"),
        Measure("collisions_with_fatalities", "count_if", "has_fatalities"),
        Measure("avg_injuries", "avg", positive),
        Measure("pedestrians_injured", "sum", "pedestrians_injured"),
        Measure("pedestrians_killed", "sum", "pedestrians_killed"),
        Measure("cyclists_injured", "sum", "cyclists_injured"),
        Measure("cyclists_killed", "sum", "cyclists_killed"),
    ]
    agg = rollup_through_dimension(fact_df, dates, "date_sk", "date_id",
                                   [F.col("year"), F.col("month"), F.col("month_name")],
                                   measures, how="inner")
    return (agg.where(F.col("year").isNotNull())
            .select("year", "month", "month_name",
                    month_start_label("year", "month").alias("month_start_date"),
                    "total_collisions", "total_injuries", "total_fatalities",
                    "collisions_with_injuries", "collisions_with_fatalities",
                    F.round("avg_injuries", 2).alias("avg_injuries_per_crash"),
                    "pedestrians_injured", "pedestrians_killed",
                    "cyclists_injured", "cyclists_killed")
            .orderBy("year", "month"))


def borough_metrics(fact_df: DataFrame, locations: DataFrame) -> DataFrame:
    """All-time totals per borough label (left join: unmatched keys -> 'Unknown')."""
    measures = ([Measure("total_collisions", "count"),
                 Measure("total_injuries", "sum", "total_injuries"),
                 Measure("total_fatalities", "sum", "total_fatalities")]
                + [Measure(c, "sum", c) for c in COUNT_TARGETS])
    agg = rollup_through_dimension(
        fact_df, locations, "location_sk", "location_sk",
        [label("borough").alias("borough")], measures, how="left",
        post=[rate_per_100("total_injuries", "total_collisions").alias("injury_rate_per_100"),
              rate_per_100("total_fatalities", "total_collisions").alias("fatality_rate_per_100")])
    return agg.orderBy(F.col("total_collisions").desc())


def borough_lookup(spark: SparkSession) -> DataFrame:
    """The 6-row borough seed as a DataFrame (fixed size: safe to broadcast)."""
    return spark.createDataFrame(BOROUGH_LOOKUP, ",".join(f"{c} string" for c in BOROUGH_LOOKUP_COLUMNS))


def with_borough_lookup(boroughs: DataFrame, lookup: DataFrame, lookup_rows: int | None = None) -> DataFrame:
    """Decorate the borough rollup with the seed's display names. The seed is broadcast
    only when its length is given; otherwise adaptive execution decides from its size."""
    seed = bounded_broadcast(lookup, lookup_rows)
    return (boroughs.join(seed, boroughs["borough"] == seed["borough_code"], "left")
            .drop("borough_code"))


class Gold:
    """The gold tables built from one staging DataFrame, each on first use.

    Lazy by default (a single consumer re-reads its inputs). With ``materialize=True`` every table
    that is used is written once as parquet in the shared scratch folder and read back, because
    several consumers read it: the dimensions, rollups and checks then start from stored,
    column-pruned data instead of recomputing silver, and tables nobody asks for are not built.
    """

    NAMES = {"stg_collisions": "stg", "dim_date": "dim_date", "dim_location": "dim_location",
             "dim_vehicle": "dim_vehicle", "fact_collisions": "fact",
             "monthly_collision_metrics": "monthly", "borough_collision_metrics": "borough"}

    def __init__(self, spark: SparkSession, stg: DataFrame, start=SPINE_START, end=SPINE_END,
                 materialize: bool = False):
        self._spark, self._staging, self._start, self._end = spark, stg, start, end
        self._folder = scratch_path(spark, "gold") if materialize else None
        self.dim_date_rows = spine_length(start, end)

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        if not self._folder:
            return df
        df.write.parquet(f"{self._folder}/{name}")
        return self._spark.read.schema(df.schema).parquet(f"{self._folder}/{name}")

    @cached_property
    def stg(self) -> DataFrame:
        return self._kept("stg", self._staging)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._kept("dim_date", dim_date(self._spark, self._start, self._end))

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._kept("dim_location", dim_location(self.stg))

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return self._kept("dim_vehicle", dim_vehicle(self.stg))

    @cached_property
    def fact(self) -> DataFrame:
        return self._kept("fact", fact(self.stg, self.dim_date, self.dim_date_rows))

    @cached_property
    def monthly(self) -> DataFrame:
        return self._kept("monthly", monthly_metrics(self.fact, self.dim_date))

    @cached_property
    def borough(self) -> DataFrame:
        return self._kept("borough", borough_metrics(self.fact, self.dim_location))

    def tables(self, names=None) -> dict[str, DataFrame]:
        return {n: getattr(self, self.NAMES[n]) for n in (names or self.NAMES)}

    def check_suite(self, kinds=None) -> dict:
        """The reference data tests (:data:`REFERENCE_TESTS`), of some kinds or all 53, as
        ``{table: (df, [checks])}``; only the tables they name are built."""
        tests = [t for t in REFERENCE_TESTS if kinds is None or t[1] in kinds]
        named = {t[0] for t in tests} | {t[3]["to"][0] for t in tests if "to" in t[3]}
        return build_suite(self.tables(n for n in self.NAMES if n in named), tests)


def build_suite(tables: dict[str, DataFrame], tests) -> dict:
    """``[(table, kind, column, options)]`` -> ``{table: (df, [Check])}``."""
    suite: dict = {}
    for table, kind, column, opts in tests:
        where = opts.get("where")
        if kind == "not_null":
            c = Q.not_null(column, where)
        elif kind == "unique":
            c = Q.unique(column, where)
        elif kind == "accepted_values":
            c = Q.accepted_values(column, opts["values"], where)
        elif kind == "expression_is_true":
            c = Q.expression_is_true(column, opts["expression"], where)
        elif kind == "relationships":
            parent, parent_col = opts["to"]
            c = Q.relationships(column, tables[parent], parent_col, where)
        else:
            raise ValueError(kind)
        suite.setdefault(table, (tables[table], []))[1].append(c)
    return suite


# --- fixed values: the reference's declarative data tests (53) ---------------------------
_BOROUGH_OK = {"values": BOROUGHS, "where": "borough is not null"}
REFERENCE_TESTS = [
    ("stg_collisions", "not_null", "collision_id", {}),
    ("stg_collisions", "unique", "collision_id", {}),
    ("stg_collisions", "not_null", "crash_date", {}),
    ("stg_collisions", "accepted_values", "borough", _BOROUGH_OK),
    ("stg_collisions", "not_null", "total_injuries", {}),
    ("stg_collisions", "expression_is_true", "total_injuries", {"expression": ">= 0"}),
    ("stg_collisions", "not_null", "total_fatalities", {}),
    ("stg_collisions", "expression_is_true", "total_fatalities", {"expression": ">= 0"}),
    ("dim_date", "not_null", "date_id", {}),
    ("dim_date", "unique", "date_id", {}),
    ("dim_date", "not_null", "full_date", {}),
    ("dim_date", "unique", "full_date", {}),
    ("dim_date", "not_null", "year", {}),
    ("dim_date", "not_null", "month", {}),
    ("dim_date", "accepted_values", "month", {"values": list(range(1, 13))}),
    ("dim_date", "not_null", "day_of_week", {}),
    ("dim_date", "accepted_values", "day_of_week", {"values": list(range(1, 8))}),
    ("dim_date", "not_null", "is_weekend", {}),
    ("dim_location", "not_null", "location_sk", {}),
    ("dim_location", "unique", "location_sk", {}),
    ("dim_location", "accepted_values", "borough", _BOROUGH_OK),
    ("dim_location", "not_null", "borough_label", {}),
    ("dim_vehicle", "not_null", "vehicle_sk", {}),
    ("dim_vehicle", "unique", "vehicle_sk", {}),
    ("dim_vehicle", "not_null", "primary_vehicle_type", {}),
    ("dim_vehicle", "not_null", "vehicles_involved_count", {}),
    ("dim_vehicle", "accepted_values", "vehicles_involved_count", {"values": list(range(0, 6))}),
    ("fact_collisions", "not_null", "collision_sk", {}),
    ("fact_collisions", "unique", "collision_sk", {}),
    ("fact_collisions", "not_null", "collision_id", {}),
    ("fact_collisions", "unique", "collision_id", {}),
    ("fact_collisions", "relationships", "date_sk", {"to": ("dim_date", "date_id"), "where": "date_sk is not null"}),
    ("fact_collisions", "relationships", "location_sk", {"to": ("dim_location", "location_sk")}),
    ("fact_collisions", "relationships", "vehicle_sk", {"to": ("dim_vehicle", "vehicle_sk")}),
    ("fact_collisions", "not_null", "crash_date", {}),
    ("fact_collisions", "not_null", "total_injuries", {}),
    ("fact_collisions", "expression_is_true", "total_injuries", {"expression": ">= 0"}),
    ("fact_collisions", "not_null", "total_fatalities", {}),
    ("fact_collisions", "expression_is_true", "total_fatalities", {"expression": ">= 0"}),
    ("fact_collisions", "not_null", "has_injuries", {}),
    ("fact_collisions", "not_null", "has_fatalities", {}),
    ("monthly_collision_metrics", "not_null", "year", {}),
    ("monthly_collision_metrics", "not_null", "month", {}),
    ("monthly_collision_metrics", "not_null", "total_collisions", {}),
    ("monthly_collision_metrics", "expression_is_true", "total_collisions", {"expression": "> 0"}),
    ("monthly_collision_metrics", "not_null", "total_injuries", {}),
    ("monthly_collision_metrics", "not_null", "total_fatalities", {}),
    ("borough_collision_metrics", "not_null", "borough", {}),
    ("borough_collision_metrics", "unique", "borough", {}),
    ("borough_collision_metrics", "not_null", "total_collisions", {}),
    ("borough_collision_metrics", "expression_is_true", "total_collisions", {"expression": "> 0"}),
    ("borough_collision_metrics", "not_null", "injury_rate_per_100", {}),
    ("borough_collision_metrics", "not_null", "fatality_rate_per_100", {}),
]
# -----------------------------------------------------------------------------------------
