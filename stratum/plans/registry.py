"""Registered queries: one ``(spark, sf_dir) -> DataFrame`` per operator of the inventory.

Every query reads the driver tables (or data Spark derives from them) in full. Queries that
exercise a sink write under a fresh folder below ``spark.checkpoint.dir`` and return what
was read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import checks as Q
from stratum.operators.checks import check_counts, failing_rows
from stratum.operators.clean import clean, spec, valid_rows
from stratum.operators.dimension import calendar
from stratum.plans import collisions as C
from stratum.plans.staged_run import staged_run
from stratum.session import scratch_path, widen_rows
from stratum.sinks.tables import compact, publish_view
from stratum.sources.adapter import collisions_feed
from stratum.sources.dealing import deal_large_parts
from stratum.sources.incremental import (
    high_water_mark,
    incremental_window,
    load_window,
    page,
    page_numbers,
    write_page_index,
    ts_literal,
)
from stratum.sources.landing import flatten_nested, land_jsonl
from stratum.sources.raw import (
    INGESTION_TS,
    RAW_COLUMNS,
    promote_all_extra,
    read_merged,
    read_raw,
    read_seed,
)
from stratum.streaming.bronze import read_bronze
from stratum.streaming.file_load import load_new_files

# Parameters of the registered queries.
EVENTS_MARK, EVENTS_TODAY = "2024-01-10", "2024-01-25"   # saved mark / run date (L1, L2)
EVENTS_SHAPE_SPLIT = "2024-01-15"                         # newer files carry more fields (L7)
FEED_SPLIT = "1998-01-01"                                 # two landing batches (L8)
TEST_PAGE = 1000                                          # page size at test scale (L3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four columns of ``lineitem`` become 30 of text, so its scan is cut into smaller tasks, and large row
    groups are dealt over several."""
    widen_rows(spark)
    return collisions_feed(deal_large_parts(table(spark, sf_dir, "lineitem")))


def silver_df(spark, sf_dir) -> DataFrame:
    return C.silver(feed(spark, sf_dir), wall_clock=False)


def gold(spark, sf_dir, materialize: bool = False) -> C.Gold:
    return C.Gold(spark, C.staging(silver_df(spark, sf_dir)), materialize=materialize)


# --- L1-L15: sources, sinks, incremental load ------------------------------------------------

def q_incremental_window(spark, sf):
    start, end = load_window(EVENTS_TODAY, mark=EVENTS_MARK)
    return incremental_window(table(spark, sf, "events"), "ts", start, end)


def q_high_water_mark(spark, sf):
    start, end = load_window(EVENTS_TODAY, mark=EVENTS_MARK)
    batch = incremental_window(table(spark, sf, "events"), "ts", start, end)
    return high_water_mark(batch, "ts", end, old_mark=EVENTS_MARK)


def q_ordered_page(spark, sf):
    return page(table(spark, sf, "events"), ["ts", "event_id"], size=TEST_PAGE, n=2)


def q_deep_page(spark, sf):
    index = write_page_index(table(spark, sf, "events"), ["ts", "event_id"], scratch_path(spark, "pages"), TEST_PAGE)
    return index.page(spark, 4)


def q_page_numbers(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return page_numbers(orders, ["o_orderdate", "o_orderkey"], size=TEST_PAGE)


def q_flatten_nested(spark, sf):
    o = table(spark, sf, "orders")
    nested = o.select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"))
        .alias("customer"),
        F.array("o_orderpriority", "o_orderstatus").alias("tags"),
        F.create_map(F.lit("priority"), F.col("o_orderpriority")).alias("attrs"))
    return flatten_nested(nested)


def q_jsonl_roundtrip(spark, sf):
    landing = scratch_path(spark, "jsonl_roundtrip")
    land_jsonl(feed(spark, sf).select(*RAW_COLUMNS), landing, "1")
    return read_raw(spark, landing).select(*RAW_COLUMNS)


def q_schema_merge_load(spark, sf):
    ev = table(spark, sf, "events")
    newer = ev["ts"] >= ts_literal(EVENTS_SHAPE_SPLIT, ev.schema["ts"].dataType)
    landing = scratch_path(spark, "schema_merge")
    land_jsonl(ev.where(~F.coalesce(newer, F.lit(False)))
               .select("event_id", "ts", "event_type"), landing, "1")
    land_jsonl(ev.where(F.coalesce(newer, F.lit(False)))
               .select("event_id", "ts", "event_type", "user_id", "value", "props"), landing, "2")
    merged = read_merged(spark, landing, columns=["event_id", "ts", "event_type", "user_id"])
    return promote_all_extra(merged).select(
        "event_id", F.col("ts").try_cast("timestamp_ntz").alias("ts"), "event_type", "user_id",
        F.col("value").try_cast("double").alias("value"), "props")


def q_idempotent_file_load(spark, sf):
    base = scratch_path(spark, "file_load")
    raw = feed(spark, sf)
    first = F.coalesce(raw[INGESTION_TS] < ts_literal(FEED_SPLIT, raw.schema[INGESTION_TS].dataType),
                       F.lit(True))
    landing, bronze, ckpt = f"{base}/landing", f"{base}/bronze", f"{base}/_checkpoint"
    land_jsonl(raw.where(first).select(*RAW_COLUMNS), landing, "1")
    load_new_files(spark, landing, bronze, ckpt)
    load_new_files(spark, landing, bronze, ckpt)          # rerun: nothing new
    land_jsonl(raw.where(~first).select(*RAW_COLUMNS), landing, "2")
    load_new_files(spark, landing, bronze, ckpt)          # only the new batch
    land_jsonl(raw.where(first).select(*RAW_COLUMNS), landing, "1")
    load_new_files(spark, landing, bronze, ckpt)          # a batch landed again replaces itself
    return read_bronze(spark, bronze).select(*RAW_COLUMNS, "crash_date_partition")


def q_compact_partitions(spark, sf):
    base = scratch_path(spark, "compact")
    ev = table(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    # many small files per day, as daily appends leave them
    tasks = spark.sparkContext.defaultParallelism
    ev.repartition(tasks).write.mode("overwrite").partitionBy("event_date").parquet(f"{base}/src")
    return compact(spark, f"{base}/src", f"{base}/dst", "event_date", ev.schema)


def q_seed_lookup_join(spark, sf):
    path = scratch_path(spark, "seed")
    C.borough_lookup(spark).coalesce(1).write.option("header", True).csv(path)
    lookup = read_seed(spark, path, C.BOROUGH_LOOKUP_COLUMNS)
    return C.with_borough_lookup(gold(spark, sf).borough, lookup, len(C.BOROUGH_LOOKUP))


# --- P1-P22, W1: projections and cleaning on the raw feed -------------------------------------

def q_typed_casts(spark, sf):
    return clean(feed(spark, sf), [
        spec("collision_id"), spec("crash_date", "date"),
        spec("latitude", "double"), spec("longitude", "double"),
        *[spec(src, "int", target=dst) for src, dst in C.COUNT_COLUMNS]])


def q_compose_timestamp(spark, sf):
    typed = C.typed(feed(spark, sf))
    return typed.select("collision_id", "crash_date", "crash_time", "crash_datetime")


def q_clean_strings(spark, sf):
    names = (["collision_id", "borough", "zip_code", "on_street_name", "cross_street_name",
              "off_street_name", "crash_time"] + C.FACTOR_COLUMNS + C.RAW_VEHICLE_COLUMNS)
    return C.typed(feed(spark, sf)).select(*names)


def q_null_sentinels(spark, sf):
    return C.typed(feed(spark, sf)).select("collision_id", "latitude", "longitude", *C.COUNT_TARGETS)


def q_valid_rows(spark, sf):
    return (valid_rows(C.typed(feed(spark, sf)), "collision_id", "crash_date")
            .select("collision_id", "crash_date", INGESTION_TS, C.FINGERPRINT))


def q_totals_flags(spark, sf):
    return (C.with_totals(C.typed(feed(spark, sf)))
            .select("collision_id", "total_injuries", "total_fatalities", "has_injuries",
                    "has_fatalities"))


def q_dedupe_latest(spark, sf):
    valid = valid_rows(C.typed(feed(spark, sf)), "collision_id", "crash_date")
    return C.latest_per_id(valid).select("collision_id", "crash_date", INGESTION_TS, C.FINGERPRINT)


# --- T2-T9: silver and gold -------------------------------------------------------------------

def q_silver(spark, sf):
    return silver_df(spark, sf)


def q_staging(spark, sf):
    return publish_view(C.staging(silver_df(spark, sf)), "stg_collisions")


def q_dim_date(spark, sf):
    """Calendar rows over the feed's own date range (the fixed 2022-2030 spine used by the
    fact is covered through ``fact`` / ``monthly_metrics`` and in the tests)."""
    stg = C.staging(silver_df(spark, sf))
    bounds = stg.agg(F.min("crash_date").alias("lo"), F.max("crash_date").alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_day"))
    return calendar(spine)


def q_dim_location(spark, sf):
    return gold(spark, sf).dim_location


def q_dim_vehicle(spark, sf):
    return gold(spark, sf).dim_vehicle


def q_fact(spark, sf):
    return gold(spark, sf).fact


def q_monthly_metrics(spark, sf):
    return gold(spark, sf).monthly


def q_borough_metrics(spark, sf):
    return gold(spark, sf).borough


# --- Q1-Q7, J4: data tests ---------------------------------------------------------------------

def dirty_typed(spark, sf) -> DataFrame:
    """Raw feed with casts and trims but no cleaning: the checks find real failures."""
    return clean(feed(spark, sf), [
        spec("collision_id"), spec("crash_date"), spec("borough", "trim", "upper"),
        spec("number_of_persons_injured", "int", target="persons_injured")])


def _suite_counts(g: C.Gold, kinds) -> DataFrame:
    suite = g.check_suite(kinds)
    parts = [check_counts(df, checks, name) for name, (df, checks) in suite.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _with_dirty(spark, sf, kinds, dirty_checks) -> DataFrame:
    out = _suite_counts(gold(spark, sf, materialize=True), kinds)
    return out.unionByName(check_counts(dirty_typed(spark, sf), dirty_checks, "raw_collisions"))


def q_check_not_null(spark, sf):
    return _with_dirty(spark, sf, {"not_null"},
                       [Q.not_null("collision_id"), Q.not_null("crash_date")])


def q_check_unique(spark, sf):
    return _with_dirty(spark, sf, {"unique"}, [Q.unique("collision_id")])


def q_check_accepted(spark, sf):
    return _with_dirty(spark, sf, {"accepted_values"},
                       [Q.accepted_values("borough", C.BOROUGHS, where="borough is not null")])


def q_check_expression(spark, sf):
    return _with_dirty(spark, sf, {"expression_is_true"},
                       [Q.expression_is_true("persons_injured", ">= 0")])


def q_check_relationships(spark, sf):
    out = _suite_counts(gold(spark, sf, materialize=True), {"relationships"})
    li = table(spark, sf, "lineitem")
    return out.unionByName(check_counts(li, [
        Q.relationships("l_orderkey", table(spark, sf, "orders"), "o_orderkey"),
        Q.relationships("l_partkey", table(spark, sf, "part"), "p_partkey"),
        Q.relationships("l_suppkey", table(spark, sf, "supplier"), "s_suppkey"),
    ], "lineitem"))


def q_check_suite(spark, sf):
    return _suite_counts(gold(spark, sf, materialize=True), {"not_null", "unique", "accepted_values",
                                           "expression_is_true", "relationships"})


def q_failing_rows(spark, sf):
    check = Q.expression_is_true("persons_injured", ">= 0")
    return failing_rows(dirty_typed(spark, sf), check).select("collision_id", "persons_injured")


# --- T10 -----------------------------------------------------------------------------------------

def q_staged_run(spark, sf):
    p = staged_run(spark, feed(spark, sf), scratch_path(spark, "staged_run"), batch_id="1")
    return spark.read.parquet(p.borough_collision_metrics)


QUERIES = {
    "incremental_window": q_incremental_window,
    "high_water_mark": q_high_water_mark,
    "ordered_page": q_ordered_page,
    "deep_page": q_deep_page,
    "page_numbers": q_page_numbers,
    "flatten_nested": q_flatten_nested,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "schema_merge_load": q_schema_merge_load,
    "idempotent_file_load": q_idempotent_file_load,
    "compact_partitions": q_compact_partitions,
    "seed_lookup_join": q_seed_lookup_join,
    "typed_casts": q_typed_casts,
    "compose_timestamp": q_compose_timestamp,
    "clean_strings": q_clean_strings,
    "null_sentinels": q_null_sentinels,
    "valid_rows": q_valid_rows,
    "totals_flags": q_totals_flags,
    "dedupe_latest": q_dedupe_latest,
    "silver": q_silver,
    "staging": q_staging,
    "dim_date": q_dim_date,
    "dim_location": q_dim_location,
    "dim_vehicle": q_dim_vehicle,
    "fact": q_fact,
    "monthly_metrics": q_monthly_metrics,
    "borough_metrics": q_borough_metrics,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_accepted": q_check_accepted,
    "check_expression": q_check_expression,
    "check_relationships": q_check_relationships,
    "check_suite": q_check_suite,
    "failing_rows": q_failing_rows,
    "staged_run": q_staged_run,
}
