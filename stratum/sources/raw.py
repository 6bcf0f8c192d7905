"""Bronze schema and all-string JSON sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the 29 raw record fields, in landing order ---------------------------
RAW_COLUMNS = [
    "collision_id", "crash_date", "crash_time", "borough", "zip_code", "latitude",
    "longitude", "location", "on_street_name", "cross_street_name", "off_street_name",
    "number_of_persons_injured", "number_of_persons_killed",
    "number_of_pedestrians_injured", "number_of_pedestrians_killed",
    "number_of_cyclist_injured", "number_of_cyclist_killed",
    "number_of_motorist_injured", "number_of_motorist_killed",
    "contributing_factor_vehicle_1", "contributing_factor_vehicle_2",
    "contributing_factor_vehicle_3", "contributing_factor_vehicle_4",
    "contributing_factor_vehicle_5",
    "vehicle_type_code1", "vehicle_type_code2", "vehicle_type_code_3",
    "vehicle_type_code_4", "vehicle_type_code_5",
]
# ----------------------------------------------------------------------------------------

INGESTION_TS = "_ingestion_timestamp"
EXTRA_COL = "_extra"
# Most keys that a load may add as columns without naming them.
MAX_NEW_KEYS = 1000

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw(spark: SparkSession, path: str, columns=RAW_COLUMNS) -> DataFrame:
    """JSON lines with every declared field read as STRING.

    A declared STRING over a nested object yields the object's JSON text; a missing key is
    NULL. Undeclared keys are dropped here; use :func:`read_merged` to keep them.
    """
    return spark.read.schema(string_schema(columns)).json(path)


def parse_records(lines: DataFrame, columns=RAW_COLUMNS, extra_col: str = EXTRA_COL) -> DataFrame:
    """JSON text lines (``value``) -> known columns as STRING + a ``map<string,string>`` of
    every other key (L6, L7). Known keys are parsed by a struct schema; the map is built only
    for a line that has other keys. Nested values stay JSON text. A line that is not JSON gives
    a NULL map and all-NULL columns (it survives to the id filter instead of failing the load).
    Columns of ``lines`` other than ``value`` are kept."""
    rest = [c for c in lines.columns if c != "value"]
    text_map = T.MapType(T.StringType(), T.StringType())
    known = F.array(*[F.lit(c) for c in columns])
    keys = F.json_object_keys("value")
    others = F.map_filter(F.from_json("value", text_map), lambda k, v: ~F.array_contains(known, k))
    extra = (F.when(F.size(F.array_except(keys, known)) > 0, others)
             .when(keys.isNotNull(), F.map_from_arrays(F.array().cast("array<string>"),
                                                       F.array().cast("array<string>"))))
    return (lines.select(F.from_json("value", string_schema(columns)).alias("_s"), extra.alias(extra_col), *rest)
            .select(*rest, *[F.col("_s")[c].alias(c) for c in columns], extra_col))


def read_merged(spark: SparkSession, path: str, columns=RAW_COLUMNS,
                extra_col: str = EXTRA_COL) -> DataFrame:
    """Schema-merging load (L7): files with missing or new fields load side by side; unknown
    keys wait in ``_extra`` until :func:`promote_extra` turns them into columns."""
    return parse_records(spark.read.text(path).select("value"), columns, extra_col)


def promote_extra(df: DataFrame, keys, extra_col: str = EXTRA_COL) -> DataFrame:
    """Turn chosen keys of the ``_extra`` map into STRING columns (the merged table grows)."""
    return df.select("*", *[F.col(extra_col)[k].alias(k) for k in keys])


def extra_keys(df: DataFrame, extra_col: str = EXTRA_COL, max_keys: int = MAX_NEW_KEYS) -> list[str]:
    """The keys seen in ``_extra``. A feed with id-like keys has no bound, so more than
    ``max_keys`` stop the load with an error; nothing is cut."""
    keys = df.select(F.explode(F.map_keys(extra_col)).alias("k")).distinct().limit(max_keys + 1).collect()
    if len(keys) > max_keys:
        raise ValueError(f"more than {max_keys} new JSON keys: name those to promote")
    return sorted(r.k for r in keys)


def promote_all_extra(df: DataFrame, extra_col: str = EXTRA_COL, max_keys: int = MAX_NEW_KEYS) -> DataFrame:
    """Promote every key seen in ``_extra`` (like a merge-schema load adding new fields)."""
    keys = extra_keys(df, extra_col, max_keys)
    return promote_extra(df, [k for k in keys if k not in df.columns], extra_col)


def with_load_columns(df: DataFrame, date_col: str = "crash_date",
                      partition_col: str = "crash_date_partition",
                      ts_col: str = INGESTION_TS) -> DataFrame:
    """Audit columns of a load (L9, L10): load time and the derived date partition."""
    out = df if ts_col in df.columns else df.withColumn(ts_col, F.current_timestamp())
    return out.withColumn(partition_col, F.col(date_col).try_cast("date"))


def read_seed(spark: SparkSession, path: str, columns) -> DataFrame:
    """CSV lookup with a header row and declared STRING columns."""
    return spark.read.schema(string_schema(columns)).option("header", True).csv(path)
