"""Dimension builders: generated date spine and distinct-projection dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.calendar import calendar_columns
from stratum.functions.columns import surrogate_key


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def spine_length(start, end) -> int:
    """Rows of ``date_spine(start, end)`` — known on the driver without running a job."""
    return max(0, (_as_date(end) - _as_date(start)).days)


def date_spine(spark: SparkSession, start, end, name: str = "date_day",
               rows_per_partition: int = 100_000) -> DataFrame:
    """One DATE row per day in ``[start, end)`` (end exclusive, like the public macro).

    Built from ``spark.range`` so the rows are generated on executors; the partition count
    follows the row count instead of the cluster's default parallelism.
    """
    n = spine_length(start, end)
    parts = max(1, min(spark.sparkContext.defaultParallelism, n // rows_per_partition + 1))
    return spark.range(0, n, 1, parts).select(
        F.date_add(F.lit(_as_date(start)), F.col("id").cast("int")).alias(name))


def calendar(spine: DataFrame, date_col: str = "date_day", out_date: str = "full_date") -> DataFrame:
    """Calendar attributes for every spine date (``date_id`` first, then the date itself)."""
    cols = calendar_columns(date_col)
    return spine.select(cols[0], F.col(date_col).alias(out_date), *cols[1:])


def distinct_dimension(df: DataFrame, cols: list[str], key: str,
                       extra: list[Column] = ()) -> DataFrame:
    """``SELECT DISTINCT cols`` (NULLs group together) + hashed surrogate key + extras.

    Distinct plans as partial + final hash aggregate: each map task ships one row per
    combination it saw, so a dominant combination never concentrates in one task.
    """
    return df.select(*cols).distinct().select(surrogate_key(*cols).alias(key), *cols, *extra)
