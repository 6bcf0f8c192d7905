"""Calendar attribute columns for a date dimension (Spark conventions: 1 = Sunday)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.functions.columns import col_


def date_id(d: str | Column) -> Column:
    """``yyyyMMdd`` integer key."""
    return F.date_format(col_(d), "yyyyMMdd").cast("int")


def calendar_columns(d: str | Column, prefix: str = "") -> list[Column]:
    """date_id, year, quarter, month, month_name, day, week_of_year (ISO), day_of_week,
    day_name, is_weekend — every column derived from one date, no lookup table."""
    d = col_(d)
    dow = F.dayofweek(d)
    return [
        date_id(d).alias(f"{prefix}date_id"),
        F.year(d).alias(f"{prefix}year"),
        F.quarter(d).alias(f"{prefix}quarter"),
        F.month(d).alias(f"{prefix}month"),
        F.date_format(d, "MMMM").alias(f"{prefix}month_name"),
        F.dayofmonth(d).alias(f"{prefix}day"),
        F.weekofyear(d).alias(f"{prefix}week_of_year"),
        dow.alias(f"{prefix}day_of_week"),
        F.date_format(d, "EEEE").alias(f"{prefix}day_name"),
        dow.isin(1, 7).alias(f"{prefix}is_weekend"),
    ]
