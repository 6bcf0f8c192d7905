"""Declarative column cleaning: a list of column specs becomes ONE projection.

Each spec names a source column, the target name and an ordered list of steps. Steps are
plain built-in column functions, so the whole clean stays one codegen'd ``Project`` that
Catalyst can prune and push filters through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import (
    col_,
    empty_to_null,
    non_negative,
    sentinel_to_null,
    try_cast,
)

STEPS = {
    "trim": F.trim,
    "upper": F.upper,
    "lower": F.lower,
    "initcap": F.initcap,
    "date": lambda c: try_cast(c, "date"),
    "double": lambda c: try_cast(c, "double"),
    "int": lambda c: try_cast(c, "int"),
    "bigint": lambda c: try_cast(c, "bigint"),
    "empty_to_null": empty_to_null,
    "zero_to_null": sentinel_to_null,
    "non_negative": non_negative,
}


@dataclass(frozen=True)
class ColumnSpec:
    source: str
    target: str | None = None
    steps: tuple[str, ...] = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return self.target or self.source


def spec(source: str, *steps: str, target: str | None = None) -> ColumnSpec:
    unknown = [s for s in steps if s not in STEPS]
    if unknown:
        raise ValueError(f"unknown clean steps {unknown}; known: {sorted(STEPS)}")
    return ColumnSpec(source, target, tuple(steps))


def clean_column(s: ColumnSpec) -> Column:
    c = col_(s.source)
    for step in s.steps:
        c = STEPS[step](c)
    return c.alias(s.name)


def clean(df: DataFrame, specs, extra=()) -> DataFrame:
    """Apply every spec (plus ``extra`` columns) in a single ``select``."""
    return df.select(*[clean_column(s) for s in specs], *extra)


def valid_rows(df: DataFrame, id_col: str, date_col: str,
               invalid_ids=("None",)) -> DataFrame:
    """Keep rows with a usable id and date. Runs BEFORE dedupe (a newer row without a date
    must not shadow an older valid one). The empty-string id passes, as in the reference."""
    i = F.col(id_col)
    cond = i.isNotNull() & F.col(date_col).isNotNull()
    for bad in invalid_ids:
        cond = cond & (i != F.lit(bad))
    return df.where(cond)
