"""Star-schema joins and rollups.

Two scale rules drive this module:

* A dimension is broadcast only with a *proven* row bound (a generated calendar knows its
  length from its parameters; a seed file has a fixed size). Anything else is left to
  adaptive execution, which broadcasts on measured runtime size or falls back to a
  shuffle join.
* A rollup "fact -> join dimension -> group by a dimension attribute" is computed as
  "fact -> partial aggregate by the foreign key -> join dimension -> re-aggregate". Sums and
  counts are decomposable, so the result is identical, but the join and the final shuffle
  see one row per key value instead of one row per fact: no big shuffle, and a foreign key
  that holds a third of the facts is just one more row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import col_

# Broadcast ceiling for dimensions whose row count is proven on the driver.
MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, row_bound: int | None,
                      max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast-hint ``df`` only when its row count is known to be at most ``max_rows``."""
    if row_bound is not None and row_bound <= max_rows:
        return F.broadcast(df)
    return df


@dataclass(frozen=True)
class Measure:
    """A decomposable aggregate. ``kind``: count | sum | count_if | avg."""
    name: str
    kind: str
    expr: Column | str | None = None

    def partials(self) -> list[Column]:
        p = f"_p_{self.name}"
        e = col_(self.expr) if self.expr is not None else None
        if self.kind == "count":
            return [F.count(e if e is not None else F.lit(1)).alias(p)]
        if self.kind == "sum":
            return [F.sum(e).alias(p)]
        if self.kind == "count_if":
            return [F.sum(F.when(e, 1).otherwise(0)).alias(p)]
        if self.kind == "avg":
            return [F.sum(e).alias(p + "_s"), F.count(e).alias(p + "_c")]
        raise ValueError(f"unknown measure kind {self.kind}")

    def final(self) -> Column:
        p = f"_p_{self.name}"
        if self.kind == "avg":
            return F.try_divide(F.sum(p + "_s").cast("double"), F.sum(p + "_c")).alias(self.name)
        return F.sum(p).alias(self.name)

    def direct(self) -> Column:
        """Single-phase form (for grouping without a dimension in between)."""
        e = col_(self.expr) if self.expr is not None else None
        if self.kind == "count":
            return F.count(e if e is not None else F.lit(1)).alias(self.name)
        if self.kind == "sum":
            return F.sum(e).alias(self.name)
        if self.kind == "count_if":
            return F.sum(F.when(e, 1).otherwise(0)).alias(self.name)
        return F.avg(e).alias(self.name)


def rollup_through_dimension(fact: DataFrame, dim: DataFrame, fk: str, pk: str,
                             group: list[Column], measures: list[Measure],
                             how: str = "left", post: list[Column] | None = None) -> DataFrame:
    """``SELECT group, measures FROM fact f {how} JOIN dim d ON d.pk = f.fk GROUP BY group``.

    Exact for count / sum / count_if / avg. ``how='inner'`` drops facts without a matching
    dimension row (and NULL keys); ``'left'`` keeps them with NULL dimension attributes.
    ``post`` are expressions over the aggregated columns (rates, rounding).
    """
    partial = fact.groupBy(F.col(fk).alias("_fk")).agg(*[p for m in measures for p in m.partials()])
    joined = partial.join(dim, partial["_fk"] == dim[pk], how)
    out = joined.groupBy(*group).agg(*[m.final() for m in measures])
    if post:
        out = out.select("*", *post)
    return out
