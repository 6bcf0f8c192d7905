"""Declarative data-quality checks with stored failing rows.

Semantics follow the usual generic data tests:

* ``not_null``            failures = rows where the column is NULL
* ``unique``              failures = distinct non-NULL values that occur more than once
* ``accepted_values``     failures = distinct non-NULL values outside the list
* ``expression_is_true``  failures = rows where ``NOT (column <expression>)`` is TRUE (NULL passes)
* ``relationships``       failures = non-NULL child rows without a parent row

Every check accepts an optional ``where`` that scopes it. All row-level checks of one table
(not_null, accepted_values, expression_is_true) are folded into ONE aggregate pass, and all
unique and relationships checks into one grouped pass over their keys, so a table is read twice
however many checks it has. Only the per-check failure counts (one row per check) reach the driver.

Failing rows are stored by one more read of a table, however many of its checks fail: each row is tagged
with the checks that it fails and written once for each of them. Values of unique and accepted_values
checks come from what was stored, not from the table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import delete_path, list_names, move_path, scratch_path


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    values: tuple = ()
    expression: str | None = None
    where: str | None = None
    parent: DataFrame | None = field(default=None, compare=False, hash=False)
    parent_column: str | None = None
    name: str | None = None


def check_name(check: Check, table: str) -> str:
    """Stable name: explicit ``name`` or ``<kind>_<table>_<column>[_<expression>]``."""
    if check.name:
        return check.name
    suffix = ""
    if check.kind == "expression_is_true":
        suffix = "_" + {">= 0": "ge_0", "> 0": "gt_0"}.get(
            check.expression, "".join(ch if ch.isalnum() else "_" for ch in check.expression))
    return f"{check.kind}_{table}_{check.column}{suffix}"


def not_null(column: str, where: str | None = None, name: str | None = None) -> Check:
    return Check("not_null", column, where=where, name=name)


def unique(column: str, where: str | None = None, name: str | None = None) -> Check:
    return Check("unique", column, where=where, name=name)


def accepted_values(column: str, values, where: str | None = None,
                    name: str | None = None) -> Check:
    return Check("accepted_values", column, values=tuple(values), where=where, name=name)


def expression_is_true(column: str, expression: str, where: str | None = None,
                       name: str | None = None) -> Check:
    return Check("expression_is_true", column, expression=expression, where=where, name=name)


def relationships(column: str, parent: DataFrame, parent_column: str,
                  where: str | None = None, name: str | None = None) -> Check:
    return Check("relationships", column, where=where, parent=parent,
                 parent_column=parent_column, name=name)


ROW_LEVEL = ("not_null", "accepted_values", "expression_is_true")
# Fold a table's unique and relationships checks into one GROUPING SETS aggregate (one scan).
FOLD_KEYS = True


def _scope(check: Check) -> Column:
    return F.expr(check.where) if check.where else F.lit(True)


def _row_fails(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*check.values)
    if check.kind == "expression_is_true":
        # NOT(expr) is NULL for NULL input; coalesce to FALSE so NULL passes.
        return F.coalesce(~F.expr(f"{check.column} {check.expression}"), F.lit(False))
    raise ValueError(check.kind)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows (or, for unique / accepted_values, the values with their counts) that fail."""
    scoped = df.where(F.expr(check.where)) if check.where else df
    c = F.col(check.column)
    if check.kind in ("not_null", "expression_is_true"):
        return scoped.where(_row_fails(check))
    if check.kind == "accepted_values":
        return (scoped.where(_row_fails(check)).groupBy(c.alias("value_field"))
                .agg(F.count(F.lit(1)).alias("n_records")))
    if check.kind == "unique":
        return (scoped.where(c.isNotNull()).groupBy(c.alias("unique_field"))
                .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))
    if check.kind == "relationships":
        orphans = _orphan_keys(scoped, check).select("_child_key")
        return scoped.join(orphans, c == F.col("_child_key"), "left_semi")
    raise ValueError(check.kind)


def _orphan_keys(scoped: DataFrame, check: Check) -> DataFrame:
    """Child keys (with their row counts) that have no parent.

    The child is first reduced to one row per key (partial aggregation collapses a key that
    holds a third of the rows on the map side), so the anti-join only moves distinct keys.
    """
    c = F.col(check.column)
    parent = check.parent.select(F.col(check.parent_column).alias("_parent_key")).distinct()
    keys = scoped.where(c.isNotNull()).groupBy(c.alias("_child_key")).agg(
        F.count(F.lit(1)).alias("_rows"))
    return keys.join(parent, F.col("_child_key") == F.col("_parent_key"), "left_anti")


def check_counts(df: DataFrame, checks, table: str, keys: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per check: (table_name, check_name, check_kind, column_name, failures BIGINT).

    ``keys`` is given the failing keys (``_key``, ``_n`` rows) of unique and relationships checks that were
    stored on the way, by name.
    """
    names = {id(c): check_name(c, table) for c in checks}
    parts: list[DataFrame] = []
    row_level = [c for c in checks if c.kind in ROW_LEVEL]
    if row_level:
        aggs = []
        for c in row_level:
            fails = _scope(c) & _row_fails(c)
            if c.kind == "accepted_values":
                agg = F.count_distinct(F.when(fails, F.col(c.column)))
            else:
                agg = F.count_if(fails)
            aggs.append(agg.cast("bigint").alias(names[id(c)]))
        one = df.agg(*aggs)
        stacked = one.select(F.explode(F.array(*[
            F.struct(F.lit(names[id(c)]).alias("check_name"), F.lit(c.kind).alias("check_kind"),
                     F.lit(c.column).alias("column_name"), F.col(names[id(c)]).alias("failures"))
            for c in row_level])).alias("r")).select("r.*")
        parts.append(stacked)
    # unique and relationships checks of one table: one more scan and one shuffle
    keyed = [c for c in checks if c.kind in ("unique", "relationships") and _of_key_only(df, c)]
    folded = {id(c) for c in keyed} if FOLD_KEYS and len(keyed) > 1 else set()
    if folded:
        parts.append(_key_check_counts(df, keyed, names, keys))
    for c in checks:
        if c.kind in ROW_LEVEL or id(c) in folded:
            continue
        if c.kind == "relationships":
            scoped = df.where(F.expr(c.where)) if c.where else df
            n = _orphan_keys(scoped, c).agg(
                F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("failures"))
        else:
            n = failing_rows(df, c).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
        parts.append(n.select(F.lit(names[id(c)]).alias("check_name"), F.lit(c.kind).alias("check_kind"),
                              F.lit(c.column).alias("column_name"), "failures"))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(table).alias("table_name"), "*")


def _of_key_only(df: DataFrame, check: Check) -> bool:
    """Whether the check's scope, if any, names no column but its own."""
    if not check.where:
        return True
    alone = df.sparkSession.createDataFrame([], T.StructType([df.schema[check.column]]))
    try:
        return bool(alone.where(F.expr(check.where)).columns)
    except AnalysisException:
        return False


def _key_check_counts(df: DataFrame, checks, names, keys: dict[str, DataFrame] | None = None) -> DataFrame:
    """Unique and relationships checks of one table, counted from its stored keys."""
    counts = []
    for c, failing in zip(checks, _failing_keys(df, checks)):
        if keys is not None:
            keys[names[id(c)]] = failing
        if c.kind == "unique":
            n = failing.agg(F.count(F.lit(1)).alias("failures"))
        else:
            n = failing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("failures"))
        counts.append(n.select(F.lit(names[id(c)]).alias("check_name"), F.lit(c.kind).alias("check_kind"),
                               F.lit(c.column).alias("column_name"), "failures"))
    return reduce(DataFrame.unionByName, counts)


def _failing_keys(df: DataFrame, checks) -> list[DataFrame]:
    """(_key, _n) that fail each unique or relationships check, from one ``GROUPING SETS ((a), (b), …)``.

    It counts every key once per set (partial aggregation first, so a hot value is one row per
    task). What the checks need of it is written to the shared scratch folder once: repeated keys
    for unique, all distinct keys for relationships. The checks then read that, not the table.
    """
    spark, cols = df.sparkSession, list(dict.fromkeys(c.column for c in checks))
    full = (1 << len(cols)) - 1         # grouping_id: bit i from the left is 1 if column i is not grouped
    gid = {c: full ^ (1 << (len(cols) - 1 - i)) for i, c in enumerate(cols)}
    foreign = {c.column for c in checks if c.kind == "relationships"}
    grouped = (df.groupingSets([[c] for c in cols], *cols)
               .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid"))
               .where((F.col("_n") > 1) | F.col("_gid").isin([gid[c] for c in foreign])))
    path = scratch_path(spark, "check-keys")
    grouped.write.partitionBy("_gid").parquet(path)
    stored = spark.read.schema(grouped.schema).parquet(path)
    found = []
    for c in checks:
        own = stored.where((F.col("_gid") == gid[c.column]) & F.col(c.column).isNotNull())
        if c.where:
            own = own.where(F.expr(c.where))
        own = own.select(F.col(c.column).alias("_key"), "_n")
        if c.kind == "unique":
            found.append(own.where(F.col("_n") > 1))
        else:
            parent = c.parent.select(F.col(c.parent_column).alias("_parent_key")).distinct()
            found.append(own.join(parent, F.col("_key") == F.col("_parent_key"), "left_anti"))
    return found


def store_failing(df: DataFrame, checks, table: str, audit_path: str, keys: dict[str, DataFrame] | None = None) -> None:
    """Write what fails each of these checks of a table under ``audit_path/<check>``, from one read of it.

    A row that fails several checks is written for each. Rows of relationships checks are found by their
    orphan keys, rows of the others by their condition. ``keys`` has failing keys that are known; those
    of other unique and relationships checks are grouped first, in one read for all of them (a check whose
    scope names other columns: one of its own).
    """
    spark, keys, audit_path = df.sparkSession, dict(keys or {}), audit_path.rstrip("/")
    keyed = [c for c in checks if c.kind in ("unique", "relationships") and check_name(c, table) not in keys]
    together = [c for c in keyed if _of_key_only(df, c)]
    if together:
        keys |= {check_name(c, table): k for c, k in zip(together, _failing_keys(df, together))}
    rows, conditions = df, {}
    for n, c in enumerate(checks):
        name = check_name(c, table)
        if c.kind in ROW_LEVEL:
            conditions[n] = _scope(c) & _row_fails(c)
        elif name not in keys:
            failing_rows(df, c).write.mode("overwrite").parquet(f"{audit_path}/{name}")
        elif c.kind == "unique":
            (keys[name].select(F.col("_key").alias("unique_field"), F.col("_n").alias("n_records"))
             .write.mode("overwrite").parquet(f"{audit_path}/{name}"))
        else:
            mark = f"__orphan_{n}"
            orphans = keys[name].select(F.col("_key").alias(f"{mark}_key"), F.lit(True).alias(mark))
            rows = rows.join(orphans, F.col(c.column) == F.col(f"{mark}_key"), "left")
            conditions[n] = _scope(c) & F.col(mark).isNotNull()
    if not conditions:
        return
    tags = F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in conditions.items()]))
    draft = f"{audit_path}/_draft-{uuid.uuid4().hex[:12]}"
    (rows.select(*[rows[f"`{c}`"] for c in df.columns], F.explode(tags).alias("__check"))
     .write.partitionBy("__check").parquet(draft))
    written = set(list_names(spark, draft))
    for n in conditions:
        folder, target = f"__check={n}", f"{audit_path}/{check_name(checks[n], table)}"
        if folder not in written:
            continue
        if checks[n].kind == "accepted_values":
            (spark.read.schema(df.schema).parquet(f"{draft}/{folder}")
             .groupBy(F.col(checks[n].column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
             .write.mode("overwrite").parquet(target))
        else:
            delete_path(spark, target)
            move_path(spark, f"{draft}/{folder}", target)
    delete_path(spark, draft)


class ChecksFailed(AssertionError):
    def __init__(self, failures: list[tuple[str, str, int]]):
        self.failures = failures
        lines = ", ".join(f"{t}.{n}={k}" for t, n, k in failures)
        super().__init__(f"{len(failures)} check(s) failed: {lines}")


def run_checks(suite: dict, audit_path: str | None = None, raise_on_failure: bool = True) -> DataFrame:
    """Run ``{table_name: (df, [checks])}``; store failing rows under ``audit_path/<check>``.

    Returns the per-check counts (already computed: one small row per check). Raises
    :class:`ChecksFailed` after storing the failing rows when any check fails (the build
    fails, the evidence stays).
    """
    keys: dict[str, dict[str, DataFrame]] = {table: {} for table in suite}
    counts = reduce(DataFrame.unionByName,
                    [check_counts(df, checks, table, keys[table]) for table, (df, checks) in suite.items()])
    rows = counts.collect()  # one small row per check
    failed = [(r.table_name, r.check_name, r.failures) for r in rows if r.failures]
    if failed and audit_path:
        for table, (df, checks) in suite.items():
            names = {name for t, name, _ in failed if t == table}
            if names:
                store_failing(df, [c for c in checks if check_name(c, table) in names], table, audit_path, keys[table])
    if failed and raise_on_failure:
        raise ChecksFailed(failed)
    return counts.sparkSession.createDataFrame(rows, counts.schema)
