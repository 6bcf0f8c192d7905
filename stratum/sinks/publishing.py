"""Publish all tables of a build as one state.

Each published name is a view over a table of its own that holds the builds side by side as partitions
(column ``build``), read from the folders where they were written. Every view takes the build that one
pointer names, ``<prefix>published``, a table of one row. Publishing adds the new build's folders to the
tables, which no view shows yet, and then moves the pointer: one catalog update that changes all names
together. A publish that fails, or is killed, before that leaves every name on the build before.

The view's condition is a subquery over the pointer on the partition column, so a query reads only
the files of the published build. Columns that a build brings are added to the table (older builds have
NULL there); a column that changes its type is refused before anything is written.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratum.session import list_names

BUILD = "build"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"     # how a folder is named whose partition value is NULL
PARTITIONS_A_STATEMENT = 200


@dataclass(frozen=True)
class Published:
    """A table of a build: its columns, and the folders of its partitions with their values (in order
    of ``partitioned_by``; one folder with no values for a table without partitions)."""
    columns: T.StructType
    folders: list[tuple[tuple[str | None, ...], str]]
    partitioned_by: tuple[str, ...] = ()


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition(columns: Iterable[str], values: Iterable[str | None]) -> str:
    spec = [f"`{c}`={'NULL' if v in (None, NO_VALUE) else _quoted(v)}" for c, v in zip(columns, values)]
    return f"PARTITION ({', '.join(spec)})"


def _listed(fields: Iterable[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def pointer_name(prefix: str) -> str:
    return f"{prefix}published"


def builds_name(prefix: str, name: str) -> str:
    return f"{prefix}{name}__builds"


def published_build(spark: SparkSession, prefix: str) -> str | None:
    """The build that all names show now."""
    if not spark.catalog.tableExists(pointer_name(prefix)):
        return None
    row = spark.table(pointer_name(prefix)).first()
    return row[0] if row else None


def publish_build(spark: SparkSession, prefix: str, build: str, tables: dict[str, Published], folder: str) -> None:
    """Publish a build's tables as ``<prefix><name>``; ``folder`` is the build's own (the pointer's row is
    written below it)."""
    for name, table in tables.items():
        _check_types(spark, builds_name(prefix, name), table)
    for name, table in tables.items():
        _add_build(spark, builds_name(prefix, name), build, table, f"{folder}/_catalog/{name}")
    pointer = f"{folder}/_pointer"
    row = spark.createDataFrame([(build, prefix)], f"{BUILD} string, prefix string")
    row.coalesce(1).write.mode("overwrite").parquet(pointer)
    if not spark.catalog.tableExists(pointer_name(prefix)):
        empty = f"{folder}/_catalog/_no_build"
        row.limit(0).write.mode("overwrite").parquet(empty)
        spark.sql(f"CREATE TABLE {pointer_name(prefix)} ({BUILD} string, prefix string) USING parquet "
                  f"LOCATION {_quoted(empty)}")
    for name, table in tables.items():
        _show(spark, prefix, name, table)
    _move_pointer(spark, prefix, pointer)


def _move_pointer(spark: SparkSession, prefix: str, pointer: str) -> None:
    spark.sql(f"ALTER TABLE {pointer_name(prefix)} SET LOCATION {_quoted(pointer)}")
    spark.catalog.refreshTable(pointer_name(prefix))


def _check_types(spark: SparkSession, table_name: str, table: Published) -> None:
    if not spark.catalog.tableExists(table_name):
        return
    stored = {f.name.lower(): f.dataType.simpleString() for f in spark.table(table_name).schema}
    for f in table.columns:
        was, now = stored.get(f.name.lower()), f.dataType.simpleString()
        if was not in (None, now):
            raise ValueError(f"{table_name}.{f.name} was {was} and is now {now}: publish it under another prefix")


def _add_build(spark: SparkSession, table_name: str, build: str, table: Published, home: str) -> None:
    data = [f for f in table.columns if f.name not in table.partitioned_by]
    keys = [table.columns[c] for c in table.partitioned_by]
    if not spark.catalog.tableExists(table_name):
        spark.sql(f"CREATE TABLE {table_name} ({_listed([*data, T.StructField(BUILD, T.StringType()), *keys])}) "
                  f"USING parquet PARTITIONED BY ({', '.join(f'`{c}`' for c in (BUILD, *table.partitioned_by))}) "
                  f"LOCATION {_quoted(home)}")
    stored = {f.name.lower() for f in spark.table(table_name).schema}
    new = [f for f in data if f.name.lower() not in stored]
    if new:
        spark.sql(f"ALTER TABLE {table_name} ADD COLUMNS ({_listed(new)})")
    for k in range(0, len(table.folders), PARTITIONS_A_STATEMENT):
        clauses = []
        for values, path in table.folders[k:k + PARTITIONS_A_STATEMENT]:
            spec = _partition((BUILD, *table.partitioned_by), (build, *values))
            clauses.append(f"{spec} LOCATION {_quoted(path)}")
        spark.sql(f"ALTER TABLE {table_name} ADD IF NOT EXISTS {' '.join(clauses)}")
    spark.catalog.refreshTable(table_name)


def _show(spark: SparkSession, prefix: str, name: str, table: Published) -> None:
    """The view of a name, made once and again only when columns have come."""
    view, wanted = f"{prefix}{name}", [f.name for f in spark.table(builds_name(prefix, name)).schema if f.name != BUILD]
    if spark.catalog.tableExists(view):
        if spark.catalog.getTable(view).tableType != "VIEW":
            spark.sql(f"DROP TABLE {view}")         # published by an earlier way; its files stay
        elif spark.table(view).columns == wanted:
            return
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(f'`{c}`' for c in wanted)} "
              f"FROM {builds_name(prefix, name)} WHERE {BUILD} = (SELECT max({BUILD}) FROM {pointer_name(prefix)})")


def forget_build(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    """Take a build's folders out of the tables that it was published in, before they are deleted."""
    for build, prefix in spark.read.schema(f"{BUILD} string, prefix string").parquet(f"{folder}/_pointer").collect():
        for table_name in (builds_name(prefix, n) for n in names):
            if not spark.catalog.tableExists(table_name):
                continue
            found = spark.sql(f"SHOW PARTITIONS {table_name} PARTITION ({BUILD}={_quoted(build)})").collect()
            specs = [_partition(*zip(*[(c, unquote(v)) for c, v in (p.split("=", 1) for p in r[0].split("/"))]))
                     for r in found]
            for k in range(0, len(specs), PARTITIONS_A_STATEMENT):
                spark.sql(f"ALTER TABLE {table_name} DROP IF EXISTS {', '.join(specs[k:k + PARTITIONS_A_STATEMENT])}")
            spark.catalog.refreshTable(table_name)


def stored_table(spark: SparkSession, df: DataFrame, path: str, partitioned_by: str | None = None) -> Published:
    """A table written to ``path``; its partitions are read from the names of its folders."""
    if not partitioned_by:
        return Published(df.schema, [((), path)])
    names = sorted(n for n in list_names(spark, path) if n.startswith(f"{partitioned_by}="))
    values = [unquote(n.split("=", 1)[1]) for n in names]
    return Published(df.schema, [((None if v == NO_VALUE else v,), f"{path}/{n}") for v, n in zip(values, names)],
                     (partitioned_by,))
