"""Table sinks: partitioned full-refresh writes (L11, L13), views (L14), compaction."""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def write_table(df: DataFrame, path: str | None = None, table: str | None = None,
                partition_by: str | None = None, mode: str = "overwrite", dealt: bool = False) -> None:
    """Full-refresh write to a path or a catalog table, zstd compressed.

    With a partition column the rows are rebalanced on it first: adaptive execution then
    writes about one advisory-sized file per partition value, splitting a hot date into
    several files and merging sparse ones, instead of one file per task per date. ``dealt`` says that
    the rows of a value are together already.
    """
    out = df.hint("rebalance", partition_by) if partition_by and not dealt else df
    w = out.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(partition_by)
    if table:
        w.saveAsTable(table) if path is None else w.option("path", path).saveAsTable(table)
    elif path:
        w.parquet(path)
    else:
        raise ValueError("give a path or a table name")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A lazily evaluated staging view (``CREATE OR REPLACE TEMP VIEW``)."""
    df.createOrReplaceTempView(name)
    return df


def read_typed(spark: SparkSession, path: str, types: dict[str, str] | None = None,
               merge_schema: bool = False) -> DataFrame:
    """A parquet table whose partition columns keep their written text unless a type is given.

    Partition-type inference would read ``zip=01001`` as the number 1001; here a partition column is
    a STRING, or the declared type. ``types`` may name data columns too (left as stored).
    """
    found = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    stored = {f.name for f in found.schema.fields if f.name not in _partition_columns(found, path)}
    fields = [f if f.name in stored else
              T.StructField(f.name, T._parse_datatype_string((types or {}).get(f.name, "string")), True)
              for f in found.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _partition_columns(df: DataFrame, path: str) -> set[str]:
    """Partition columns, read from the folder names below ``path`` of one file (in every file alike)."""
    some = df.select(F.col("_metadata.file_path")).limit(1).collect()
    if not some:
        return set()
    root = [p for p in unquote(path.rstrip("/")).split("/") if p][-1]
    parts = unquote(some[0][0]).split("/")[:-1]
    below = parts[len(parts) - parts[::-1].index(root):] if root in parts else []
    return {p.split("=", 1)[0] for p in below if "=" in p}


def compact(spark: SparkSession, src: str, dst: str, partition_col: str,
            schema: T.StructType | None = None) -> DataFrame:
    """Bin-pack small files into a NEW location (readers of ``src`` are never disturbed;
    switch readers to ``dst`` afterwards). Returns the compacted table.

    Partition values keep their text; ``schema`` declares the table's types (the partition column
    is a STRING without it).
    """
    types = {f.name: f.dataType.simpleString() for f in schema.fields} if schema else None
    df = read_typed(spark, src, types)
    df.hint("rebalance", partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(dst)
    return spark.read.schema(df.schema).parquet(dst)


def file_count(spark: SparkSession, path: str) -> int:
    """Number of data files behind a parquet table (one small row per file)."""
    return spark.read.parquet(path).select(F.input_file_name()).distinct().count()


def publish_table(spark: SparkSession, name: str, path: str) -> None:
    """Make ``name`` show a fully written parquet folder, in one catalog update.

    Unpartitioned: an external table whose location is set. Partitioned (seen from the folder
    names): an external table of its own for each folder, with its partitions registered, behind a
    view ``name`` that is replaced at once, so readers never find the name gone. Folders of
    earlier versions, and their tables, stay as they are.
    """
    found = spark.read.parquet(path)
    partitioned = sorted(_partition_columns(found, path))
    exists = spark.catalog.tableExists(name)
    is_view = exists and spark.catalog.getTable(name).tableType == "VIEW"
    if not partitioned:
        if is_view:
            spark.sql(f"DROP VIEW {name}")
        if exists and not is_view:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        spark.catalog.refreshTable(name)
        return
    version = f"{name}__{hashlib.sha256(path.encode()).hexdigest()[:12]}"
    if not spark.catalog.tableExists(version):
        spark.sql(f"CREATE TABLE {version} USING parquet LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {version} RECOVER PARTITIONS")
    spark.catalog.refreshTable(version)
    if exists and not is_view:
        spark.sql(f"DROP TABLE {name}")          # an unpartitioned table of that name; its files stay
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
