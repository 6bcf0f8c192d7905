"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (NULL for a NULL id)."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(mod))


def fold_is(id_col: Column, mod: int, value: int) -> Column:
    """Whether the id falls in the fold; a NULL id counts as held out, so it is never learnt from."""
    return F.coalesce(fold(id_col, mod) == value, F.lit(True))


def code_point_key(col: Column) -> Column:
    """A column that sorts and compares strings by code point (UTF-8 bytes sort alike)."""
    return F.hex(F.encode(col, "UTF-8"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read again.

    Cuts the lineage as a checkpoint does, in a third of the space, and later reads take only the
    columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files that no DataFrame needs any more are deleted now, not when the driver next collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def spread_join(rows: DataFrame, table: DataFrame, key: str, count: str = "n") -> DataFrame:
    """``rows`` with the columns of ``table`` (one row a key, with the number of rows that have it), if any.

    Keys that hold more than 1 / (4 p) of all rows, with p shuffle partitions, are fewer than 4 p: they
    are broadcast, and their rows stay where they are. The rest is joined by a shuffle, without a hot key.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = table.agg(F.sum(count)).first()[0] or 0
    heavy = F.col(count) * (4 * parts) > F.lit(total)
    added = [c for c in table.columns if c not in (key, count)]
    light = table.where(~heavy).drop(count)
    hot = F.broadcast(table.where(heavy).drop(count).withColumn("__hot", F.lit(True)))
    first = rows.join(hot, key, "left")
    rest = first.where(F.col("__hot").isNull() & F.col(key).isNotNull()).select(*rows.columns).join(light, key, "left")
    none = first.where(F.col("__hot").isNotNull() | F.col(key).isNull())
    return none.select(*rows.columns, *added).unionByName(rest.select(*rows.columns, *added))
