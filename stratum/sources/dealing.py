"""Dealing rows of a scan over more tasks than its files allow.

A scan cannot be cut below a file's row group, however small its splits are. Where one task would get more
rows than it can sort in memory, runs of consecutive rows are dealt over more tasks while rows are still as
narrow as they are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS_A_TASK = 1_250_000     # of a feed row's 500 to 600 bytes: what a core with 1 GB sorts without spilling
RUN_BITS = 17                   # a run has 2^17 rows: rows that are stored together mostly stay together
# Up to this many tasks a shuffle is written as rows come, above it they are held and sorted first. The one
# task that reads a row group does all of its rows, so this is the time that more cores do not shorten.
TASKS = 200
GOLDEN = 0.6180339887498949     # multiples of it, modulo 1, lie evenly however many there are


def deal_large_parts(df: DataFrame, most: int | None = None, run_bits: int | None = None) -> DataFrame:
    """The same rows; dealt in runs if any task of ``df`` has more than ``most`` rows, else ``df`` itself.

    The rows of each task are counted first (of a parquet scan: from its footers); one row reaches the
    driver. A task's runs go round the new tasks in turn: one run each, or several beyond :data:`TASKS`
    runs, and more tasks only where that would give one more than ``most`` rows.
    """
    most, run_bits = most or MAX_ROWS_A_TASK, run_bits or RUN_BITS
    counted = df.groupBy(F.spark_partition_id().alias("part")).count()
    found = counted.agg(F.max("count").alias("largest"), F.sum("count").alias("rows")).first()
    if not found.largest or found.largest <= most:
        return df
    runs = -(-found.rows // (1 << run_bits))
    n = max(min(runs, TASKS), -(-runs // max(1, most >> run_bits)))
    # the id has the task's number in its upper bits and counts its rows in the lower 33
    run = F.shiftright(F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1), run_bits)
    start = F.floor(F.spark_partition_id() * F.lit(GOLDEN) * n)
    return df.withColumn("__task", F.pmod(run + start, F.lit(n)).cast("int")).repartitionById(n, "__task").drop("__task")
