"""Incremental extraction: load window (L1), high-water mark (L2), ordered paging (L3, O3).

The window and the mark are computed on the driver from parameters and one aggregated row;
the rows themselves never leave the executors.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import delete_path, list_names, put_new_file, read_file, scratch_path

# --- fixed values -------------------------------------------------------------------------
INITIAL_LOAD_DAYS = 365   # first run / full reload reaches back one year
PAGE_SIZE = 50_000        # rows per page
# -------------------------------------------------------------------------------------------


def _midnight(d) -> dt.datetime:
    if isinstance(d, dt.datetime):
        return dt.datetime(d.year, d.month, d.day)
    if isinstance(d, dt.date):
        return dt.datetime(d.year, d.month, d.day)
    return _midnight(dt.date.fromisoformat(str(d)[:10]))


def load_window(today, mark=None, initial_days: int = INITIAL_LOAD_DAYS, lookback_days: int = 0,
                full_reload: bool = False):
    """``(start, end)`` of the next extraction, or ``None`` when already up to date.

    end = today 00:00 minus one second; start = the saved mark (a date, at midnight), or
    today minus ``initial_days`` on the first run / full reload. ``lookback_days`` re-reads
    a tail before the mark (late rows); the keep-latest dedupe absorbs the repeats.
    """
    today0 = _midnight(today)
    end = today0 - dt.timedelta(seconds=1)
    if full_reload or mark is None:
        start = today0 - dt.timedelta(days=initial_days)
    else:
        start = _midnight(mark) - dt.timedelta(days=lookback_days)
    return None if start >= end else (start, end)


def ts_literal(value, data_type: T.DataType) -> Column:
    """A timestamp literal of the column's own type (NTZ stays NTZ: zone-free, pushable)."""
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast(data_type)


def incremental_window(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Half-open ``ts > start AND ts <= end``; both bounds reach the parquet scan."""
    t = df.schema[ts_col].dataType
    c = F.col(ts_col)
    return df.where((c > ts_literal(start, t)) & (c <= ts_literal(end, t)))


def high_water_mark(batch: DataFrame, ts_col: str, window_end, old_mark=None) -> DataFrame:
    """One row ``(batch_rows, new_mark)``: the batch's max non-NULL ``ts`` as a DATE.

    Empty batch -> the window end's date (nothing more to fetch up to there); a batch whose
    timestamps are all NULL keeps the old mark instead of failing.
    """
    end_date = F.lit(_midnight(window_end).date())
    old = F.lit(_midnight(old_mark).date()) if old_mark is not None else F.lit(None).cast("date")
    n = F.count(F.lit(1))
    mx = F.max(ts_col)
    return batch.agg(
        n.alias("batch_rows"),
        F.when(n == 0, end_date).when(mx.isNull(), old).otherwise(F.to_date(mx)).alias("new_mark"))


def _mark_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of the saved mark, oldest first."""
    return sorted(int(n[:-5]) for n in list_names(spark, path) if n.endswith(".json") and n[:-5].isdigit())


def _mark_file(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{version:010d}.json"


def write_mark(mark: DataFrame, path: str, keep: int = 10) -> None:
    """Save the one-row mark (plus ``updated_at``) as the next version; call only after the batch landed.

    Marks are only ever added: the new one appears whole, by one rename that fails if another run has
    written that version, and the marks before stay until it is there. So a run that is killed here
    leaves the mark before. Versions but the newest ``keep`` are deleted afterwards.
    """
    spark = mark.sparkSession
    row = mark.select(F.col("new_mark").cast("string").alias("last_crash_date"),
                      F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("updated_at")).first()
    versions = _mark_versions(spark, path)
    put_new_file(spark, _mark_file(path, max(versions, default=0) + 1), json.dumps(row.asDict()))
    for old in versions[:max(0, len(versions) + 1 - keep)]:
        delete_path(spark, _mark_file(path, old))


def read_mark(spark: SparkSession, path: str):
    """The newest saved mark as a ``date``, or ``None`` when no state exists yet."""
    versions = _mark_versions(spark, path)
    found = json.loads(read_file(spark, _mark_file(path, versions[-1]))) if versions else {}
    return dt.date.fromisoformat(found["last_crash_date"]) if found.get("last_crash_date") else None


def page(df: DataFrame, order: list, size: int = PAGE_SIZE, n: int = 0,
         strategy: str = "top_k") -> DataFrame:
    """Page ``n`` (0-based) of ``size`` rows in ``order``, sorted; any columns are allowed.

    ``top_k`` (lazy) plans as ``TakeOrderedAndProject``: every task keeps ``offset + size`` rows,
    which suits the first pages. ``numbered`` numbers all rows first, as :func:`page_numbers`
    does, and suits a deep page; to read many pages, store the table once by :func:`write_page_index`.
    """
    if strategy == "top_k":
        return df.orderBy(*order).offset(n * size).limit(size)
    if strategy != "numbered":
        raise ValueError(f"unknown strategy {strategy}")
    rows = _numbered(df, order, "__row_no").where(F.col("__row_no").between(n * size + 1, (n + 1) * size))
    return rows.orderBy("__row_no").drop("__row_no")


def page_numbers(df: DataFrame, order: list[str], size: int = PAGE_SIZE,
                 partitions: int | None = None) -> DataFrame:
    """Every row with its global ``row_no`` (1-based) and ``page_no`` in ``order``, which must be
    a total order (end it with a unique key). Columns of these names must not exist yet."""
    if clash := {"row_no", "page_no"} & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    return _numbered(df, order, "row_no", partitions).select(
        "*", F.floor((F.col("row_no") - 1) / size).cast("long").alias("page_no"))


def _partitions(spark: SparkSession) -> int:
    """The shuffle partition setting, or the parallelism where it is not a number."""
    text = spark.conf.get("spark.sql.shuffle.partitions")
    return int(text) if str(text).isdigit() else spark.sparkContext.defaultParallelism


def _numbered(df: DataFrame, order: list, name: str, partitions: int | None = None) -> DataFrame:
    """Rows with their global position, without a single-partition window.

    Rows are range-partitioned on the full ordering key (the sampled bounds split even one day
    that holds a third of the rows), sorted within each partition and written to the shared
    scratch folder, so positions survive recomputation. A count per partition (one row each: a
    proven bound), read from one column, gives each partition's offset.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    position = F.monotonically_increasing_id()
    (df.repartitionByRange(partitions or _partitions(spark), *order).sortWithinPartitions(*order)
     .select("*", F.spark_partition_id().alias("__part"),
             (position - F.shiftleft(F.spark_partition_id().cast("long"), 33) + 1).alias("__at"))
     .write.parquet(path))
    ranged = spark.read.parquet(path)
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return (ranged.join(F.broadcast(offsets), "__part")
            .select(*df.columns, (F.col("__offset") + F.col("__at")).alias(name)))


@dataclass(frozen=True)
class PageIndex:
    """A table stored in order, with the number of rows of each of its parts, so that a page is read from
    its own files. ``rows[k]`` are the rows of part k; the parts follow each other."""
    path: str
    order: tuple[str, ...]
    size: int
    rows: tuple[int, ...]
    columns: T.StructType

    @property
    def total(self) -> int:
        return sum(self.rows)

    @property
    def pages(self) -> int:
        return -(-self.total // self.size)

    def parts_of(self, n: int) -> list[tuple[int, int, int]]:
        """(part, first row, last row in it) of page n, rows counted from 1."""
        first, last, before, found = n * self.size + 1, (n + 1) * self.size, 0, []
        for part, rows in enumerate(self.rows):
            a, z = max(first - before, 1), min(last - before, rows)
            if a <= z:
                found.append((part, a, z))
            before += rows
            if before >= last:
                break
        return found

    def page(self, spark: SparkSession, n: int) -> DataFrame:
        """Rows of page n (0-based) in order; only the files that hold them are read."""
        parts = self.parts_of(n)
        if not parts:
            return spark.createDataFrame([], self.columns)
        stored = T.StructType([*self.columns, T.StructField("__at", T.LongType()), T.StructField("__part", T.IntegerType())])
        rows = (spark.read.schema(stored).option("basePath", f"{self.path}/rows")
                .parquet(*[f"{self.path}/rows/__part={k}" for k, _, _ in parts]))
        here = reduce(lambda a, b: a | b, [(F.col("__part") == k) & F.col("__at").between(a, z) for k, a, z in parts])
        return rows.where(here).orderBy("__part", "__at").select(*[F.col(f"`{c}`") for c in self.columns.names])


def write_page_index(df: DataFrame, order: list[str], path: str, size: int = PAGE_SIZE,
                     partitions: int | None = None) -> PageIndex:
    """Store ``df`` in ``order`` (a total order: end it with a unique key) under a new folder and number it
    once; :meth:`PageIndex.page` then reads any page. Rows are dealt by range partitions, a part each, and
    sorted in them, so row groups within a part are pruned by place as well."""
    spark, path = df.sparkSession, path.rstrip("/")
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33) + 1
    (df.repartitionByRange(partitions or _partitions(spark), *order).withColumn("__part", F.spark_partition_id())
     .sortWithinPartitions("__part", *order).withColumn("__at", place)
     .write.mode("errorifexists").partitionBy("__part").parquet(f"{path}/rows"))
    stored = T.StructType([*df.schema, T.StructField("__at", T.LongType()), T.StructField("__part", T.IntegerType())])
    counts = dict(tuple(r) for r in spark.read.schema(stored).parquet(f"{path}/rows")
                  .groupBy("__part").count().collect())        # one row a part
    rows = [counts.get(k, 0) for k in range(max(counts, default=-1) + 1)]
    put_new_file(spark, f"{path}/index.json", json.dumps(
        {"order": order, "size": size, "rows": rows, "columns": df.schema.jsonValue()}))
    return PageIndex(path, tuple(order), size, tuple(rows), df.schema)


def read_page_index(spark: SparkSession, path: str) -> PageIndex:
    """The index written under ``path``; it is there only if its table was written whole."""
    path = path.rstrip("/")
    found = json.loads(read_file(spark, f"{path}/index.json"))
    return PageIndex(path, tuple(found["order"]), found["size"], tuple(found["rows"]),
                     T.StructType.fromJson(found["columns"]))


def ingest(source: DataFrame, ts_col: str, landing_dir: str, state_path: str, today,
           batch_id: str, full_reload: bool = False, lookback_days: int = 0,
           initial_days: int = INITIAL_LOAD_DAYS, land=None) -> dict:
    """One incremental extraction run: window -> land the batch -> advance the mark.

    The mark is written only after the batch landed, so a failed landing retries the same
    window next run. An empty window writes no file and moves the mark to the window end.
    Only the one-row mark aggregate reaches the driver.
    """
    from stratum.sources.landing import land_jsonl
    land = land or land_jsonl
    spark = source.sparkSession
    mark = None if full_reload else read_mark(spark, state_path)
    window = load_window(today, mark, initial_days=initial_days, lookback_days=lookback_days,
                         full_reload=full_reload)
    if window is None:
        return {"status": "up_to_date", "mark": mark}
    start, end = window
    batch = incremental_window(source, ts_col, start, end)
    stats = high_water_mark(batch, ts_col, end, old_mark=mark)
    row = stats.first()
    if row.batch_rows:
        land(batch, landing_dir, batch_id)
    write_mark(spark.createDataFrame([(row.new_mark,)], "new_mark date"), state_path)
    return {"status": "landed" if row.batch_rows else "empty", "rows": row.batch_rows,
            "window": (start, end), "mark": row.new_mark}
