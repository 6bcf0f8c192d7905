"""Idempotent load of landed JSON lines into bronze.

Structured Streaming's file source remembers every file it committed in the checkpoint, so a
new file is seen exactly once. What is loaded is a landing *unit*: a batch folder
(``batch=<id>``) or a single file of the landing folder. When the stream reports a file of a unit,
the whole unit replaces that unit's rows in bronze. So a rerun adds nothing, a replayed
micro-batch writes the same rows again, and a batch landed twice under its id counts once.

All units of a micro-batch become visible together, in place of their old rows, by one new manifest
(:mod:`stratum.streaming.bronze`); a load that is killed before that has changed nothing that readers see.

The checkpoint and bronze folders must be on shared storage; by default they live under
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.session import at_most, delete_path, qualified
from stratum.sources.lines import SHUFFLED_BYTES_A_TASK, dealt_records
from stratum.sources.raw import EXTRA_COL, RAW_COLUMNS, extra_keys, promote_extra, with_load_columns
from stratum.streaming.bronze import UNIT, Manifest, commit, part_path, read_folders, read_manifest, write_part

# Landed files can be old (backfills); never skip a file for its age.
MAX_FILE_AGE = "36500d"
# Units written by one job; a backfill with more runs several.
UNITS_A_JOB = 50
BINARY_FILES = "path string, modificationTime timestamp, length long, content binary"
# A file of at most so many bytes may hold no line (compressed ones have a header all the same).
SMALL_FILE = 1024


def load_new_files(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint: str,
                   columns=RAW_COLUMNS, date_col: str = "crash_date",
                   partition_col: str = "crash_date_partition",
                   max_files_per_trigger: int | None = None, grow: bool = True) -> None:
    """Load every unit with a landed file not seen before, then stop (``availableNow``).

    Every file name is read (compressed ones too), but for those that begin with ``_`` or ``.``.
    With ``grow``, a JSON key that is not among ``columns`` becomes a bronze column; see
    :func:`stratum.sources.raw.extra_keys` for the bound.
    """
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILES).option("maxFileAge", MAX_FILE_AGE)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # names and lengths: the files themselves are not opened
    files = reader.load(landing_dir).select(F.col("_metadata.file_path").alias("file"), "length")
    root = qualified(spark, landing_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        seen = {unquote(r.file): r.length for r in batch.collect()}      # one row per new file
        small = {f for f, n in seen.items() if n <= SMALL_FILE}
        found = (seen.keys() - small) | (small & _with_lines(spark, root, {_below(f, root) for f in small}))
        units = sorted({_below(f, root) for f in found})
        if units:
            _replace_units(spark, root, bronze_path, units, columns, date_col, partition_col, grow)

    q = (files.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _below(file: str, root: str) -> str:
    """The first path component below the landing folder."""
    plain = file.split(":", 1)[-1].lstrip("/")
    base = root.split(":", 1)[-1].strip("/")
    return plain[len(base):].lstrip("/").split("/", 1)[0]


def _text(spark: SparkSession, root: str, unit: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(f"{root}/{unit}")


def _with_lines(spark: SparkSession, root: str, units: Iterable[str]) -> set[str]:
    """The small files of these units that hold a line: one without any brings nothing."""
    found: set[str] = set()
    for u in units:
        lines = _text(spark, root, u).where(F.col("_metadata.file_size") <= SMALL_FILE)
        found |= {unquote(r[0]) for r in lines.select("_metadata.file_path").distinct().collect()}
    return found


def _replace_units(spark: SparkSession, root: str, bronze_path: str, units: list[str], columns,
                   date_col: str, partition_col: str, grow: bool) -> None:
    state = read_manifest(spark, bronze_path)
    after = state.without_units(units)
    for k in range(0, len(units), UNITS_A_JOB):
        rows = _unit_rows(spark, root, units[k:k + UNITS_A_JOB], after, columns, date_col, partition_col, grow)
        after = _with_rows(spark, rows, bronze_path, state, after, partition_col, grow)
    commit(spark, bronze_path, after)


def _unit_rows(spark: SparkSession, root: str, units: list[str], state: Manifest, columns, date_col: str,
               partition_col: str, grow: bool) -> DataFrame:
    """Rows of these units; with ``grow``, with the columns that bronze has grown already."""
    lines = reduce(DataFrame.union, [_text(spark, root, u).select("value", F.lit(u).alias(UNIT)) for u in units])
    # dealt by unit and date as lines, which take less of a shuffle than parsed rows
    rows = with_load_columns(dealt_records(lines, UNIT, columns, date_col), date_col, partition_col)
    rows = rows.withColumn("load_id", F.col(UNIT))
    return promote_extra(rows, _new_columns(rows, state.columns.names)) if grow else rows


def _new_columns(rows: DataFrame, names: Iterable[str]) -> list[str]:
    """Of these names, those that become columns: one that differs from a column in case only stays aside."""
    taken, new = {c.lower() for c in rows.columns}, []
    for name in names:
        if name.lower() not in taken:
            taken.add(name.lower())
            new.append(name)
    return new


def _with_rows(spark: SparkSession, rows: DataFrame, bronze_path: str, state: Manifest, after: Manifest,
               partition_col: str, grow: bool) -> Manifest:
    """``after`` with the part that these rows are written to. Rows whose keys bronze has no column for are
    written again with them: the keys are known once all lines were read, and only then."""
    keys = Observation()
    seen = rows.observe(keys, F.max(F.size(EXTRA_COL)).alias("most")) if grow else rows
    with at_most(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLED_BYTES_A_TASK):
        part = write_part(spark, seen, bronze_path, state, partition_col, dealt=True)
    grown = after.with_columns(rows.schema).with_part(part)
    if grow and part and (keys.get["most"] or 0) > 0:
        stored = read_folders(spark, bronze_path, grown, part, partition_col)
        new = _new_columns(stored, extra_keys(stored))
        if new:
            stored = promote_extra(stored, new)
            grown = after.with_columns(rows.schema).with_columns(stored.schema).with_part(
                write_part(spark, stored, bronze_path, state, partition_col))
            delete_path(spark, part_path(bronze_path, part[0].part))
    return grown
