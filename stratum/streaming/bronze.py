"""Bronze: immutable folders named by a versioned manifest.

A load or a compaction writes a part of its own, ``parts/part=<id>/load_id=<unit>/<date partition>/``,
and then one new manifest ``manifest/<version>.json`` that lists the live folders, in one rename that
fails if that version exists. Readers take the newest manifest, so they see the state before or after a
write and never one in between; a job that is killed leaves a part that no manifest names.

A landing unit is replaced by dropping its folders from the manifest and naming those of its new part.
Rows that a compaction has packed with other units' into one folder a date are masked: the folder's
entry names the units whose rows no longer count, and reads leave them out. So a load writes the rows of
its own units and nothing else. :func:`compact_bronze` packs only dates with many small files, or with
masked rows, and carries the entries of all other dates over.

The manifest also holds the table's columns, to which a load adds those that it brings; reads therefore
merge no file footers. One entry a live folder is read on the driver: with compaction about one a date.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace
from math import ceil
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import delete_path, list_names, put_new_file, read_file

UNIT = "_load"
MERGED = "merged"
PART = "part"
DATE_PARTITION = "crash_date_partition"
FILE_BYTES = 128 * 1024 ** 2        # a date with twice the files that its bytes need is packed


@dataclass(frozen=True)
class Folder:
    """A folder of one date below ``parts/``: the units in it, and those of them whose rows are masked."""
    path: str
    units: tuple[str, ...]
    files: int
    size: int
    masked: tuple[str, ...] = ()

    @property
    def part(self) -> str:
        return self.path.split("/", 1)[0].split("=", 1)[1]

    @property
    def date(self) -> str:
        return unquote(self.path.rsplit("/", 1)[1].split("=", 1)[1])


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    columns: T.StructType = field(default_factory=T.StructType)
    folders: tuple[Folder, ...] = ()
    written: dict[str, int] = field(default_factory=dict)      # part -> number of folders it was written with

    def with_columns(self, columns: T.StructType) -> Manifest:
        known = {f.name.lower() for f in self.columns}
        return replace(self, columns=T.StructType(
            [*self.columns, *[f for f in columns if f.name.lower() not in known]]))

    def without_units(self, units: Iterable[str]) -> Manifest:
        """Folders of these units alone go; of packed ones their rows are masked."""
        gone, kept = set(units), []
        for f in self.folders:
            live = [u for u in f.units if u not in gone and u not in f.masked]
            if live:
                kept.append(replace(f, masked=tuple(u for u in f.units if u not in live)))
        return replace(self, folders=tuple(kept))

    def with_part(self, folders: list[Folder]) -> Manifest:
        written = self.written | {f.part: sum(g.part == f.part for g in folders) for f in folders[:1]}
        return replace(self, folders=(*self.folders, *folders), written=written)


def _versions(spark: SparkSession, bronze_path: str) -> list[int]:
    names = list_names(spark, f"{bronze_path.rstrip('/')}/manifest")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest_file(bronze_path: str, version: int) -> str:
    return f"{bronze_path.rstrip('/')}/manifest/{version:010d}.json"


def parts_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}/parts"


def part_path(bronze_path: str, part: str) -> str:
    return f"{parts_path(bronze_path)}/{PART}={part}"


def read_manifest(spark: SparkSession, bronze_path: str, version: int | None = None) -> Manifest:
    """The newest state of bronze (version 0, without folders, before the first load)."""
    if version is None:
        version = max(_versions(spark, bronze_path), default=0)
    if not version:
        return Manifest()
    found = json.loads(read_file(spark, _manifest_file(bronze_path, version)))
    folders = tuple(Folder(**f | {"units": tuple(f["units"]), "masked": tuple(f["masked"])}) for f in found["folders"])
    return Manifest(version, T.StructType.fromJson(found["columns"]), folders, found["written"])


def commit(spark: SparkSession, bronze_path: str, state: Manifest) -> Manifest:
    """Make ``state`` the newest one. If another job has written the next version meanwhile, this fails
    and nothing has changed."""
    live = {f.part for f in state.folders}
    state = replace(state, version=state.version + 1, written={p: n for p, n in state.written.items() if p in live})
    text = json.dumps({"columns": state.columns.jsonValue(), "written": state.written,
                       "folders": [asdict(f) for f in state.folders]}, ensure_ascii=False)
    put_new_file(spark, _manifest_file(bronze_path, state.version), text)
    return state


def write_part(spark: SparkSession, rows: DataFrame, bronze_path: str, state: Manifest,
               partition_col: str = DATE_PARTITION, units_of: dict[str, set[str]] | None = None,
               dealt: bool = False) -> list[Folder]:
    """Write rows (with a column ``load_id``) as a part of their own; entries for its folders.

    ``units_of`` gives the units packed into each date; else a folder holds the unit of its load_id.
    ``dealt`` says that the rows of a unit and date are together already.
    """
    part = f"{state.version + 1:010d}-{uuid.uuid4().hex[:8]}"
    base = part_path(bronze_path, part)
    # one file per unit and date (hot dates split by adaptive execution), not one per task
    rows = rows if dealt else rows.hint("rebalance", "load_id", partition_col)
    (rows.write.mode("errorifexists").option("compression", "zstd")
     .partitionBy("load_id", partition_col).parquet(base))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    below = F.substring_index(F.substring_index("path", f"/{PART}={part}/", -1), "/", 2)
    out = []
    for r in files.groupBy(below.alias("folder")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size")).collect():
        entry = Folder(f"{PART}={part}/{r.folder}", (unquote(r.folder.split("/")[0].split("=", 1)[1]),), r.n, r.size)
        out.append(replace(entry, units=tuple(sorted(units_of[entry.date]))) if units_of else entry)
    return sorted(out, key=lambda f: f.path)


def _roots(state: Manifest, folders: Iterable[Folder]) -> list[str]:
    """Folders to read: a part all of whose folders are named is read by its own name."""
    by_part: dict[str, list[Folder]] = {}
    for f in folders:
        by_part.setdefault(f.part, []).append(f)
    return [path for part, own in by_part.items()
            for path in ([f"{PART}={part}"] if len(own) == state.written.get(part) else [f.path for f in own])]


def read_folders(spark: SparkSession, bronze_path: str, state: Manifest, folders: Iterable[Folder],
                 partition_col: str = DATE_PARTITION) -> DataFrame:
    """Rows of these folders of a state, without masked ones."""
    folders, base = list(folders), parts_path(bronze_path)
    stored = [f for f in state.columns if f.name not in (PART, "load_id", partition_col)]
    schema = T.StructType([*stored, T.StructField(PART, T.StringType()), T.StructField("load_id", T.StringType()),
                           T.StructField(partition_col, T.DateType())])
    if not folders:
        return spark.createDataFrame([], schema).drop(PART)
    rows = (spark.read.schema(schema).option("basePath", base)
            .parquet(*[f"{base}/{p}" for p in _roots(state, folders)]))
    masked = sorted({f"{f.part}/{u}" for f in folders for u in f.masked})
    if masked:
        rows = rows.where(~F.concat_ws("/", PART, UNIT).isin(masked))
    return rows.drop(PART)


def read_bronze(spark: SparkSession, bronze_path: str, partition_col: str = DATE_PARTITION) -> DataFrame:
    """The bronze table (all units), with every column that any unit brought."""
    state = read_manifest(spark, bronze_path)
    if not state.version:
        raise FileNotFoundError(f"nothing was loaded into {bronze_path}")
    return read_folders(spark, bronze_path, state, state.folders, partition_col)


def dates_to_pack(state: Manifest, file_bytes: int = FILE_BYTES) -> list[str]:
    """Dates with masked rows, or with at least twice the files that their bytes need."""
    by_date: dict[str, list[Folder]] = {}
    for f in state.folders:
        by_date.setdefault(f.date, []).append(f)
    return sorted(d for d, own in by_date.items()
                  if any(f.masked for f in own)
                  or sum(f.files for f in own) >= 2 * max(1, ceil(sum(f.size for f in own) / file_bytes)))


def compact_bronze(spark: SparkSession, bronze_path: str, partition_col: str = DATE_PARTITION,
                   file_bytes: int = FILE_BYTES, dates: list[str] | None = None) -> list[str]:
    """Pack the dates that need it (or those given) into one folder each; returns them.

    All other dates keep their folders. Readers of the state before are not disturbed; its folders stay
    until :func:`drop_old_parts`.
    """
    state = read_manifest(spark, bronze_path)
    chosen = set(dates_to_pack(state, file_bytes) if dates is None else dates)
    packed = [f for f in state.folders if f.date in chosen]
    if not packed:
        return []
    units_of: dict[str, set[str]] = {}
    for f in packed:
        units_of.setdefault(f.date, set()).update(u for u in f.units if u not in f.masked)
    rows = read_folders(spark, bronze_path, state, packed, partition_col).withColumn("load_id", F.lit(MERGED))
    folders = write_part(spark, rows, bronze_path, state, partition_col, units_of)
    kept = replace(state, folders=tuple(f for f in state.folders if f.date not in chosen))
    commit(spark, bronze_path, kept.with_part(folders))
    return sorted(chosen)


def drop_old_parts(spark: SparkSession, bronze_path: str, keep: int = 2) -> list[str]:
    """Delete manifests but the newest ``keep``, and parts that none of those names (parts of a job that
    is still to be committed are newer and stay)."""
    versions = _versions(spark, bronze_path)
    kept = versions[-max(keep, 1):]
    if not kept:
        return []
    live = {f.part for v in kept for f in read_manifest(spark, bronze_path, v).folders}
    for v in versions[:-len(kept)]:
        delete_path(spark, _manifest_file(bronze_path, v))
    gone = []
    for name in list_names(spark, parts_path(bronze_path)):
        part = name.split("=", 1)[-1]
        if part not in live and int(part.split("-")[0]) <= kept[-1]:
            delete_path(spark, f"{parts_path(bronze_path)}/{name}")
            gone.append(part)
    return gone
