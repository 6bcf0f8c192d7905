"""One Spark application running the stages in order; a stage starts only if the
previous one succeeded (any exception stops the run, leaving earlier outputs in place).

land (L4, L5) -> bronze file load (T1) -> silver (T2) -> staging view (T3) -> gold (T4-T9)
-> data tests on the written gold tables with failing rows stored (Q1-Q7).

Each stage reads what the previous one wrote, so lineage is cut at every table and a lost
executor only recomputes the current stage.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratum.operators.checks import run_checks
from stratum.plans import collisions as C
from stratum.session import delete_path, list_names, path_exists
from stratum.sinks.publishing import NO_VALUE, Published, forget_build, publish_build, stored_table
from stratum.sinks.tables import publish_view, write_table
from stratum.sources.landing import land_jsonl
from stratum.sources.raw import RAW_COLUMNS
from stratum.streaming.bronze import DATE_PARTITION, compact_bronze, parts_path, read_bronze, read_manifest
from stratum.streaming.file_load import load_new_files

GOLD_TABLES = ["dim_date", "dim_location", "dim_vehicle", "fact_collisions",
               "monthly_collision_metrics", "borough_collision_metrics"]
PUBLISHED = ["collisions_raw", "collisions_clean", *GOLD_TABLES]


@dataclass(frozen=True)
class RunPaths:
    """Folders of a lake and of one build in it. Every build writes a folder of its own."""
    base: str
    run_id: str | None = None

    def _of(self, *names: str) -> str:
        return "/".join([self.base.rstrip("/"), *names])

    @property
    def landing(self) -> str:
        return self._of("landing")

    @property
    def bronze(self) -> str:
        return self._of("bronze")

    @property
    def bronze_checkpoint(self) -> str:
        return self._of("bronze_checkpoint")

    @property
    def builds(self) -> str:
        return self._of("builds")

    def table(self, name: str) -> str:
        """Folder of a table, or of the failing rows (``audit``), of this build."""
        return self._of("builds", self._named(), name)

    @property
    def folder(self) -> str:
        """Folder of this build."""
        return self._of("builds", self._named())

    def _named(self) -> str:
        if self.run_id is None:
            raise ValueError("these paths name no build")
        return self.run_id

    @property
    def silver(self) -> str:
        return self.table("silver")

    @property
    def audit(self) -> str:
        return self.table("audit")

    @property
    def fact_collisions(self) -> str:
        return self.table("fact_collisions")

    @property
    def borough_collision_metrics(self) -> str:
        return self.table("borough_collision_metrics")

    @property
    def passed(self) -> str:
        """Marker written when every check of this build passed."""
        return self.table("_passed")


def current_build(spark: SparkSession, base: str) -> RunPaths | None:
    """The newest build whose checks all passed."""
    p = RunPaths(base)
    done = [n for n in list_names(spark, p.builds) if path_exists(spark, RunPaths(base, n).passed)]
    return RunPaths(base, max(done)) if done else None


def drop_old_builds(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete all builds but the newest ``keep`` that passed and any newer than those."""
    names = sorted(list_names(spark, RunPaths(base).builds))
    passed = [n for n in names if path_exists(spark, RunPaths(base, n).passed)]
    if len(passed) < keep:
        return []
    old = [n for n in names if n < passed[-keep]]
    for n in old:
        if path_exists(spark, f"{RunPaths(base).builds}/{n}/_pointer"):
            forget_build(spark, f"{RunPaths(base).builds}/{n}", PUBLISHED)
        delete_path(spark, f"{RunPaths(base).builds}/{n}")
    return old


def raw_table(spark: SparkSession, bronze_path: str) -> Published:
    """Bronze as it is now, folder by folder. Masked rows are packed away first: a folder shows all its rows."""
    masked = sorted({f.date for f in read_manifest(spark, bronze_path).folders if f.masked})
    if masked:
        compact_bronze(spark, bronze_path, dates=masked)
    state = read_manifest(spark, bronze_path)
    columns = T.StructType([*[f for f in state.columns if f.name not in ("load_id", DATE_PARTITION)],
                            T.StructField("load_id", T.StringType()), T.StructField(DATE_PARTITION, T.DateType()),
                            T.StructField("part", T.StringType())])
    folders = []
    for f in state.folders:
        unit = unquote(f.path.split("/")[1].split("=", 1)[1])
        date = None if f.date == NO_VALUE else f.date
        folders.append(((f.part, unit, date), f"{parts_path(bronze_path)}/{f.path}"))
    return Published(columns, folders, ("part", "load_id", DATE_PARTITION))


def build(spark: SparkSession, p: RunPaths, raise_on_failure: bool = True,
          publish_prefix: str | None = None) -> RunPaths:
    """Bronze (already loaded under ``p.bronze``) -> silver -> staging -> gold -> checks
    [-> publish], all in ``base/builds/<run_id>/``; returns that build's paths.

    No folder of an earlier build is touched. When every check passed the build is marked as
    the current one and, with ``publish_prefix``, all published names move to it by one pointer
    (:mod:`stratum.sinks.publishing`); a build that fails, or is killed half-way, changes nothing that
    readers see.
    """
    if p.run_id is None:
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
        p = RunPaths(p.base, f"{stamp}_{uuid.uuid4().hex[:6]}")
    # silver: full rebuild from bronze, partitioned by crash date
    silver = C.silver(read_bronze(spark, p.bronze), dealt=True)
    write_table(silver, path=p.silver, partition_by="crash_date_partition", dealt=True)
    # staging view over the stored silver table
    stg = publish_view(C.staging(spark.read.schema(silver.schema).parquet(p.silver)), "stg_collisions")
    # gold tables, each a full refresh
    gold = C.Gold(spark, stg)
    built = {"dim_date": gold.dim_date, "dim_location": gold.dim_location,
             "dim_vehicle": gold.dim_vehicle}
    for name, df in built.items():
        write_table(df, path=p.table(name))
    dims = {n: spark.read.parquet(p.table(n)) for n in built}
    write_table(C.fact(stg, dims["dim_date"], gold.dim_date_rows), path=p.fact_collisions)
    fact_t = spark.read.parquet(p.fact_collisions)
    write_table(C.monthly_metrics(fact_t, dims["dim_date"]), path=p.table("monthly_collision_metrics"))
    write_table(C.borough_metrics(fact_t, dims["dim_location"]), path=p.borough_collision_metrics)
    # data tests on what was built; failing rows kept under audit/
    tables = {"stg_collisions": stg, **{n: spark.read.parquet(p.table(n)) for n in GOLD_TABLES}}
    counts = run_checks(C.build_suite(tables, C.REFERENCE_TESTS), audit_path=p.audit,
                        raise_on_failure=raise_on_failure)
    if counts.where("failures > 0").take(1):
        return p
    counts.coalesce(1).write.mode("overwrite").parquet(p.passed)
    # publish: all names move to this build together
    if publish_prefix is not None:
        silver_t = spark.read.schema(silver.schema).parquet(p.silver)
        tables = {"collisions_raw": raw_table(spark, p.bronze),
                  "collisions_clean": stored_table(spark, silver_t, p.silver, DATE_PARTITION)}
        tables |= {n: stored_table(spark, spark.read.parquet(p.table(n)), p.table(n)) for n in GOLD_TABLES}
        publish_build(spark, publish_prefix, p.run_id, tables, p.folder)
    return p


def staged_run(spark: SparkSession, feed: DataFrame, base: str, batch_id: str,
               raise_on_failure: bool = True, publish_prefix: str | None = None) -> RunPaths:
    """Run every stage; with ``publish_prefix`` the tables are published as catalog tables
    ``<prefix><name>`` only after all checks passed (write-audit-publish). Without it readers
    find the newest build that passed by :func:`current_build`."""
    p = RunPaths(base)
    # 1. land the extracted records as one JSON-lines batch
    land_jsonl(feed.select(*RAW_COLUMNS), p.landing, batch_id)
    # 2. bronze: load units with files not seen before (a batch landed again replaces itself)
    load_new_files(spark, p.landing, p.bronze, p.bronze_checkpoint)
    # 3-7. silver, staging, gold, checks, publish
    return build(spark, p, raise_on_failure, publish_prefix)
