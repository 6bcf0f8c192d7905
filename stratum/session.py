"""Session helpers: a tuned local session for tests/bench and shared scratch locations.

On a cluster the session is created by the platform; nothing here overrides its settings.
Scratch data (streaming checkpoints, landing files, lineage cuts) always lives under the
shared folder the cluster names in ``spark.checkpoint.dir``. Only a local-mode session with
no such setting (tests, bench) gets a private temporary folder.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _default_driver_memory() -> str:
    """Half the machine's memory, at most 8 GB (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(8, total // 2 // 1024 ** 3))}g"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stratum") -> SparkSession:
    """Local session tuned for small-scale checks (tests, bench)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # generated methods above HotSpot's 8000-byte JIT limit run interpreted: split them
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # local disk: list thousands of small partition folders with a few tasks, not one each
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * parts))
        # tiny test data: keep a few parallel tasks after adaptive coalescing
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        # delete checkpoint files once their DataFrame is garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("STRATUM_DRIVER_MEMORY", _default_driver_memory()))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local catalog tables live in a private folder, not under the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stratum-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only in local mode.

    A cluster must name a shared folder in ``spark.checkpoint.dir``; a machine-local
    temporary folder would vanish with the executor that wrote it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/…) for the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stratum-ckpt-"))
    return sc.getCheckpointDir()


# Options of a job whose stored rows grow wide when they are read, each with the most it may be.
WIDE_ROW_CONF = {
    # generated methods above HotSpot's 8000-byte JIT limit run interpreted: split them
    "spark.sql.codegen.hugeMethodLimit": 8000,
    # one stored byte becomes some 30 in memory, and a task sorts all that it reads
    "spark.sql.files.maxPartitionBytes": 16 * 1024 ** 2,
    # in proportion, so that a task reads as many small files (a date each, say) as before
    "spark.sql.files.openCostInBytes": 512 * 1024,
}
_UNITS = {"b": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5}


def _bytes(text: str) -> int:
    """``16m``, ``128MB`` or a plain number of bytes."""
    number = text.strip().lower().rstrip("b")
    return int(number.rstrip("kmgtp")) * 1024 ** _UNITS[number[-1] if number[-1] in _UNITS else "b"]


def widen_rows(spark: SparkSession) -> None:
    """Lower the session's options to :data:`WIDE_ROW_CONF`; a smaller value that it has stays."""
    for key, most in WIDE_ROW_CONF.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))


@contextmanager
def at_most(spark: SparkSession, key: str, most: int) -> Iterator[None]:
    """The session's option ``key``, a number of bytes, lowered to ``most`` for a while; a smaller one stays."""
    before = spark.conf.get(key)
    if _bytes(before) > most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for one run of ``name``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for scratch data")
    path = f"{base}/stratum-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_clear_scratch)
    _scratch.append((spark, path))
    return path


_scratch: list[tuple[SparkSession, str]] = []


def _clear_scratch() -> None:
    """Delete this application's scratch folders when the driver ends, if its session still runs."""
    for spark, path in _scratch:
        if getattr(spark.sparkContext, "_jsc", None) is not None:
            delete_path(spark, path)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme."""
    fs, at = _file_system(spark, path)
    return fs.makeQualified(at).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, as stored; none if there is no such folder."""
    fs, at = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def read_file(spark: SparkSession, path: str) -> str:
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole, in one rename; fails if there is a file of that name already."""
    fs, at = _file_system(spark, path)
    at, hadoop = fs.makeQualified(at), spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(at.getParent(), f".draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        hadoop.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, at, options)
    except Exception:
        fs.delete(draft, False)
        raise


def delete_path(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder within its file system; nothing may be at the target yet."""
    fs, at = _file_system(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(to) or not fs.rename(at, to):
        raise OSError(f"could not move {path} to {target}")


def cluster_conf(input_bytes: int, partition_bytes: int = 512 * 1024 ** 2,
                 scan_split_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of input.

    The initial shuffle partition count is sized so the widest shuffle (the silver dedupe
    moves roughly the whole input) gets about ``partition_bytes`` per partition before
    compression; adaptive execution then coalesces small partitions, splits skewed ones and
    picks broadcast joins from measured sizes. E.g. 100 TB -> 204,800 partitions of 512 MB.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.session.timeZone": "UTC",
        # the dedupe shuffle moves about the whole input: trade CPU for network and disk
        "spark.io.compression.codec": "zstd",
        "spark.sql.parquet.compression.codec": "zstd",
        # lineage cuts (checkpoint) are deleted once unreferenced instead of piling up
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
