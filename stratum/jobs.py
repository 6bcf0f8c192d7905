"""Batch job entry points (``spark-submit -m``-style): one stage per subcommand.

    python -m stratum.jobs ingest --source PATH --ts-col crash_date --landing DIR --state DIR
    python -m stratum.jobs load   --landing DIR --base DIR
    python -m stratum.jobs compact --base DIR [--keep-states 2]
    python -m stratum.jobs build  --base DIR [--publish-prefix gold_] [--keep-builds 2]

The session comes from the cluster (``getOrCreate``); paths must be on shared storage.
Exit code 1 when a stage fails (e.g. data tests), so a scheduler stops the next stage.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from stratum.operators.checks import ChecksFailed
from stratum.plans.staged_run import RunPaths, build, drop_old_builds
from stratum.session import cluster_conf, ensure_checkpoint_dir
from stratum.sources.incremental import ingest
from stratum.streaming.bronze import compact_bronze, drop_old_parts
from stratum.streaming.file_load import load_new_files


def parse(argv):
    ap = argparse.ArgumentParser(prog="stratum.jobs")
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="size of the input: sizes shuffle partitions and scan splits")
    sub = ap.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest", help="land the next incremental window as a JSON-lines batch")
    i.add_argument("--source", required=True, help="parquet path of the source records")
    i.add_argument("--ts-col", required=True)
    i.add_argument("--landing", required=True)
    i.add_argument("--state", required=True, help="folder of the saved high-water mark")
    i.add_argument("--today", default=None, help="run date (default: today, UTC)")
    i.add_argument("--full-reload", action="store_true")
    i.add_argument("--lookback-days", type=int, default=0)
    i.add_argument("--batch-id", default=None)
    ld = sub.add_parser("load", help="load landed files not loaded before into bronze")
    ld.add_argument("--landing", required=True)
    ld.add_argument("--base", required=True)
    b = sub.add_parser("build", help="silver, gold and data tests from bronze")
    b.add_argument("--base", required=True)
    b.add_argument("--publish-prefix", default=None)
    b.add_argument("--keep-builds", type=int, default=None, help="delete older builds after a passed one")
    c = sub.add_parser("compact", help="pack bronze dates that have many small files")
    c.add_argument("--base", required=True)
    c.add_argument("--keep-states", type=int, default=None, help="delete parts of older states of bronze")
    return ap.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName(f"stratum-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.input_bytes:
        # runtime-settable SQL options only; core options (I/O codec) belong to spark-submit
        for key, value in cluster_conf(args.input_bytes).items():
            if key.startswith("spark.sql."):
                spark.conf.set(key, value)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    try:
        if args.cmd == "ingest":
            out = ingest(spark.read.parquet(args.source), args.ts_col, args.landing, args.state,
                         today=args.today or now.date(),
                         batch_id=args.batch_id or now.strftime("%Y%m%d_%H%M%S"),
                         full_reload=args.full_reload, lookback_days=args.lookback_days)
            print(out)
        elif args.cmd == "load":
            p = RunPaths(args.base)
            load_new_files(spark, args.landing, p.bronze, p.bronze_checkpoint)
        elif args.cmd == "compact":
            compact_bronze(spark, RunPaths(args.base).bronze)
            if args.keep_states:
                drop_old_parts(spark, RunPaths(args.base).bronze, args.keep_states)
        else:
            build(spark, RunPaths(args.base), publish_prefix=args.publish_prefix)
            if args.keep_builds:
                drop_old_builds(spark, args.base, args.keep_builds)
    except ChecksFailed as err:
        print(err, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
