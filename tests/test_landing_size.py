"""Landed text is compressed, its files are bounded, and lines are dealt before they are parsed."""

import os

from pyspark.sql import functions as F

from stratum.sources import landing as L
from stratum.sources.raw import RAW_COLUMNS, read_raw
from stratum.streaming.bronze import Manifest, read_bronze
from stratum.streaming.file_load import _unit_rows, load_new_files


def _feed(spark, n):
    return spark.range(0, n, 1, 2).select(F.col("id").cast("string").alias("collision_id"), *[
        F.lit("2024-01-01T00:00:00.000" if c == "crash_date" else "the same text").alias(c) for c in RAW_COLUMNS[1:]])


def test_landed_text_is_small_and_its_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "ROWS_A_FILE", 400)
    path = L.land_jsonl(_feed(spark, 2000), str(tmp_path), "1")
    files = [n for n in os.listdir(path) if n.startswith("part-")]
    assert len(files) == 6                                   # 2 tasks of 1,000 rows, 400 a file at most
    assert sum(os.path.getsize(f"{path}/{n}") for n in files) < 2000 * 100       # as plain text some 1,000 bytes a row
    back = read_raw(spark, str(tmp_path)).select(*RAW_COLUMNS)
    assert back.exceptAll(_feed(spark, 2000).select(*RAW_COLUMNS)).count() == 0
    assert back.count() == 2000


def test_lines_are_dealt_before_they_are_parsed(spark, tmp_path, capsys):
    L.land_jsonl(_feed(spark, 20), str(tmp_path), "1")
    rows = _unit_rows(spark, str(tmp_path), ["batch=1"], Manifest(), RAW_COLUMNS, "crash_date", "crash_date_partition", True)
    rows.explain("simple")
    plan = capsys.readouterr().out.splitlines()
    dealt = [n for n, line in enumerate(plan) if "REBALANCE" in line]
    parsed = [n for n, line in enumerate(plan) if "from_json" in line]
    assert dealt and parsed and max(parsed) < min(dealt)      # the plan's top comes first


def test_lines_whose_date_is_odd_or_missing_are_loaded(spark, tmp_path):
    path = tmp_path / "landing" / "batch=1"
    path.mkdir(parents=True)
    (path / "x.json").write_text('{"collision_id":"1","crash_date":"2024-01-02T00:00:00.000"}\n{"collision_id":"2"}\n'
                                 'not json\n{"collision_id":"3","crash_date":{"a":1}}\n{"collision_id":"4","crash_date":"2024-01-02","more":"m"}\n')
    args = str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    load_new_files(spark, *args)
    got = sorted((r.collision_id or "", str(r.crash_date_partition), r.more or "") for r in read_bronze(spark, args[1]).collect())
    assert got == [("", "None", ""), ("1", "2024-01-02", ""), ("2", "None", ""), ("3", "None", ""), ("4", "2024-01-02", "m")]
