"""Rows packed for a shuffle come back as they were, and the staged build packs what it shuffles whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.functions.packed import pack, unpack
from stratum.plans import collisions as C
from stratum.sources.raw import INGESTION_TS, RAW_COLUMNS

SCHEMA = "id string, a string, n int, b string, x double, big bigint"


def test_values_come_back_as_they_were(spark):
    rows = [("1", "a", 1, "b", 1.5, 1), ("2", None, None, None, None, None), ("3", "", 0, "", -0.0, 0), ("4", "\x01", -1, "\x02", 1e300, -2**63),
            ("5", "x\x01\x02y", 2**31 - 1, None, float("inf"), 2**63 - 1), ("6", "\x02", -2**31, "é😀", 0.1 + 0.2, 7),
            ("7", "x", 3, "t", 5e-324, 8), (None, "line\nbreak,|~", 4, "\u0000", float("nan"), 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    back = unpack(pack(df, ["id"]).repartition(3), df.schema)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_text_that_is_not_utf8_comes_back(spark):
    raw = b"ok", b"\xff\x01", b"\xc3\x28", b"\xed\xa0\x80"
    df = spark.createDataFrame([(bytearray(b), "z") for b in raw], "b binary, z string").select(F.col("b").cast("string").alias("s"), "z")
    back = unpack(pack(df, []), df.schema).select(F.hex(F.col("s").cast("binary")), "z").collect()
    assert [r[0] for r in back] == [b.hex().upper() for b in raw] and {r.z for r in back} == {"z"}


def test_types_without_an_exact_text_are_refused(spark):
    with pytest.raises(TypeError, match="t"):
        pack(spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz"), [])


def _raw(raw_rows):
    t = [dt.datetime(2024, 1, k) for k in (1, 2)]
    return raw_rows([{"collision_id": str(i % 7), "crash_date": f"2024-01-0{i % 5 + 1}T00:00:00.000", "crash_time": "3:05",
                      "borough": [None, " bronx", "a\x01b", "\x02"][i % 4], "latitude": ["0", "40.5", "", None][i % 4],
                      "number_of_persons_injured": ["1", "x", None, "-1"][i % 4], INGESTION_TS: t[i % 2]} for i in range(40)]
                    + [{"collision_id": "9", "crash_date": "none"}, {"crash_date": "2024-01-01"}, {"collision_id": "8", "crash_date": "2024-01-01",
                                                                                                   INGESTION_TS: None}])


def test_dealt_silver_has_the_same_rows(spark, raw_rows):
    raw = _raw(raw_rows)
    plain, dealt = C.silver(raw, wall_clock=False), C.silver(raw, wall_clock=False, dealt=True)
    assert plain.schema.simpleString() == dealt.schema.simpleString()
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, dealt.collect())) and plain.count() == 8


def test_dealt_silver_shuffles_packed_rows(spark, raw_rows, capsys):
    C.silver(_raw(raw_rows), dealt=True).explain("formatted")
    plan = capsys.readouterr().out
    shuffled = [block.split("]: [", 1)[1].split("]", 1)[0] for block in plan.split("\n\n") if ") Exchange" in block]
    assert len(shuffled) == 2
    for columns in shuffled:
        assert "__packed" in columns and not any(c in columns for c in RAW_COLUMNS if c not in ("collision_id", "crash_date"))
