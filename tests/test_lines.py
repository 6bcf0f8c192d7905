"""Lines are dealt as compressed blocks and plain ones parsed in batches: the rows stay those of ``parse_records``."""

import gzip

import pyarrow as pa
from pyspark.sql import functions as F

from stratum.session import at_most
from stratum.sources import lines as L
from stratum.sources.raw import parse_records
from stratum.streaming import file_load
from stratum.streaming.bronze import read_bronze, read_manifest
from stratum.streaming.file_load import load_new_files

COLUMNS = ["collision_id", "crash_date", "note"]
ODD = ['', '   ', 'null', '{', '{}', '[]', '[{"note":"a"},{"note":"b"}]', 'not json', '{"note":"1"} x', '{"note":"1"}{"note":"2"}',
       '{"note":"a"} null {"note":"b"}', '{"note":null}', '{"note":1}', '{"note":1.50}', '{"note":1e2}', '{"note":true}',
       '{"note":{"a": 1}}', '{"note":[1, "x"]}', '{"note":"a","note":"b"}', '{"note":"a","note":null}', '{"other":"x"}',
       '{"note":"a","other":{"b":[1,2]},"Note":"c"}', "{'note':'single'}", '{"note" : "spaces"}', ' {"note":"lead"}',
       '{"note":"trail"} ', '{"note":"q\\"\\\\\\/\\b\\f\\n\\r\\t"}', '{"note":"\\u00e9\\u0000\\u0001"}', '{"note":"\\ud83d\\ude00"}',
       '{"note":"\\ud800"}', '{"note":"\\udc00 low"}', '{"note":"bad \\q"}', '{"note":"tab\there"}', '{"note":"cut', '{"note":"x",}',
       '{"note":NaN}', '{"note":"x"/*c*/}', '{"no\\u0074e":"key"}', '﻿{"note":"mark"}', '{"note":"é😀"}', '{"note":""}',
       '{"collision_id":"7","crash_date":"2024-01-01T00:00:00.000","note":"n"}', '{"crash_date":{"a":1},"note":"x"}',
       '{"note":"a,\\"note\\":\\"b"}', '{"note":"}"}', '{"note":"{"}', '{"note":"' + "x" * (L.PLAIN_BYTES + 10) + '"}']


def _rows(df):
    rows = df.withColumn("_extra", F.map_entries("_extra")).collect()
    return sorted(repr([r[c] for c in ("_load", *COLUMNS, "_extra")]) for r in rows)


def _lines(spark, lines, parts=3):
    return spark.createDataFrame([(f"u{i % 2}", x) for i, x in enumerate(lines)], "_load string, value string").repartition(parts)


def test_odd_lines_give_the_rows_that_line_by_line_parsing_gives(spark):
    lines = _lines(spark, ODD + ODD[::-1])
    got, want = L.dealt_records(lines, "_load", COLUMNS, "crash_date"), parse_records(lines, COLUMNS)
    assert got.columns == ["_load", *COLUMNS, "_extra"] and got.dtypes == want.dtypes
    assert _rows(got) == _rows(want)


def test_lines_that_are_not_utf8(spark):
    raw = b'{"note":"ok"}\xff', b'{"note":"\xc3\x28"}', b'{"note":"\xed\xa0\x80"}', b'{"note":"ok"}'
    lines = spark.createDataFrame([("u", bytearray(x)) for x in raw], "_load string, b binary").select(
        "_load", F.col("b").cast("string").alias("value"))
    assert _rows(L.dealt_records(lines, "_load", COLUMNS, "crash_date")) == _rows(parse_records(lines, COLUMNS))


def test_names_that_patterns_and_plans_could_mistake(spark):
    columns = ["value", "a.b", "c|d", "c0", "unit"]
    lines = spark.createDataFrame([("u", '{"value":"1","a.b":"2","c|d":"3","c0":"4","unit":"5"}'), ("u", '{"axb":"9","value":"6"}')],
                                  "_load string, value string")
    got = L.dealt_records(lines, "_load", columns, "value").orderBy("value").collect()
    assert [tuple(r)[:6] for r in got] == [("u", "1", "2", "3", "4", "5"), ("u", "6", None, None, None, None)]
    assert [r._extra for r in got] == [{}, {"axb": "9"}]


def test_plain_lines_are_not_parsed_again_and_one_odd_line_keeps_the_others_plain():
    plain = ['{"collision_id":"%d","crash_date":"2024-01-0%d"}' % (i, i % 9 + 1) for i in range(1000)]
    lines = plain[:400] + ['{"note":"a","note":"b"}', '{"new":"x"}'] + plain[400:]
    batch = pa.RecordBatch.from_arrays([pa.array(["u"] * len(lines)), pa.array(lines)], names=["unit", "value"])
    blocks = list(L._blocks("crash_date", 8, 1 << 14)(iter([batch])))
    assert len(blocks) > 1 and sum(b.num_rows for b in blocks) <= len(blocks) * 9
    got = pa.Table.from_batches(L._opened(COLUMNS, 1 << 14)(iter(
        [pa.RecordBatch.from_arrays([b["unit"], b["bytes"], b["block"]], names=["u", "b", "k"]) for b in blocks])))
    assert sorted(x for x in got["value"].to_pylist() if x is not None) == sorted(lines[400:402])
    assert sorted(x for x in got["c0"].to_pylist() if x is not None) == sorted(str(i) for i in range(1000))


def test_a_shuffle_of_blocks_is_a_third_of_one_of_lines(spark):
    rows = spark.range(0, 4000, 1, 2).select(*[F.concat(F.lit(f"{c} "), F.sha1((F.col("id") % 50 + k).cast("string"))).alias(c)
                                               for k, c in enumerate(COLUMNS)])
    text = [r[0] for r in rows.select(F.to_json(F.struct("*"))).collect()]
    batch = pa.RecordBatch.from_arrays([pa.array(["u"] * len(text)), pa.array(text)], names=["unit", "value"])
    size = sum(len(x) for b in L._blocks("crash_date", 8, 1 << 24)(iter([batch])) for x in b["block"].to_pylist())
    assert size * 3 < sum(map(len, text))


def test_new_keys_become_columns_and_a_load_without_any_reads_its_lines_once(spark, tmp_path, monkeypatch):
    landing, bronze, ckpt = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    landing.mkdir()
    asked = []
    monkeypatch.setattr(file_load, "extra_keys", lambda df, real=file_load.extra_keys: asked.append(real(df)) or asked[-1])
    for k, extra in enumerate(['', ',"lane":3', ',"lane":4', ',"lane":5,"tide":6']):
        (landing / f"{k}.json").write_text(f'{{"collision_id":"{k}","crash_date":"2024-01-01"{extra}}}\n')
        load_new_files(spark, str(landing), bronze, ckpt)
    assert asked == [["lane"], ["lane"], ["lane", "tide"]]      # the file without other keys was not asked
    rows = {r.collision_id: (r.lane, r.tide) for r in read_bronze(spark, bronze).collect()}
    assert rows == {"0": (None, None), "1": ("3", None), "2": ("4", None), "3": ("5", "6")}
    parts = {f.part for f in read_manifest(spark, bronze).folders}
    assert len(parts) == 4 and {p.name for p in (tmp_path / "bronze" / "parts").iterdir()} == {f"part={p}" for p in parts}


def test_files_without_lines_bring_nothing_and_names_are_read_from_names_alone(spark, tmp_path):
    landing, bronze, ckpt = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    (landing / "batch=1").mkdir(parents=True)
    line = '{"collision_id":"1","crash_date":"2024-01-01"}\n'
    with gzip.open(landing / "batch=1" / "a b%20c.json.gz", "wt") as f:
        f.write(line)
    load_new_files(spark, str(landing), bronze, ckpt)
    with gzip.open(landing / "batch=1" / "empty.json.gz", "wt"):
        pass
    (landing / "alone.json").write_text("")
    load_new_files(spark, str(landing), bronze, ckpt)
    assert read_manifest(spark, bronze).version == 1            # nothing to replace
    (landing / "alone2.json").write_text(line.replace('"1"', '"2"') * 100)
    load_new_files(spark, str(landing), bronze, ckpt)
    assert read_bronze(spark, bronze).count() == 101 and read_manifest(spark, bronze).version == 2


def test_an_option_is_lowered_for_a_while(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own = spark.newSession()
    own.conf.set(key, "64m")
    with at_most(own, key, 1000):
        assert own.conf.get(key).rstrip("b") == "1000"
    assert own.conf.get(key) in ("64m", str(64 * 1024 ** 2), f"{64 * 1024 ** 2}b")
    with at_most(own, key, 1 << 30):
        assert own.conf.get(key) in ("64m", str(64 * 1024 ** 2), f"{64 * 1024 ** 2}b")
