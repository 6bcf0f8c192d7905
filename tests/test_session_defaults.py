"""Sessions that set nothing themselves, and options that wide rows need."""

from pyspark.sql import functions as F

from stratum.sources.incremental import page_numbers, write_page_index


def test_pages_when_the_session_sets_no_shuffle_partitions(spark, tmp_path):
    plain = spark.newSession()
    plain.conf.unset("spark.sql.shuffle.partitions")
    df = plain.range(0, 95, 1, 3).select(F.col("id"), (F.col("id") % 7).alias("g"))
    want = sorted((i % 7, i) for i in range(95))
    got = page_numbers(df, ["g", "id"], size=10).orderBy("row_no").collect()
    assert [(r.g, r.id) for r in got] == want and [r.page_no for r in got] == [i // 10 for i in range(95)]
    index = write_page_index(df, ["g", "id"], str(tmp_path / "pages"), size=10)
    assert [(r.g, r.id) for r in index.page(plain, 4).collect()] == want[40:50]


def test_wide_row_options_are_lowered_and_smaller_ones_stay(spark):
    from stratum.session import WIDE_ROW_CONF, widen_rows
    split = "spark.sql.files.maxPartitionBytes"
    own = spark.newSession()
    own.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    own.conf.set(split, "128MB")
    widen_rows(own)
    assert own.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert own.conf.get(split) in ("16777216", "16777216b")
    for small in ("1m", "500000"):
        own.conf.set(split, small)
        widen_rows(own)
        assert own.conf.get(split) == small and WIDE_ROW_CONF[split] > 1024 ** 2


def test_silver_cleans_only_the_rows_it_keeps(spark, raw_rows, capsys):
    from stratum.plans import collisions as C
    C.silver(raw_rows([{"collision_id": "1", "crash_date": "2024-01-01"}])).explain("simple")
    plan = capsys.readouterr().out.splitlines()
    windows = [n for n, line in enumerate(plan) if "Window" in line]
    cleaned = [n for n, line in enumerate(plan) if "initcap(" in line]
    assert windows and cleaned and max(cleaned) < min(windows)      # the plan's top comes first


def test_silver_keeps_the_newest_valid_row_of_raw_text(spark, raw_rows):
    import datetime as dt

    from stratum.plans import collisions as C
    from stratum.sources.raw import INGESTION_TS
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [{"collision_id": "1", "crash_date": "2024-01-01", "borough": " bronx", INGESTION_TS: old},
            {"collision_id": "1", "crash_date": "2024-01-01", "borough": "queens ", INGESTION_TS: new},
            {"collision_id": "1", "crash_date": "no date", "borough": "x", INGESTION_TS: dt.datetime(2024, 1, 3)},
            {"collision_id": "2", "crash_date": "2024-01-01", "number_of_persons_injured": "-1", INGESTION_TS: None},
            {"collision_id": "2", "crash_date": "2024-01-01", "number_of_persons_injured": "-1", INGESTION_TS: None},
            {"collision_id": "None", "crash_date": "2024-01-01"}, {"crash_date": "2024-01-01"}]
    raw = raw_rows(rows).withColumn("brought_along", F.lit("x"))
    got = {r.collision_id: (r.borough, r.persons_injured, r[INGESTION_TS]) for r in C.silver(raw).collect()}
    assert got == {"1": ("QUEENS", None, new), "2": (None, None, None)}
    typed = C.latest_per_id(C.valid_rows(C.typed(raw), "collision_id", "crash_date"))
    assert {r.collision_id: (r.borough, r.persons_injured, r[INGESTION_TS]) for r in typed.collect()} == got
