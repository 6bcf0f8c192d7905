import collections
import re

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import mixing
from stratum.llm.common import stored


def check(rows, found, cap=3):
    sizes, taken = collections.Counter(), collections.Counter()
    for doc_id, text, _, source in rows:
        sizes[source] += len(brute.words(text))
    want = brute.targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= cap
        taken[r.source] += r.taken
    longest = max((len(brute.words(t)) for _, t, _, _ in rows), default=0)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest / 2 + 1e-6


def test_targets_and_words_taken(docs, doc_rows):
    found = mixing.mix(docs).collect()
    assert len(found) == len(doc_rows)
    check(doc_rows, found)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))


def test_complete_epochs_come_first(docs):
    for r in mixing.mix(docs).where("size > 0").collect():
        assert r.copies in (int(r.target // r.source_size), int(r.target // r.source_size) + 1)


def test_edge_rows(make_docs):
    rows = [(1, "a b c", "en", "x"), (2, None, "en", "x"), (3, "", "en", None), (4, "w " * 30_000, "en", None),
            (5, "a", None, "y"), (5, "a", None, "y"), (None, "q r", None, "Z"), (7, "k", None, "empty"), (8, " \n", None, "none")]
    df = make_docs(rows).withColumn("taken", F.lit("clash")).withColumn("__x", F.lit(1))
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    check(rows, found)
    assert mixing.mix(make_docs([])).collect() == []


def test_weights_prefer_clean_documents(make_docs):
    rows = [(i, ("word " * 10) if i % 2 else ("| # " * 5), "en", "a") for i in range(400)]
    rows += [(1000 + i, "word " * 10, "en", "b") for i in range(40)]
    found = [r for r in mixing.mix(make_docs(rows), weights=(1.0, 4.0), max_epochs=3).collect() if r.source == "a"]
    clean, junk = (sum(r.copies for r in found if r.doc_id % 2 == k) for k in (1, 0))
    assert clean > junk


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=7))
def test_water_filling(spark, sizes):
    table = {f"s{k}": n for k, n in enumerate(sizes)}
    df = spark.createDataFrame(list(table.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    for s, t in brute.targets(table).items():
        assert got[s] == pytest.approx(t, abs=1e-6)


def test_no_task_holds_all_sources(spark, monkeypatch):
    """What comes together in one task is a count a partition; the values to fill are in several."""
    kept = []
    monkeypatch.setattr(mixing, "stored", lambda df, name: kept.append(stored(df, name)) or kept[-1])
    table = {f"s{k}": (k * 7919) % 101 for k in range(400)} | {None: 11}
    df = spark.createDataFrame(list(table.items()), "source string, source_size long")
    made = mixing.source_targets(df.repartition(5))
    got, want = {r.source: r.target for r in made.collect()}, brute.targets(table)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert all("keys=[__part#" in line for line in re.findall(r"Exchange SinglePartition.*\n(.*)", plan))
    assert kept[0].select("part").distinct().count() > 1


def test_empty_documents_of_a_full_source_take_no_more_than_all_epochs(make_docs):
    rows = [(i, "" if i % 3 == 0 else None if i % 3 == 1 else "a b c", "en", "small") for i in range(90)]
    rows += [(1000 + i, "w " * 500, "en", "large") for i in range(60)]
    found = mixing.mix(make_docs(rows)).collect()
    check(rows, found)
    assert {r.copies for r in found if r.source == "small" and r.size} == {3}


@pytest.mark.parametrize("text", ["word " * 9, "| # $ % & " * 4])
def test_no_range_of_keys_holds_much_of_a_source(spark, text):
    """Whatever the quality weight of a source's documents, the range in which its budget ends is narrow."""
    df = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit("s").alias("source"))
    key = -F.log(mixing.uniform("doc_id", "text", "source")) / mixing.text_measures("text")["weight"]
    sizes = df.groupBy(F.floor(F.log(key) * mixing.BUCKETS)).count().toPandas()["count"]
    assert sizes.max() < 0.01 * 40_000


def test_a_third_of_identical_rows_is_cut_within(make_docs):
    """Rows alike in every column have one key; their place in the scan decides which of them are taken."""
    rows = [(7, "one and the same text " * 4, "en", "hot")] * 600 + [(100 + i, "w " * 7, "en", "hot") for i in range(9)]
    rows += [(5000 + i, "v " * 90, "en", "rest") for i in range(90)]
    found = mixing.mix(make_docs(rows)).collect()
    check(rows, found)
    assert len({r.copies for r in found if r.doc_id == 7}) == 2


def test_cut_is_found_over_several_partitions(spark, make_docs, monkeypatch):
    kept = {}
    monkeypatch.setattr(mixing, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    monkeypatch.setattr(mixing, "BUCKETS", 1)       # wide ranges: many rows lie in the last one
    rows = [(i, "a b c d " * (1 + i % 4), "en", ("p", "q")[i % 5 == 0]) for i in range(900)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        check(rows, mixing.mix(make_docs(rows)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert kept["edges"].select("__mix_part").distinct().count() > 3
