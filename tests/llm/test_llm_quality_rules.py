import re

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from stratum.llm import oracle_sql
from stratum.llm import quality_rules as q


def test_measures_match_brute_force(docs, doc_rows):
    found = {r.id: r for r in q.measures(docs).collect()}
    for i, text, _, _ in doc_rows:
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.measures(text)


def test_edge_rows(spark, make_docs):
    texts = [None, "", " \t\n", "a", "a b", "a a a", "a a a a", "a b c a b c", "a b c d a b c", "x\nx\n\ny\n x\n",
             "é\u00a0ü # * $ % & | < >", "w " * 20_000, " ".join(map(str, range(9_000))) * 2, "\x0b\x0c\r\n\n"]
    df = make_docs([(i, t, None, None) for i, t in enumerate(texts)]).withColumn("words", F.lit(0)).withColumn("id", F.lit(9))
    for r in q.measures(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.measures(texts[r.id]), r.id
    labels = spark.createDataFrame([], "id long, good boolean")
    judged = {r.id: r for r in q.judge(df, labels).collect()}
    assert len(judged) == len(texts)
    assert all(r.kept != r.base_failed for r in judged.values())
    assert judged[11].base_failed and not judged[12].base_failed is None
    assert q.judge(make_docs([]), labels).collect() == []


@pytest.mark.parametrize("n,risk,level", [(0, 0.01, 0.01), (10, 0.3, 0.05), (500, 0.05, 0.001), (4000, 0.01, 1e-4), (300, 0.01, 0.04)])
def test_exact_binomial_bound(spark, n, risk, level):
    got = spark.range(1).select(q.critical_count(F.lit(n), risk, F.lit(level)).alias("k")).first().k
    assert got == brute.critical(n, risk, level)


def test_cutoffs_limit_false_rejection(spark):
    # 3000 good rows in stratum a: 5 % have a symbol ratio of 0.25; in b none has symbols
    rows = [(i, "a" if i < 3000 else "b", 100, 400, 100 if i < 150 else 0, 0, 0, 10, 0) for i in range(6000)]
    names = "id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, " \
            "n_repeat_words long, n_lines int, n_capitals int"
    measured = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([(i, True) for i in range(6000)] + [(6001, False), (None, True)], "id long, good boolean")
    cuts = {r.stratum: r for r in q.certified_cutoffs(measured, labels).collect()}
    assert cuts["a"].cut_symbols == 0.3          # 0.02 to 0.2 would reject 5 %
    assert cuts["b"].cut_symbols == 0.02
    level = q.DELTA / (len(q.RULES) * len(q.CUTOFFS) * 2)
    assert cuts["a"].risk == 0.01 and cuts["a"].allowed == brute.critical(3000, 0.01, level)
    judged = q.apply_cutoffs(measured.withColumn("n_symbols", F.lit(90)), q.certified_cutoffs(measured, labels))
    assert {(r.stratum, r.kept) for r in judged.collect()} == {("a", True), ("b", False)}


def test_too_few_labels_certify_nothing(spark, docs):
    labels = docs.select(F.col("doc_id").alias("id"), F.lit(True).alias("good")).limit(50)
    assert all(r.kept != r.base_failed for r in q.judge(docs, labels).collect())


def test_main_path_has_no_python(docs):
    plan = q.measures(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("n,risk,allowed", [(100, 0.05, False), (158, 0.05, True), (300, 0.05, True), (400, 0.02, True),
                                            (900, 0.01, True), (5000, 0.01, True)])
def test_risk_is_what_the_number_of_labels_certifies(spark, n, risk, allowed):
    level = q.DELTA / 160
    row = spark.range(1).select(q.stratum_risk(F.lit(n), q.RISKS, F.lit(level)).alias("r")).first()
    assert row.r == risk and (brute.critical(n, row.r, level) >= 0) == allowed
    smaller = [r for r in q.RISKS if r < risk]
    assert all(brute.critical(n, r, level) < 0 for r in smaller)


@pytest.mark.parametrize("sf,risks", [("sf0.01", q.RISKS), ("sf0.01", (0.01, 0.3))])
def test_cutoffs_that_bind_match_the_sql(spark, sf, risks):
    """Tables on which certified cutoffs reject documents that the base rules pass."""
    folder = f"/root/testdata/{sf}"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = q.judge(docs, labels.select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good")), risks=risks)
    got = sorted((r.id, r.kept) for r in found.select("id", "kept").collect())
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = sorted(db.execute(f"select doc_id, kept from ({oracle_sql.op9(risks=risks)})").fetchall())
    assert got == want
    assert found.where("not base_failed and not kept").count() > 0


def test_repeated_rows_and_a_stratum_without_name(spark):
    """Repeated labelled rows count each; rows without a stratum have cutoffs of their own."""
    text = "word " * 2 + " ".join(f"w{k}" for k in range(70))
    rows = [(i // 2, text, None) for i in range(1600)] + [(5000, text + " # # # # # # # # # # # # # # # # # #" * 6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, True) for i in range(800)] * 2, "id long, good boolean")
    judged = q.judge(df, labels).select("id", "kept", "rejected_by").collect()
    assert len(judged) == 1601 and all(r.kept for r in judged if r.id < 5000)
    assert [(r.kept, r.rejected_by) for r in judged if r.id == 5000] == [(False, "symbols")]
