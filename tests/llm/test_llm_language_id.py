import collections

import brute
from pyspark.sql import functions as F

from stratum.llm import language_id
from stratum.llm.common import fold_is


def test_matches_brute_force(docs, doc_rows):
    size = 200
    train = docs.where(~fold_is(F.col("doc_id"), 5, 0))
    got = {r.doc_id: r.language for r in language_id.identify(docs, train, profile_size=size).collect()}
    counts = collections.defaultdict(collections.Counter)
    for i, text, lang, _ in doc_rows:
        if brute.fold(i, 5) and lang is not None and text is not None:
            counts[lang].update(brute.grams(text))
    profiles = {lang: brute.profile(c, size) for lang, c in counts.items()}
    for i, text, _, _ in doc_rows:
        lang, score = brute.predict_language(profiles, text, size)
        assert got[i].lang_pred == lang
        assert abs(got[i].score - score) < 1e-9


def test_held_out_accuracy(docs):
    train = docs.where(~fold_is(F.col("doc_id"), 5, 0))
    found = language_id.identify(docs, train).where(fold_is(F.col("doc_id"), 5, 0))
    right = found.agg(F.avg((F.col("language.lang_pred") == F.col("lang")).cast("int")).alias("x")).first().x
    assert right >= 0.95


def test_edge_rows(make_docs):
    rows = [(1, "the cat and the dog", "en", "a"), (2, "der hund und die katze", "de", "a"), (3, None, "en", None),
            (4, "", None, "a"), (5, "123 !? \n", "en", "a"), (6, "the dog " * 40_000, None, "a"), (None, "und die", "de", None),
            (7, "the cat and the dog", "en", "a"), (7, "the cat and the dog", "en", "a"), (8, "Ж 中文", None, None)]
    df = make_docs(rows).withColumn("gram", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("language", F.lit("x"))
    found = language_id.identify(df, df).select("doc_id", "gram", "language.*").collect()
    got = collections.defaultdict(set)
    for r in found:
        got[r.doc_id].add((r.lang_pred, round(r.score, 6)))
    assert len(found) == len(rows)
    assert {i: next(iter(v))[0] for i, v in got.items()} == {
        1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "en", None: "de", 7: "en", 8: next(iter(got[8]))[0]}
    assert all(len(v) == 1 for v in got.values())
    assert all(0 <= s <= 1 for v in got.values() for _, s in v)


def test_empty_training_and_empty_table(make_docs):
    df = make_docs([(1, "the cat", None, None)])
    assert [r.language.lang_pred for r in language_id.identify(df, df).collect()] == ["und"]
    assert language_id.identify(make_docs([]), make_docs([])).collect() == []
