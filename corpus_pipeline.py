"""Training-data pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir), where docs is what its predecessor kept, and returns the
columns of documents; the last one returns the token ids. A stage learns only from its own input.

A filter that finds nothing to learn from keeps every row: the language stage if no training text has
a language (``lang`` all NULL), the quality stage unless its documents have learnable labels of both
classes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import bpe, language_id, mixing, ngram_join, quality_classifier
from stratum.llm.common import fold_is, read_table, stored
from stratum.llm.registry import learnt_labels
from stratum.session import scratch_path

_P = "__stage_"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters, or unlike every learned language, go. Without any
    learned language all stay."""
    train = docs.where(~fold_is(F.col("doc_id"), 5, 0))
    model = language_id.collect_profiles(language_id.train_profiles(train))
    if not model[0]:
        return docs
    found = docs.withColumn(_P + "language", language_id.predictor(model)(F.col("text")))
    return found.where(language_id.accepted(F.col(_P + "language"))).select(*docs.columns)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below the threshold go. Without labels of both classes
    nothing tells them apart, and all stay."""
    model = quality_classifier.fit(docs, learnt_labels(spark, sf_dir))
    if not model.fitted:
        return docs
    score = quality_classifier.score(F.col("text"), model)
    return (docs.withColumn(_P + "score", score)
            .where(F.col(_P + "score") >= quality_classifier.THRESHOLD).select(*docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of documents joined by links, the one with the smallest id stays.

    Rows without id cannot be named and stay. Where an id repeats, its rows are told apart by their
    sets: of a group the set of the smallest (id, class) stays, of its rows with that id the one with the
    least text (then lang, source); of rows with one id and no words one stays.
    """
    found = stored(ngram_join.components(docs).where("id is not null").select("id", "class", "component"), "joined")
    best = found.where("component is not null").groupBy("component").agg(F.min(F.struct("id", "class")).alias("b"))
    stays = stored(best.select("b.id", "b.class").unionByName(
        found.where("component is null").select("id", "class").distinct()), "stays")
    again = stored(found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "again")
    of = F.col("doc_id") == F.col(_P + "id")
    once = stays.join(again, "id", "left_anti").select(F.col("id").alias(_P + "id"))
    kept = docs.join(once, of, "left_semi").unionByName(docs.where("doc_id is null"))
    if not again.take(1):
        return kept
    rows = (docs.join(again.select(F.col("id").alias(_P + "id")), of, "left_semi")
            .withColumn(_P + "class", ngram_join.class_of_text(F.col("text"))))
    those = stays.select(F.col("id").alias(_P + "id"), F.col("class").alias(_P + "of"))
    least = (rows.join(those, of & F.col(_P + "class").eqNullSafe(F.col(_P + "of")), "left_semi")
             .groupBy("doc_id", _P + "class")
             .agg(F.min_by(F.struct(*docs.columns), F.struct("text", "lang", "source")).alias(_P + "row")))
    return kept.unionByName(least.select(*[F.col(f"{_P}row.`{c}`").alias(c) for c in docs.columns]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a document appears as often as the mix takes it, or not at all."""
    mixed = mixing.mix(docs.select(F.struct(*docs.columns).alias(_P + "row"), "doc_id", "text", "source"))
    again = mixed.select(_P + "row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias(_P + "copy"))
    return again.select(*[F.col(f"{_P}row.`{c}`").alias(c) for c in docs.columns])


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding: token ids of every document, with digests of ids and decoded text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.encode(docs.select("doc_id", "text"), path, decoded=_P + "text")
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2(F.col("ids"), 256).alias("ids_sha256"),
                       F.sha2(F.encode(_P + "text", "UTF-8"), 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("language_id", keep_known_languages),
    ("quality_classifier", keep_good_quality),
    ("ngram_join", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: SQL cannot express a fitted classifier or the sampling; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "corpus-pipeline")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
