"""Driver queries of this subpackage: one opN_<name> per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (bpe, centroid_clustering, conversation_trie, kneser_ney, language_id, mixing, ngram_join,
                         permutation_index, phrase_fingerprints, quality_classifier, quality_rules, token_counts,
                         url_filter)
from stratum.llm.common import fold_is, read_table
from stratum.llm.oracle_sql import ORACLE_SQL  # noqa: F401

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def learnt_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, quality of the labels that may be learnt from."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return labels.where(~fold_is(F.col("doc_id"), 4, 2))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.components(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of pages whose document is labelled toxic."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    toxic = read_table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("page_id"))
    listed = (pages.join(toxic, "page_id", "left_semi")
              .select(url_filter.canonical_url(F.col("url")).alias("url")))
    return url_filter.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.encode(docs, path, decoded="decoded")
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2(F.col("ids"), 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return permutation_index.search(vectors, F.pmod(F.col("vec_id"), F.lit(100)) == 0)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_is(F.col("doc_id"), 5, 1)
    model = kneser_ney.train(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), kneser_ney.score(F.col("text"), model).alias("s"))
    return rows.select("doc_id", "held_out", "s.n_tokens", "s.n_known",
                       F.lit(model.tokens).cast("long").alias("train_tokens"), "s.base_score", "s.score")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, learnt_labels(spark, sf_dir))
    rows = docs.select("doc_id", fold_is(F.col("doc_id"), 4, 2).alias("held_out"),
                       quality_classifier.score(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= quality_classifier.THRESHOLD).cast("int"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = read_table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                       token_counts.count_tokens(F.col("text"), path).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > 2048)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good"))
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"), labels)
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = docs.where(~fold_is(F.col("doc_id"), 5, 0))
    found = language_id.identify(docs, train)
    return found.select("doc_id", fold_is(F.col("doc_id"), 5, 0).alias("held_out"),
                        F.col("language.lang_pred").alias("lang_pred"), F.col("language.score").alias("score"))


def op11_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phrase_fingerprints.compare_with_next(read_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
                       *[F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")],
                       "near_edited", "near_next")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = centroid_clustering.grid(read_table(spark, sf_dir, "embeddings"))
    by_hash = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256).asc_nulls_last()
    found = centroid_clustering.cluster(points, [by_hash])
    return centroid_clustering.report(found).withColumnRenamed("id", "vec_id")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = conversation_trie.conversations(read_table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.with_shared_heads(convs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_mixing": op2_mixing,
    "op3_url_filter": op3_url_filter,
    "op4_bpe": op4_bpe,
    "op5_nearest_vectors": op5_nearest_vectors,
    "op6_lm_score": op6_lm_score,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_phrase_fingerprints": op11_phrase_fingerprints,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_conversation_trie": op13_conversation_trie,
}
