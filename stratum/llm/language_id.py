"""Language identification by rank-order n-gram profiles (out-of-place distance).

A language's profile is the list of its ``profile_size`` most frequent character 1- to 3-grams
over all training texts, most frequent first (ties: smaller gram code). A document's own list is
made the same way. Its distance to a profile is the sum over the document's grams of how far each
is out of place, with ``profile_size`` for a gram the profile lacks; the nearest profile wins
(ties: the language first in code-point order).

Grams stay inside words: letters are lower-cased, every run of other characters is one
boundary mark. A gram is its code points packed into one integer, so nothing is hashed and any
script works.

Defined cases: NULL, empty and letter-free texts -> ``und`` with score 0; no training rows -> all
``und``; texts of any length are read whole; rows that repeat count each time; columns other than
the named ones are ignored by training and passed through by prediction.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.hashed_words import release_memory

UNDETERMINED = "und"
BOUNDARY = 1            # code point U+0001 marks a word boundary; it is never a letter
PROFILE_SIZE = 400
MIN_SCORE = 0.15        # below it a document looks like none of the languages
_CHUNK_CHARS = 1 << 20
_CODE_BITS = 21         # a code point fits in 21 bits, a 3-gram in 63


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """is-letter flag by code point."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_codes(text: str) -> np.ndarray:
    """All 1- to 3-grams of a text as packed integers, repeats included."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]                       # the first non-letter after a word stays
    seq = np.where(letter, points, BOUNDARY)[keep].astype(np.int64)
    seq = np.concatenate(([BOUNDARY], seq, [BOUNDARY])) if seq[-1] != BOUNDARY \
        else np.concatenate(([BOUNDARY], seq))
    one = seq[seq != BOUNDARY]
    two = seq[:-1] | seq[1:] << _CODE_BITS
    three = (two[:-1] | seq[2:] << 2 * _CODE_BITS)[seq[1:-1] != BOUNDARY]
    return np.concatenate((one, two, three))


def ranked_grams(text: str, size: int) -> np.ndarray:
    """The text's most frequent grams, most frequent first."""
    grams, counts = np.unique(gram_codes(text), return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:size]]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(lang: str) -> None:
            grams, counts = np.unique(gram_codes("\n".join(parts.pop(lang))), return_counts=True)
            found.setdefault(lang, []).append((grams, counts))
            sizes[lang] = 0

        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parts.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] > _CHUNK_CHARS:
                flush(lang)
        for lang in list(parts):
            flush(lang)
        for lang, pieces in found.items():
            grams, where = np.unique(np.concatenate([g for g, _ in pieces]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([c for _, c in pieces]), len(grams))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()),
                 pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])
    release_memory()


def train_profiles(train: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   profile_size: int = PROFILE_SIZE) -> DataFrame:
    """(lang, gram, rank) of each language's most frequent grams, counted over every training text.

    Tasks count grams locally, so the shuffle carries at most one row per language and distinct
    gram of a batch, however much text one language has; ranking then sees distinct grams only.
    """
    counts = (train.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
              .where("lang is not null and text is not null")
              .mapInArrow(_count_batches, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counts.withColumn("rank", F.row_number().over(order) - 1)
            .where(F.col("rank") < profile_size).select("lang", "gram", "rank"))


def collect_profiles(profiles: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, sorted grams, rank of each gram by language).

    At most ``profile_size`` rows a language reach the driver; the profiles are the model.
    """
    rows = profiles.toPandas()
    langs = sorted(rows["lang"].unique(), key=lambda s: s.encode())
    grams = np.unique(rows["gram"].to_numpy(np.int64))
    size = int(rows["rank"].max()) + 1 if len(rows) else 0
    ranks = np.full((len(grams), len(langs)), max(size, 1), np.int32)
    at = {name: k for k, name in enumerate(langs)}
    ranks[np.searchsorted(grams, rows["gram"]), rows["lang"].map(at)] = rows["rank"]
    return langs, grams, ranks


def predictor(profiles: tuple[list[str], np.ndarray, np.ndarray],
              profile_size: int = PROFILE_SIZE):
    """text column -> struct<lang_pred string, score double>; score is 1 - distance / worst."""
    langs, grams, ranks = profiles

    def one(text: str | None) -> tuple[str, float]:
        own = ranked_grams(text, profile_size) if text else np.empty(0, np.int64)
        if not len(own) or not langs:
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        place = np.where((grams[at] == own)[:, None], ranks[at], -1)
        here = np.arange(len(own))[:, None]
        apart = np.where((place < 0) | (place >= profile_size), profile_size,
                         np.minimum(np.abs(place - here), profile_size))
        total = apart.sum(axis=0)
        best = int(total.argmin())
        return langs[best], float(1 - total[best] / (profile_size * len(own)))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score"])
        release_memory()

    return predict


def identify(df: DataFrame, train: DataFrame, text_col: str = "text", lang_col: str = "lang",
             profile_size: int = PROFILE_SIZE, out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out`` (lang_pred, score); a column of that name is replaced."""
    model = collect_profiles(train_profiles(train, text_col, lang_col, profile_size))
    return df.withColumn(out, predictor(model, profile_size)(F.col(text_col)))


def accepted(prediction: Column, min_score: float = MIN_SCORE) -> Column:
    """Whether a document counts as written in one of the learned languages."""
    return (prediction["lang_pred"] != UNDETERMINED) & (prediction["score"] >= min_score)
