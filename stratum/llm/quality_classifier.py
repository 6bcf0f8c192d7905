"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

Features say which n-grams a text holds: its lower-cased words and pairs of neighbouring ones, and runs
of one to three word shapes (letters, capitals, digits as single marks, other characters as they are,
repeats collapsed; a word that equals the one before it has the shape ``=``). They are hashed to
2**``hash_bits`` columns. Each indicator is scaled by its class log-count ratio, counted over all
labelled training rows in Spark. A linear hinge-loss model is then fitted to the scaled features
by dual coordinate descent on a bounded sample of those rows (``max_fit``), and its margin is
turned into a probability by a logistic curve fitted to held-back rows of the sample.

Scale: class counts are summed per task before the shuffle (at most two numbers a column); the
driver receives those and the sample's features, both bounded by parameters. The model is one
weight a column. Labels are broadcast to the documents up to ``MAX_BROADCAST_LABELS`` rows,
counted first, so texts are not shuffled; beyond that both are joined by a shuffle.

Defined cases: NULL and empty texts have no features and get the score of the bias alone; labels
that repeat for an id: every row counts, as does every document of an id; NULL labels and ids are ignored; with one class or none the score is
the share of label 1 (0.5 without labels); texts of any length are read whole; rows that repeat are
each scored; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.hashed_words import arrow_slices, mix, release_memory, slices

HASH_BITS = 18
WORD_RUN, SHAPE_RUN = 2, 3  # longest n-grams
MAX_FIT = 8000              # labelled rows that the dual coordinate descent sees, about
MAX_BROADCAST_LABELS = 1 << 20      # of 12 bytes
THRESHOLD = 0.7
ALPHA = 1.0                 # added to the class counts
C = 1.0
EPOCHS = 20


class Model(NamedTuple):
    weights: np.ndarray     # by column, log-count ratio included
    bias: float
    slope: float
    offset: float
    fitted: bool = True     # False: one class or none, the score is a constant


class _Marks(dict):
    """Code point -> its mark in a word shape, worked out once each."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = mark = ("A" if c.isupper() else "a") if c.isalpha() else "9" if c.isdigit() else c
        return mark


_marks = _Marks()


def shapes_of(words: list[str]) -> list[str]:
    """The shape of each word; words hold no line feed."""
    return re.sub(r"([^\n])\1+", r"\1", "\n".join(words).translate(_marks)).split("\n")


def features(texts: list[str], hash_bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every distinct indicator of the texts, sorted by row and column."""
    split = [t.encode().split() for t in texts]     # ASCII white space
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    words = np.array([w for ws in split for w in ws], dtype=object)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    row = np.repeat(np.arange(len(split)), sizes)
    code, distinct = pd.factorize(words)
    texts_of = [w.decode() for w in distinct]
    lower = pd.util.hash_array(np.array([w.lower() for w in texts_of], dtype=object), categorize=False)
    shapes = pd.util.hash_array(np.array(shapes_of(texts_of), dtype=object), categorize=False)
    shape = shapes[code]
    again = np.zeros(len(code), bool)
    again[1:] = (code[1:] == code[:-1]) & (row[1:] == row[:-1])
    shape[again] = np.uint64(61)
    found = []
    for kind, gram, longest in ((1, lower[code], WORD_RUN), (2, shape, SHAPE_RUN)):
        run = mix(gram ^ np.uint64(kind))
        found.append((row, run))
        for n in range(2, min(longest, len(gram)) + 1):
            run = mix(run[:-1] * np.uint64(31) + gram[n - 1:])
            inside = row[n - 1:] == row[:len(row) - n + 1]
            found.append((row[n - 1:][inside], run[inside]))
    key = np.concatenate([r << hash_bits | (h >> np.uint64(64 - hash_bits)).astype(np.int64) for r, h in found])
    key = np.unique(key)
    return key >> hash_bits, key & ((1 << hash_bits) - 1)


def _counter(hash_bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = 1 << hash_bits
        counts, rows = np.zeros((2, columns), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            label = np.array(batch.column(1).to_pylist(), np.int64)
            rows += np.bincount(label, minlength=2)
            for start, part in arrow_slices(batch.column(0)):
                row, column = features(part, hash_bits)
                for k in (0, 1):
                    at, n = np.unique(column[label[start + row] == k], return_counts=True)
                    counts[k][at] += n
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *at.tolist()], pa.int32()), pa.array([rows[0], *counts[0][at]], pa.int64()),
             pa.array([rows[1], *counts[1][at]], pa.int64())], names=["column", "n0", "n1"])
        del counts
        release_memory()
    return count


def _sampler(hash_bits: int):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for start, part in arrow_slices(batch.column(0)):
                row, column = features(part, hash_bits)
                ends = np.searchsorted(row, np.arange(len(part) + 1))
                own = [column[a:z].astype("<i4").tobytes() for a, z in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(labels[start:start + len(part)], pa.int32()), pa.array(own, pa.binary())],
                    names=["label", "columns"])
    return sample


def _descend(rows: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, c: float,
             epochs: int) -> tuple[np.ndarray, float]:
    """L2-regularised squared-hinge support vectors by dual coordinate descent."""
    y = np.where(label > 0, 1.0, -1.0)
    weight = c * len(y) / (2 * np.bincount((y > 0).astype(int), minlength=2))[(y > 0).astype(int)]
    diagonal = 1 / (2 * weight)
    square = np.array([ratio[x] @ ratio[x] for x in rows]) + 1 + diagonal
    w, bias, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(y))
    order, rng = np.arange(len(y)), np.random.default_rng(7)
    for _ in range(epochs):
        rng.shuffle(order)
        moved = 0.0
        for i in order.tolist():
            x, v = rows[i], ratio[rows[i]]
            gradient = y[i] * (w[x] @ v + bias) - 1 + diagonal[i] * dual[i]
            new = max(dual[i] - gradient / square[i], 0.0)
            if (change := (new - dual[i]) * y[i]) != 0:
                w[x] += change * v
                bias += change
                moved = max(moved, abs(change))
                dual[i] = new
        if moved < 1e-6:
            break
    return w, bias


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """slope and offset of P(label 1 | margin), by Newton steps with smoothed targets."""
    n1, n0 = label.sum(), len(label) - label.sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        theta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_LABELS else df


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_fit: int = MAX_FIT, c: float = C, epochs: int = EPOCHS,
        hash_bits: int = HASH_BITS) -> Model:
    """Fit on the documents that ``labels`` (id, label) marks 0 or 1. Class counts cover all of them;
    the descent sees a sample of about ``max_fit``, drawn by a hash of the id, the rarer class first."""
    given = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where("label in (0, 1) and id is not null"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    many, columns = given.count(), 1 << hash_bits
    rows = texts.join(_bounded(given, many), "id")
    counts = (rows.select("text", "label").mapInArrow(_counter(hash_bits), "column int, n0 long, n1 long")
              .groupBy("column").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))).toPandas()
    total = counts[counts["column"] < 0][["n0", "n1"]].to_numpy(np.float64).sum(axis=0)
    if not total.all():
        share = total[1] / total.sum() if total.sum() else 0.5
        return Model(np.zeros(columns), 0.0, 0.0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), False)
    counts = counts[counts["column"] >= 0]
    at = counts["column"].to_numpy()
    p, q = (ALPHA + np.bincount(at, counts[n], columns) for n in ("n1", "n0"))
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())

    half = max_fit / 2
    fewer = min(half, total.min())
    share = [(fewer if t == total.min() else max_fit - fewer) / t for t in total]
    uniform = F.shiftrightunsigned(F.xxhash64(F.lit(17), "id"), 11) / F.lit(float(2 ** 53))
    drawn = given.where(uniform < F.when(F.col("label") == 0, share[0]).otherwise(share[1]))
    chosen = texts.join(_bounded(drawn, drawn.count()), "id")
    sample = chosen.select("text", "label").mapInArrow(_sampler(hash_bits), "label int, columns binary").toPandas()
    sample = sample.sort_values(["columns", "label"], kind="stable").reset_index(drop=True)  # one order each run
    label = sample["label"].to_numpy()
    own = [np.frombuffer(b, "<i4") for b in sample["columns"]]
    held = np.random.default_rng(5).permutation(len(label)) % 4 == 0
    if len(set(label[~held])) < 2 or len(set(label[held])) < 2:
        held = np.zeros(len(label), bool)
    part = np.flatnonzero(~held)
    w, bias = _descend([own[i] for i in part], label[part], ratio, c, epochs)
    check = np.flatnonzero(held) if held.any() else part
    weights = w * ratio
    margin = np.array([weights[own[i]].sum() + bias for i in check])
    slope, offset = _logistic(margin, label[check])
    # the sample holds the classes in other shares than the training rows: undo that in the odds
    drawn = np.bincount(label, minlength=2) / total
    offset -= float(np.log(drawn[1] / drawn[0]))
    return Model(weights, bias, slope, offset)


def score(text: Column, model: Model) -> Column:
    """text -> probability of label 1."""
    weights, hash_bits = model.weights.astype(np.float32), len(model.weights).bit_length() - 1

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            margin = np.full(len(texts), model.bias)
            for start, part in slices(texts.tolist()):
                row, column = features(part, hash_bits)
                margin[start:start + len(part)] += np.bincount(row, weights[column], len(part))
            odds = np.clip(model.slope * margin + model.offset, -40, 40)
            yield pd.Series(1 / (1 + np.exp(-odds)))
        release_memory()

    return probability(text)
