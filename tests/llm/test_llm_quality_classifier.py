import collections
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratum.llm import quality_classifier as q
from stratum.llm.common import read_table
from stratum.llm.registry import learnt_labels, op7_quality_classifier

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_clean_documents(spark):
    found = op7_quality_classifier(spark, SF)
    rows = found.join(read_table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in rows]
    good = [r.predicted for r in rows if r.quality == 1]
    assert len(rows) > 50 and np.mean(right) >= 0.95 and np.mean(good) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_reruns_agree(spark):
    docs = read_table(spark, SF, "documents")
    labels = learnt_labels(spark, SF)
    a, b = q.fit(docs, labels), q.fit(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(a.weights, b.weights) and a[1:] == b[1:]


def test_score_equals_the_plain_sum(spark, docs, doc_rows):
    model = q.fit(docs, learnt_labels(spark, "/root/testdata/sf0.001"))
    got = {r.doc_id: r.p for r in docs.select("doc_id", q.score(F.col("text"), model).alias("p")).collect()}
    weights = model.weights.astype(np.float32)
    for i, text, _, _ in doc_rows[:60]:
        margin = model.bias + sum(float(weights[c]) for c in set(q.features([text])[1].tolist()))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.offset))), abs=1e-6)


def test_features_do_not_depend_on_neighbours(doc_rows):
    texts = [t for _, t, _, _ in doc_rows[:30]] + ["", "a", "a a a", "a b"]
    row, column = q.features(texts)
    for k, t in enumerate(texts):
        assert column[row == k].tolist() == q.features([t])[1].tolist()


def test_edge_rows(make_docs):
    texts = [("good words here", 1), ("### $$$ %%%", 0), ("more good words", 1), ("&&& ***", 0), (None, 1), ("", 0), ("x " * 40_000, 1)]
    df = make_docs([(i, t, None, None) for i, (t, _) in enumerate(texts * 5)])
    labels = df.select("doc_id", F.when(F.col("doc_id") % 7 == 3, None).otherwise((F.col("doc_id") % 2 == 0).cast("int"))
                       .alias("quality"))
    labels = labels.union(labels.limit(3)).union(labels.select(F.lit(None).cast("long"), F.lit(1)).limit(1))
    clash = df.withColumn("label", F.lit("clash")).withColumn("id", F.lit(0))
    model = q.fit(clash, labels)
    p = [r.p for r in df.select(q.score(F.col("text"), model).alias("p")).collect()]
    assert len(p) == 35 and all(0 <= x <= 1 for x in p)
    none = q.fit(df, labels.where("false"))
    assert {r.p for r in df.select(q.score(F.col("text"), none).alias("p")).collect()} == {0.5}
    ones = q.fit(df, labels.where("quality = 1"))
    assert all(r.p > 0.99 for r in df.select(q.score(F.col("text"), ones).alias("p")).collect())


def test_shapes():
    assert q.shapes_of(["Hello", "THE!!", "a1b22", "Éa###", "|", "中文"]) == ["Aa", "A!", "a9a9", "Aa#", "|", "a"]
    assert q.shapes_of(["x"]) == ["a"]


# -- the whole fit in plain Python ------------------------------------------------------------------

ALL = (1 << 64) - 1


def mix(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & ALL
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & ALL
    return h ^ (h >> 31)


def hashed(text):
    return int(pd.util.hash_array(np.array([text], dtype=object), categorize=False)[0])


def plain_shape(word, before):
    if word == before:
        return 61
    marks = "".join(("A" if c.isupper() else "a") if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return hashed("".join(c for k, c in enumerate(marks) if k == 0 or marks[k - 1] != c))


def plain_columns(text, bits):
    words = [w.decode() for w in (text or "").encode().split()]
    lower = [hashed(w.lower()) for w in words]
    shapes = [plain_shape(w, words[k - 1] if k else None) for k, w in enumerate(words)]
    found = set()
    for kind, gram, longest in ((1, lower, 2), (2, shapes, 3)):
        for i in range(len(gram)):
            run = mix(gram[i] ^ kind)
            found.add(run >> (64 - bits))
            for g in gram[i + 1:i + longest]:
                run = mix((run * 31 + g) & ALL)
                found.add(run >> (64 - bits))
    return sorted(found)


def plain_descent(rows, label, ratio, c=1.0, epochs=20):
    y = [1 if x else -1 for x in label]
    many = [sum(x == s for x in y) for s in (-1, 1)]
    weight = [c * len(y) / (2 * many[(x > 0)]) for x in y]
    w, bias, dual = {}, 0.0, [0.0] * len(y)
    order, rng = np.arange(len(y)), np.random.default_rng(7)
    for _ in range(epochs):
        rng.shuffle(order)
        moved = 0.0
        for i in order.tolist():
            margin = sum(w.get(f, 0.0) * ratio(f) for f in rows[i]) + bias
            square = sum(ratio(f) ** 2 for f in rows[i]) + 1 + 1 / (2 * weight[i])
            new = max(dual[i] - (y[i] * margin - 1 + dual[i] / (2 * weight[i])) / square, 0.0)
            change = (new - dual[i]) * y[i]
            for f in rows[i]:
                w[f] = w.get(f, 0.0) + change * ratio(f)
            bias += change
            moved, dual[i] = max(moved, abs(change)), new
        if moved < 1e-6:
            break
    return w, bias


@pytest.mark.parametrize("bits", [10, 20])
def test_features_against_a_plain_version(doc_rows, bits):
    texts = [t for _, t, _, _ in doc_rows[:40]] + ["", "a", "a a a b", "É É 12 x#y", "x y z"]
    row, column = q.features(texts, bits)
    for k, t in enumerate(texts):
        assert column[row == k].tolist() == plain_columns(t, bits)


def test_fit_against_brute_force(spark, docs, doc_rows):
    """Class log-count ratios, the descent and the logistic curve, recomputed from texts and labels."""
    bits, sf = 14, "/root/testdata/sf0.001"
    model = q.fit(docs, learnt_labels(spark, sf), hash_bits=bits)
    texts = {i: plain_columns(t, bits) for i, t, _, _ in doc_rows}
    given = [(r.doc_id, r.quality) for r in learnt_labels(spark, sf).where("quality in (0, 1)").collect() if r.doc_id in texts]
    counts, total = [collections.Counter(), collections.Counter()], [0, 0]
    for i, y in given:
        counts[y].update(texts[i])
        total[y] += 1
    sums = [sum(c.values()) + (1 << bits) for c in counts]
    ratio = lambda f: math.log((counts[1][f] + 1) / sums[1]) - math.log((counts[0][f] + 1) / sums[0])
    rows = sorted(((np.array(texts[i], "<i4").tobytes(), y, i) for i, y in given), key=lambda r: r[:2])
    assert len(rows) < q.MAX_FIT and min(total) > 5           # so the sample is all of them
    held = np.random.default_rng(5).permutation(len(rows)) % 4 == 0
    w, bias = plain_descent([texts[i] for (_, _, i), h in zip(rows, held) if not h],
                            [y for (_, y, _), h in zip(rows, held) if not h], ratio)
    assert model.bias == pytest.approx(bias, abs=1e-6)
    seen = {f for t in texts.values() for f in t}
    for f in seen:
        assert model.weights[f] == pytest.approx(w.get(f, 0.0) * ratio(f), abs=1e-6)
    # the curve: its gradient over the rows held back is zero for the smoothed targets
    check = [(sum(model.weights[f] for f in texts[i]) + model.bias, y) for (_, y, i), h in zip(rows, held) if h]
    n1 = sum(y for _, y in check)
    n0 = len(check) - n1
    p = [1 / (1 + math.exp(-(model.slope * m + model.offset))) for m, _ in check]
    want = [(n1 + 1) / (n1 + 2) if y else 1 / (n0 + 2) for _, y in check]
    assert sum(a - b for a, b in zip(p, want)) == pytest.approx(0, abs=1e-3)
    assert sum((a - b) * m for a, b, (m, _) in zip(p, want, check)) == pytest.approx(0, abs=1e-3)


def test_descent_reaches_the_optimum():
    """The dual's conditions hold at the result: w is the sum of the rows by their squared-hinge slack."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 60, 12)) for _ in range(150)]
    ratio, label = rng.normal(size=60), rng.integers(0, 2, 150)
    w, bias = q._descend(rows, label, ratio, 1.0, 5000)
    y = np.where(label > 0, 1.0, -1.0)
    weight = 150 / (2 * np.bincount(label, minlength=2))[label]
    margin = np.array([w[x] @ ratio[x] + bias for x in rows])
    dual = 2 * weight * np.maximum(1 - y * margin, 0)
    again = np.zeros(60)
    for x, a in zip(rows, dual * y):
        again[x] += a * ratio[x]
    assert np.abs(again - w).max() < 1e-2 and abs((dual * y).sum() - bias) < 1e-2


def test_repeated_documents_and_empty_tables(spark, make_docs):
    """Every document of an id counts, with every label of it; nothing to learn from and nothing to score."""
    rows = [(1, "good words", None, None)] * 3 + [(2, "### bad", None, None)] * 2 + [(3, "good again", None, None)]
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    counts = (make_docs(rows).join(labels, "doc_id").select("text", F.col("quality").alias("label"))
              .mapInArrow(q._counter(8), "column int, n0 long, n1 long").where("column = -1").agg(F.sum("n0"), F.sum("n1")).first())
    assert tuple(counts) == (2, 7)
    model = q.fit(make_docs(rows), labels)
    assert len({r.p for r in make_docs(rows[:3]).select(q.score(F.col("text"), model).alias("p")).collect()}) == 1
    none = q.fit(make_docs([]), labels)
    assert not none.fitted and make_docs([]).select(q.score(F.col("text"), none).alias("p")).collect() == []
