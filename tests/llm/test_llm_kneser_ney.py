import collections
import math
import os
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import kneser_ney
from stratum.llm.registry import op6_lm_score


def compare(found, model, rows):
    for r in found:
        n, known, base, score = model.score(rows[r.doc_id])
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_matches_brute_force_on_documents(spark, doc_rows):
    model = brute.KneserNey([t for i, t, _, _ in doc_rows if brute.fold(i, 5) != 1])
    found = op6_lm_score(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(doc_rows)
    compare(found, model, {i: t for i, t, _, _ in doc_rows})
    assert {r.train_tokens for r in found} == {sum(model.unigrams.values())}
    assert all(r.held_out == (brute.fold(r.doc_id, 5) == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_many_shards_and_hot_contexts(spark, docs, doc_rows):
    model = kneser_ney.train(docs, tokens_a_shard=4_000, words_a_shard=5_000)
    assert model.shards > 2 and model.word_shards > 1 and len(model.hot.words) > 0
    found = docs.select("doc_id", kneser_ney.score(F.col("text"), model).alias("s")).select("doc_id", "s.*").collect()
    compare(found, brute.KneserNey([t for _, t, _, _ in doc_rows]), {i: t for i, t, _, _ in doc_rows})


def test_probabilities_sum_to_one(docs, doc_rows):
    reference = brute.KneserNey([t for _, t, _, _ in doc_rows[:40]])
    v = len(reference.unigrams)
    for context in ("<start>", doc_rows[0][1].lower().split()[0], "never seen"):
        total = sum(reference.p(context, w) for w in reference.unigrams) + reference.p(context, "an unknown word")
        assert total == pytest.approx(1, abs=1e-9) and v > 100


def test_model_files_are_sorted_hash_arrays(spark, docs):
    model = kneser_ney.train(docs)
    there = kneser_ney._load(model.folder, "bigram-0-hash")
    assert isinstance(there, np.memmap) and (np.diff(there.astype(object)) > 0).all()
    names = os.listdir(kneser_ney._place(model.folder)[1])
    assert all(n.endswith(".npy") for n in names)       # no drafts are left


def test_edge_texts(make_docs):
    rows = [(1, "a b a b A"), (2, None), (3, ""), (4, " \t\n"), (5, "x " * 30_000), (6, "é z"), (7, "a b"), (7, "a b"), (None, "q")]
    df = make_docs([(i, t, None, None) for i, t in rows]).withColumn("score", F.lit("clash")).withColumn("key", F.lit(0))
    model = kneser_ney.train(df)
    found = df.withColumn("s", kneser_ney.score(F.col("text"), model)).select("doc_id", "s.*").collect()
    assert len(found) == len(rows)
    compare(found, brute.KneserNey([t for _, t in rows]), dict(rows))


def test_nothing_to_learn_from(make_docs):
    empty = make_docs([])
    model = kneser_ney.train(empty)
    df = make_docs([(1, "a b", None, None)])
    s = df.select(kneser_ney.score(F.col("text"), model).alias("s")).first().s
    assert (s.n_tokens, s.n_known, s.base_score, s.score) == (3, 0, 0.0, 0.0)
    assert empty.select(kneser_ney.score(F.col("text"), model)).collect() == []


class PlainModel:
    """Interpolated modified Kneser-Ney of any order over plain tuples."""

    def __init__(self, texts, order):
        self.order, self.seen = order, collections.Counter()
        raw = [collections.Counter() for _ in range(order + 1)]
        for t in texts:
            w = ["<start>", *brute.KneserNey.tokens(t)]
            self.seen.update(w[1:])
            for k in range(1, order + 1):
                raw[k].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1) if i + k > 1)
        self.counts = [None]
        for k in range(1, order + 1):
            before = collections.Counter(g[1:] for g in raw[k + 1]) if k < order else {}
            self.counts.append({g: n if k == order or g[0] == "<start>" else before[g] for g, n in raw[k].items()
                                if g != ("<start>",)})
        self.less = [None, *[brute.KneserNey.discounts(c.values()) for c in self.counts[1:]]]
        self.after = [None]
        for k in range(1, order + 1):
            groups = collections.defaultdict(list)
            for g, n in self.counts[k].items():
                groups[g[:-1]].append(n)
            self.after.append({h: (sum(c), sum(self.less[k][min(n, 3) - 1] for n in c)) for h, c in groups.items()})

    def p(self, context, w):
        if not context:
            below, k = 1 / (len(self.seen) + 1), 1
        else:
            below, k = self.p(context[1:], w), len(context) + 1
        if context not in self.after[k]:
            return below
        total, mass = self.after[k][context]
        less = self.less[k]
        c = self.counts[k].get((*context, w), 0)
        own = (c - less[min(c, 3) - 1]) if c else 0
        return (own + mass * below) / total

    def score(self, text):
        w = ["<start>", *brute.KneserNey.tokens(text)]
        return sum(math.log10(self.p(tuple(w[max(0, i - self.order + 1):i]), w[i])) for i in range(1, len(w)))


@pytest.mark.parametrize("order,shards", [(2, 1), (3, 7), (4, 3)])
def test_any_order_matches_a_plain_model(spark, docs, doc_rows, order, shards):
    held = F.pmod(F.col("doc_id"), F.lit(3)) == 0
    tokens = sum(len(brute.words(t)) + 1 for i, t, _, _ in doc_rows if i % 3)
    model = kneser_ney.train(docs.where(~held), order=order, tokens_a_shard=-(-tokens // shards))
    assert model.order == order and model.shards == shards
    plain = PlainModel([t for i, t, _, _ in doc_rows if i % 3], order)
    rows = doc_rows[:70] + [(-1, None, "", ""), (-2, "", "", ""), (-3, "never seen words here", "", "")]
    df = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    found = {r.doc_id: r.s for r in df.select("doc_id", kneser_ney.score(F.col("text"), model).alias("s")).collect()}
    for i, t, _, _ in rows:
        assert found[i].score == pytest.approx(plain.score(t), rel=1e-9, abs=1e-9)


def test_longer_n_grams_set_repeated_texts_apart(make_docs):
    """A text that occurs twice scores higher above its words' own frequency the longer the n-grams are."""
    rng = random.Random(8)
    new = lambda: " ".join(f"w{rng.randrange(200)}" for _ in range(150))
    twice, rows = [new() for _ in range(6)], []
    for k in range(120):
        rows.append((k, new(), None, None))
    rows += [(1000 + k, t, None, None) for k, t in enumerate(twice * 2)]
    gains = []
    for order in (2, 3):
        df = make_docs(rows)
        model = kneser_ney.train(df, order=order)
        got = df.select("doc_id", kneser_ney.score(F.col("text"), model).alias("s")).select("doc_id", "s.*").collect()
        mean = lambda keep: np.mean([(r.score - r.base_score) / r.n_tokens for r in got if keep(r.doc_id)])
        gains.append(mean(lambda i: i >= 1000) - mean(lambda i: i < 1000))
    assert gains[1] > gains[0] > 0


def test_order_below_two_is_refused(docs):
    with pytest.raises(ValueError):
        kneser_ney.train(docs, order=1)
