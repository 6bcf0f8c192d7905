import collections

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as p
from stratum.llm import language_id, quality_classifier
from stratum.llm.registry import learnt_labels

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """Rows after each stage, the documents first, as the stages hand them on."""
    folder, docs = tmp_path_factory.mktemp("chain"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(p.STAGES):
        stage(spark, out[-1], SF).write.parquet(str(folder / str(k)))
        out.append(spark.read.parquet(str(folder / str(k))))
    return out


def rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_columns(chain):
    assert all(df.columns == chain[0].columns for df in chain[:5])
    assert [name for name, _ in p.STAGES] == ["language_id", "quality_classifier", "ngram_join", "mixing", "bpe"]


def test_language_stage(chain):
    docs = rows(chain[0])
    counts = collections.defaultdict(collections.Counter)
    for i, text, lang, _ in docs:
        if brute.fold(i, 5) and lang is not None and text is not None:
            counts[lang].update(brute.grams(text))
    size = language_id.PROFILE_SIZE
    profiles = {lang: brute.profile(c, size) for lang, c in counts.items()}
    want = []
    for i, text, _, _ in docs:
        lang, score = brute.predict_language(profiles, text, size)
        if lang != "und" and score >= language_id.MIN_SCORE:
            want.append(i)
    assert sorted(r[0] for r in rows(chain[1])) == sorted(want)


def test_quality_stage(spark, chain):
    model = quality_classifier.fit(chain[1], learnt_labels(spark, SF))
    weights = model.weights.astype(np.float32)
    want = []
    for i, text, _, _ in rows(chain[1]):
        margin = model.bias + sum(float(weights[c]) for c in set(quality_classifier.features([text])[1].tolist()))
        if 1 / (1 + np.exp(-(model.slope * margin + model.offset))) >= quality_classifier.THRESHOLD:
            want.append(i)
    assert sorted(r[0] for r in rows(chain[2])) == sorted(want)


def test_join_stage(chain):
    found = brute.join_components([(i, t) for i, t, _, _ in rows(chain[2])])
    assert sorted(r[0] for r in rows(chain[3])) == sorted(i for i, _, c in found if i == c)


def test_mixing_stage(chain):
    docs, times = rows(chain[3]), collections.Counter(r[0] for r in rows(chain[4]))
    size = {i: len(brute.words(t)) for i, t, _, _ in docs}
    total, taken = collections.Counter(), collections.Counter()
    for i, _, _, s in docs:
        total[s] += size[i]
        taken[s] += size[i] * times[i]
    want = brute.targets(total)
    assert max(times.values()) <= 3
    for s in total:
        assert abs(taken[s] - want[s]) <= max(size[i] for i, _, _, x in docs if x == s) / 2 + 1e-6


def test_last_stage_and_run(spark, chain):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = collections.Counter((r[0], r[1]) for r in rows(chain[4]))
    last = chain[5].collect()
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts}
    assert collections.Counter(r.doc_id for r in last) == collections.Counter({i: n for (i, _), n in texts.items()})
    for r in last:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id] and r.n_tokens == len(ids[r.doc_id])
    again = p.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in again) == sorted((r.doc_id, r.ids_sha256) for r in last)


def test_edge_rows_pass_every_stage(spark, make_docs):
    good = "the quick thing and the other one went on to see what there was to see in the old town"
    rows_ = [(i, f"{good} number {chr(97 + i % 26)}{chr(97 + i // 26)} {i}", "en", ["a", None, "b"][i % 3]) for i in range(60)]
    rows_ += [(100, None, None, None), (101, "", "en", "a"), (7, rows_[7][1], "en", "b"), (7, rows_[7][1], "en", "b"),
              (None, good + " nameless", "en", "a"), (102, "w " * 20_000, "en", "a"), (103, "## 12 !!", None, "b")]
    docs = make_docs(rows_).withColumn("size", F.lit("clash")).withColumn("language", F.lit(1)).withColumn("ids", F.lit(2))
    for k, (_, stage) in enumerate(p.STAGES):
        made = stage(spark, docs, SF)
        got = made.collect()
        assert len(got) > 0 or k == 4
        if k < 4:
            assert made.columns == docs.columns
            kept = stage(spark, docs.limit(0), SF)
            assert kept.collect() == []
    ids = [r.doc_id for r in p.keep_one_of_each_group(spark, docs, SF).collect()]
    assert ids.count(7) <= 1 and ids.count(None) == 1


@pytest.mark.parametrize("labels", [[], [(i, None) for i in range(20)], [(i, 0) for i in range(20)],
                                    [(i, 1) for i in range(20)], [(900, 0), (901, 1)]])
def test_quality_stage_keeps_all_without_a_model(spark, make_docs, tmp_path, labels):
    """No labels, NULL ones, one class, or labels of other documents only."""
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = make_docs([(i, f"clean text number {i}", "en", "a") for i in range(20)] + [(30, None, None, None)])
    assert sorted(map(str, p.keep_good_quality(spark, docs, str(tmp_path)).collect())) == sorted(map(str, docs.collect()))


def test_language_stage_keeps_all_without_a_language(spark, make_docs):
    docs = make_docs([(i, f"clean text number {i}", None, "a") for i in range(20)] + [(30, None, None, None)])
    assert sorted(map(str, p.keep_known_languages(spark, docs, SF).collect())) == sorted(map(str, docs.collect()))


def test_join_stage_tells_rows_of_one_id_apart(spark, make_docs):
    """Repeated ids: near copies go whatever id they have, other texts of the id stay."""
    words = [f"w{k}" for k in range(60)]
    base, other, third = " ".join(words), " ".join(f"o{k}" for k in range(40)), " ".join(f"m{k}" for k in range(50))
    near, near_third = " ".join(words[:-1] + ["x"]), " ".join(f"m{k}" for k in range(49)) + " y"
    rows_ = [(3, base, "en", "a"), (7, near, "en", "a"), (7, other, "en", "a"), (50, third, "en", "b"),
             (50, near_third, "en", "b"), (50, third.upper(), "de", "c"), (9, other, "en", "a"), (60, "", "en", "a"),
             (60, "", "en", "a"), (60, None, "en", "a"), (None, base, "en", "a"), (61, None, "en", "a")]
    docs = make_docs(rows_).withColumn("class", F.lit(1)).withColumn("component", F.lit(2))
    kept = p.keep_one_of_each_group(spark, docs.repartition(4), SF)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    fifty = [r for r in got if r[0] == 50]
    assert len(fifty) == 1 and fifty[0][1] in (third, third.upper(), near_third)
    assert [r for r in got if r[0] not in (50, 60)] == [(3, base), (7, other), (61, None), (None, base)]
    assert [r[0] for r in got].count(60) == 1
