import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratum.llm import bpe, token_counts
from stratum.llm.registry import op4_bpe, op8_token_counts

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
EDGES = [None, "", "a", " ", " a", "\n", "\n\n  \n" * 300, "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "a " * 20_000,
         "e" * 70_000, " " * 3_000, "é" * 3_000, "中文" * 2_000, "it's 'S don'T 12½ ²x ª", "<|startoftext|>Hi", "İstanbul ΣΑΣ",
         "\x1c a\x85b c\x00", "🙂" * 700, "tab\tand\r\nline", "un believ able" * 900]


def random_texts(n=150):
    rng = random.Random(3)
    parts = [*" \n\t'sStdre ll  aé中🙂12,.!　\xa0ß", " the", " The cat", "<|endoftext|>", "    "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 700))) for _ in range(n)]


@pytest.mark.parametrize("mask_bits", [3, 6, 10])
def test_encoding_equals_the_library_at_any_chunk_size(mask_bits):
    coder, library = bpe.ByteBpe(BYTE, mask_bits=mask_bits), Tokenizer.from_file(BYTE)
    texts = [t or "" for t in EDGES] + random_texts()
    for text, ids in zip(texts, coder.encode_texts(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert coder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


def test_shared_passages_are_cut_alike_and_encoded_once():
    coder = bpe.ByteBpe(BYTE)
    passage = " ".join(f"word{i * 7919 % 1000}" for i in range(3_000))
    coder.encode_texts(["first one. " + passage])
    before = len(coder.cache.new)
    coder.encode_texts(["another, longer start of a text. " + passage + " and an end"])
    assert len(coder.cache.new) - before <= 8          # of about 20 chunks


def test_cache_is_bounded():
    cache = bpe.ChunkCache(100_000)
    for k in range(5_000):
        cache.put(b"%d" % k * 10, np.arange(10, dtype=np.uint32))
    assert cache.used <= 50_000 and len(cache.new) + len(cache.old) < 500
    assert cache.get(b"4999" * 10) is not None and cache.get(b"1" * 10) is None


def test_spark_columns_match_the_library(spark, make_docs):
    df = make_docs([(i, t, None, None) for i, t in enumerate(EDGES)]).withColumn("decoded", F.lit(1))
    library = Tokenizer.from_file(BYTE)
    found = bpe.encode(df, BYTE, decoded="decoded").withColumn("again", bpe.decode(F.col("ids"), BYTE)).collect()
    assert len(found) == len(EDGES)
    for r in found:
        text = EDGES[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert r.decoded == r.again == text and r.text == EDGES[r.doc_id]
    assert bpe.encode(make_docs([]), BYTE).collect() == []


def test_op4_digests(spark, doc_rows):
    library = Tokenizer.from_file(BYTE)
    found = {r.doc_id: r for r in op4_bpe(spark, "/root/testdata/sf0.001").collect()}
    for i, text, _, _ in doc_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_token_counts_match_the_library(spark, make_docs, doc_rows):
    library = Tokenizer.from_file(WORD)
    texts = EDGES + random_texts()
    df = make_docs([(i, t, None, None) for i, t in enumerate(texts)])
    for r in df.select("doc_id", token_counts.count_tokens(F.col("text"), WORD).alias("n")).collect():
        assert r.n == len(library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
    found = {r.doc_id: r for r in op8_token_counts(spark, "/root/testdata/sf0.001").collect()}
    for i, text, _, _ in doc_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len((text or "").encode()), n, n > 2048)
    assert make_docs([]).select(token_counts.count_tokens(F.col("text"), WORD)).collect() == []


def test_whole_tokens_encode_alone():
    library, whole = Tokenizer.from_file(WORD), token_counts.whole_tokens(WORD)
    assert len(whole) > 30_000
    for w in random.Random(1).sample(sorted(whole), 300):
        assert len(library.encode(w, add_special_tokens=False).ids) == 1


def test_texts_beyond_the_plain_range_keep_the_shortcut():
    """Only the stretches around a quote, dash, emoji, accent or special string go to the library."""
    counts, library = token_counts.Counts(WORD, token_counts.whole_tokens(WORD)), Tokenizer.from_file(WORD)
    sent = []

    class Watched:
        def __getattr__(self, name):
            made = getattr(library, name)

            def call(texts, **kw):
                sent.extend([texts] if isinstance(texts, str) else texts)
                return made(texts, **kw)
            return call if name.startswith("encode") else made

    counts.library = Watched()
    odd = ["don’t", "á b", "“the”", "—", "…and", "🙂", "кот", "ΣΑΣ", "İs", "the　cat", "x\x85y", "x<|endoftext|>y", "中文"]
    texts = [f"the cat sat on the mat {w} and the dog was there {w}\tthe end" for w in odd] + [" ".join(odd), "́ a"]
    assert counts.texts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert sent and not any(w in t.split() for t in sent for w in ("cat", "mat", "dog", "end") if "　" not in t)
    sent.clear()
    assert counts.texts(texts[:1] * 5) and sent == []
