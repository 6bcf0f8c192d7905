"""Token counts with the whole-token shortcut.

For a word BPE (lower-casing, white space dropped, ``</w>`` word ends): the vocabulary strings
that encode alone as exactly one token are proved beforehand by encoding each one. A pre-token
among them counts 1 without any merging; only the rest is merged by the library, each distinct
one once per worker (bounded cache).

Texts are split here by the file's own pattern as far as they lie within ``plain.RANGE``. Of any
other text, the stretches between ASCII white space that hold a character beyond it, or a special
string, are counted by the library, each distinct one once per worker (same cache); the rest of the
text is split here. No normalisation, special string or pre-token runs over ASCII white space.

Defined cases: NULL counts as the empty text (0 tokens); texts of any length are counted whole;
rows that repeat are each counted; an empty table gives an empty result; other columns pass.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.llm import hashed_words, plain
from stratum.llm.bpe import byte_alphabet
from stratum.llm.hashed_words import release_memory, slices

CACHE_WORDS = 250_000
WORDS_A_CALL = 500
CACHED_STRETCH = 64         # characters of a stretch beyond plain.RANGE that is kept at most
_stretches = re.compile(r"[^ \t\n\r]+").findall


@functools.lru_cache(maxsize=2)
def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def split_pattern(path: str) -> str:
    """The regular expression by which the file splits normalised text into pre-tokens."""
    with open(path, encoding="utf-8") as f:
        steps = json.load(f)["pre_tokenizer"]["pretokenizers"]
    return next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")


def whole_tokens(path: str) -> frozenset[str]:
    """Texts of the vocabulary strings that encode alone as exactly that one token."""
    library, to_byte = _library(path), byte_alphabet()
    end = library.model.end_of_word_suffix or ""
    texts, ids = [], []
    for s, i in library.get_vocab(with_added_tokens=False).items():
        if not s.endswith(end) or len(s) == len(end):
            continue
        try:
            texts.append(bytes(to_byte[c] for c in s.removesuffix(end)).decode())
            ids.append(i)
        except UnicodeDecodeError:      # part of a character: never a pre-token
            continue
    made = library.encode_batch_fast(texts, add_special_tokens=False)
    return frozenset(t for t, i, e in zip(texts, ids, made) if e.ids == [i])


class Counts:
    """Counts a worker's texts."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.library, self.whole = _library(path), dict.fromkeys(whole, 1)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.find = re.compile(plain.spelled_out(split_pattern(path))).findall
        self.tokens = dict(self.whole)      # whole tokens first, then what had to be merged
        vocab = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for s, i in vocab.items() if s.endswith(self.library.model.end_of_word_suffix or "")]] = True

    def _merge(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token, many to a call of the library.

        White space separates pre-tokens and is dropped, so a run of them splits into the same
        ones; each ends with its only token that ends a word.
        """
        out: list[int] = []
        for k in range(0, len(words), WORDS_A_CALL):
            part = words[k:k + WORDS_A_CALL]
            ids = np.array(self.library.encode(" ".join(part), add_special_tokens=False).ids, np.int64)
            ends = np.flatnonzero(self.ends_word[ids])
            if len(ends) != len(part):
                raise AssertionError("the words do not split as they did in their texts")
            out += np.diff(ends, prepend=-1).tolist()
        return out

    def _divide(self, text: str) -> tuple[str, list[str]]:
        """(what of the text lies within RANGE, its other stretches between ASCII white space)."""
        special = any(s in text for s in self.special)
        if not special and plain.is_plain(text):
            return text, []
        usual, other = [], []
        for w in _stretches(text):
            (usual if plain.is_plain(w) and not (special and any(s in w for s in self.special)) else other).append(w)
        return " ".join(usual), other

    def _count_others(self, others: list[list[str]]) -> list[int]:
        """Tokens of each text's stretches beyond RANGE."""
        found = {w: self.tokens.get(w) for ws in others for w in ws}
        unknown = [w for w, n in found.items() if n is None]
        for k in range(0, len(unknown), WORDS_A_CALL):
            part = unknown[k:k + WORDS_A_CALL]
            for w, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False)):
                found[w] = len(e.ids)
        self.tokens.update((w, found[w]) for w in unknown if len(w) <= CACHED_STRETCH)
        return [sum(map(found.__getitem__, ws)) for ws in others]

    def texts(self, texts: list[str]) -> list[int]:
        divided = [self._divide(t) for t in texts]
        total = self._count_others([other for _, other in divided])
        split = [self.find(usual.lower()) for usual, _ in divided]
        del divided
        code, words = hashed_words.distinct(split)
        found = list(map(self.tokens.get, words))
        unknown = [k for k, n in enumerate(found) if n is None]
        for k, n in zip(unknown, self._merge([words[k] for k in unknown])):
            found[k] = self.tokens[words[k]] = n
        if len(self.tokens) > CACHE_WORDS:      # those in use now hold all the frequent ones
            self.tokens = self.whole | dict(zip(words, found))
        each = np.array(found, np.int64)[code] if found else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(each)))[np.cumsum([0, *map(len, split)])]
        return (np.diff(ends) + total).tolist()


def count_tokens(text: Column, path: str) -> Column:
    """text -> number of tokens (long), without special tokens added."""
    whole = SparkContext.getOrCreate().broadcast(whole_tokens(path))     # at most the vocabulary

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = Counts(path, whole.value)
        for texts in batches:
            yield pd.Series([n for _, part in slices(texts.tolist()) for n in counts.texts(part)], dtype="int64")
        del counts
        release_memory()

    return count(text)
