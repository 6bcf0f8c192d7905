"""Language-model scoring: interpolated modified Kneser-Ney n-grams of a given order (2 by default).

Tokens are lower-cased words plus one end mark a text; a start mark is the first context. Spark
counts the training texts' words and n-grams. The model is kept as sorted hash arrays in the
shared checkpoint folder, one file a shard, which workers memory-map to score texts:

* words: count, continuation probability, and as a context its total and back-off weight;
* n-grams of each length from two to the order: count;
* contexts of two words and more that were seen twice or more: total, and how many of their n-grams have
  count 1, 2, more. A context that was seen once is known from its n-gram.

p(w | h) = max(a(hw) - D, 0) / a(h) + backoff(h) * p(w | h less its first word), where D depends on the
length and on whether the count is 1, 2 or more; a(hw) counts occurrences for the longest n-grams and for
those that begin with the start mark, and distinct words before hw for the others; below the words lies the
uniform distribution over all known words and one unknown. A token near the start of a text has the
words since the start mark as its context.

Scale: tasks sum bigrams before the shuffle and send each shard one packed, sorted block, so the
shuffle holds about 10 bytes a distinct bigram of a task. Shards are dealt by context; contexts so
frequent that they would outgrow a shard (known from the word counts, at most 4 a shard) are spread
over as many shards as they need. Lengths are counted from the longest down: the shards of one length give
the next its distinct n-grams. Files are written under a fixed name by an atomic rename,
so a repeated task leaves the same file. Nothing but a few totals reaches the driver.

Defined cases: NULL and empty texts are one end mark; no training rows -> every token has
probability 1 / (0 + 1), score 0; texts of any length are scored whole; rows that repeat count
and are scored each; rows with a NULL id are scored, never learnt from (see ``common.fold_is``);
other columns pass through.
"""

from __future__ import annotations

import functools
import os
import tempfile
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import release_shuffles, stored
from stratum.llm.hashed_words import arrow_slices, hashed_words, mix, release_memory, slices
from stratum.session import scratch_path

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
TOKENS_A_SHARD = 2_000_000
WORDS_A_SHARD = 1_000_000
ORDER = 2
_FLUSH = 2_000_000          # bigrams a task gathers before it sends them on
_SLICE = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Hot(NamedTuple):
    """Contexts spread over several shards: sorted hashes, and over how many."""
    words: np.ndarray
    spread: np.ndarray


NO_HOT = Hot(np.empty(0, np.uint64), np.empty(0, np.int64))


class Model(NamedTuple):
    folder: str
    word_shards: int
    shards: int
    hot: Hot
    tokens: int             # N
    vocabulary: int         # V
    discounts: tuple[tuple[float, float, float], ...]       # by length, from two
    unknown: float          # continuation probability of an unknown word

    @property
    def order(self) -> int:
        return len(self.discounts) + 1


def bigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, context hash, token hash) of every token, end marks included."""
    sizes, words = hashed_words(texts)
    ends = np.cumsum(sizes)
    token = np.insert(words, ends, END)
    starts = np.concatenate(([0], ends[:-1] + np.arange(1, len(ends)))) if len(ends) else ends
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[starts] = START
    return np.repeat(np.arange(len(texts)), sizes + 1), context, token


def gram(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(context * _STEP + mix(token))


def contexts(context: np.ndarray, token: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(hash of the one, two, ... order - 1 words before each token, tokens since the start mark)."""
    found = [context]
    for _ in range(order - 2):
        longer = np.zeros_like(token)
        longer[1:] = gram(found[-1][:-1], token[:-1])
        found.append(longer)
    starts = np.flatnonzero(context == START)
    place = np.arange(len(token)) - np.repeat(starts, np.diff(np.append(starts, len(token))))
    return found, place


def shard_of(context: np.ndarray, grams: np.ndarray, shards: int, hot: Hot) -> np.ndarray:
    shard = (mix(context) % np.uint64(shards)).astype(np.int64)
    if len(hot.words):
        at = np.minimum(np.searchsorted(hot.words, context), len(hot.words) - 1)
        here = hot.words[at] == context
        shard[here] += (grams[here] % hot.spread[at[here]].astype(np.uint64)).astype(np.int64)
    return shard % shards


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, place of one row of each, sum of n by key)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    total = np.add.reduceat(n[order], first) if len(key) else n
    return key[first], order[first], total


# -- counting -----------------------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    for batch in batches:
        for _, part in arrow_slices(batch.column(0)):
            _, _, token = bigrams(part)
            held += [token, np.full(len(part), START)]
            if sum(map(len, held)) > _FLUSH:
                yield flush()
    if held:
        yield flush()


_PACKED = "level int, shard int, heads binary, below binary, runs binary, tokens binary, counts binary"


def _blocks(level: int, context: list[np.ndarray], token: np.ndarray, n: np.ndarray, shards: int,
            hot: Hot) -> Iterator[dict]:
    """Packed n-grams of one length by shard: its contexts once each (``below`` holds the shorter contexts
    that each ends with), then tokens and counts."""
    grams = gram(context[-1], token)
    _, at, n = _summed(grams, n)
    context, token, grams = [c[at] for c in context], token[at], grams[at]
    shard = shard_of(context[-1], grams, shards, hot if level == 2 else NO_HOT)
    order = np.lexsort((context[-1], shard))
    context, token, n, shard = [c[order] for c in context], token[order], n[order], shard[order]
    for s, a, z in _runs(shard):
        heads, starts = np.unique(context[-1][a:z], return_index=True)
        yield {"level": level, "shard": s, "heads": heads.tobytes(),
               "below": b"".join(c[a:z][starts].tobytes() for c in context[:-1]),
               "runs": np.diff(np.append(starts, z - a)).astype(np.uint32).tobytes(), "tokens": token[a:z].tobytes(),
               "counts": np.minimum(n[a:z], 2 ** 32 - 1).astype(np.uint32).tobytes()}


def _pack(shards: int, hot: Hot, order: int):
    """Each token with the longest context it has, up to the order's."""
    schema = pa.schema([(c, pa.int32() if c in ("level", "shard") else pa.binary())
                        for c in (f.split(" ")[0] for f in _PACKED.split(", "))])

    def send(context: np.ndarray, token: np.ndarray) -> Iterator[pa.RecordBatch]:
        every, place = contexts(context, token, order)
        for level in range(2, order + 1):
            here = np.flatnonzero(place >= level - 2 if level == order else place == level - 2)
            if len(here):
                rows = _blocks(level, [c[here] for c in every[:level - 1]], token[here], np.ones(len(here), np.int64),
                               shards, hot)
                yield from (pa.RecordBatch.from_pylist([r], schema=schema) for r in rows)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, part in arrow_slices(batch.column(0)):
                held.append(bigrams(part)[1:])
                if sum(len(c) for c, _ in held) > _FLUSH:
                    yield from send(*map(np.concatenate, zip(*held)))
                    held.clear()
        if held:
            yield from send(*map(np.concatenate, zip(*held)))

    return pack


def _unpacked(group: pa.Table, level: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(contexts, the shortest first; tokens; counts) of packed n-grams of one length."""
    context: list[list[np.ndarray]] = [[] for _ in range(level - 1)]
    for heads, below, runs in zip(group["heads"], group["below"], group["runs"]):
        times, own = np.frombuffer(runs.as_buffer(), np.uint32), np.frombuffer(heads.as_buffer(), np.uint64)
        shorter = np.frombuffer(below.as_buffer(), np.uint64).reshape(level - 2, len(own))
        for out, c in zip(context, [*shorter, own]):
            out.append(np.repeat(c, times))
    joined = [np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in group[name]] or [np.empty(0, kind)])
              for name, kind in (("tokens", np.uint64), ("counts", np.uint32))]
    return [np.concatenate(c or [np.empty(0, np.uint64)]) for c in context], joined[0], joined[1].astype(np.int64)


def _store_longer(folder: str, level: int, shards: int, hot: Hot):
    """Per shard: n-grams of three words and more and their contexts to files; gives the packed n-grams one
    word shorter, each with its number of distinct words before it, and (level 0) counts of counts."""

    def store(key: tuple, group: pa.Table) -> pa.Table:
        number, levels = key[0].as_py(), group["level"].to_numpy()
        context, token, n = _unpacked(group.filter(pa.array(levels == level)), level)
        grams, at, n = _summed(gram(context[-1], token), n)
        context, token = [c[at] for c in context], token[at]
        _save(folder, f"{_kind(level)}-{number}", {"hash": grams, "count": np.minimum(n, 2 ** 32 - 1).astype(np.uint32)})
        heads, where = np.unique(context[-1], return_inverse=True)
        sums = [np.bincount(where, v, len(heads)).astype(np.int64) for v in (n, n == 1, n == 2, n >= 3)]
        often = sums[0] > 1
        _save(folder, f"context{level}-{number}",
              {"hash": heads[often]} | {c: np.minimum(v[often], 2 ** 32 - 1).astype(np.uint32)
                                        for c, v in zip(("total", "n1", "n2", "n3"), sums)})
        out = list(_blocks(level - 1, context[:-1], token, np.ones(len(token), np.int64), shards, hot))
        none = dict.fromkeys(("heads", "below", "runs", "tokens"), b"")
        out.append(none | {"level": 0, "shard": number,
                           "counts": np.array([(n == k).sum() for k in (1, 2, 3, 4)], np.int64).tobytes()})
        made = pa.Table.from_pylist(out, schema=group.schema)
        return pa.concat_tables([made, group.filter(pa.array(levels < level))])

    return store


def _runs(sorted_key: np.ndarray) -> list[tuple[int, int, int]]:
    if not len(sorted_key):
        return []
    edge = np.flatnonzero(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1], [True])))
    return [(int(sorted_key[a]), int(a), int(z)) for a, z in zip(edge, edge[1:])]


# -- model files --------------------------------------------------------------------------

def _kind(level: int) -> str:
    """Name of the files of n-grams of one length."""
    return "bigram" if level == 2 else f"gram{level}"


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    url = urlparse(folder)
    return (fs.LocalFileSystem(), url.path) if url.scheme in ("", "file") else fs.FileSystem.from_uri(folder)


def _save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write a shard's arrays, each under its final name only when complete."""
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    for kind, x in arrays.items():
        final = f"{path}/{name}-{kind}.npy"
        draft = f"{final}.{os.getpid()}-{os.urandom(6).hex()}"
        with system.open_output_stream(draft) as out:
            np.lib.format.write_array(out, np.ascontiguousarray(x), allow_pickle=False)
        system.move(draft, final)


@functools.lru_cache(maxsize=4096)
def _load(folder: str, name: str) -> np.ndarray:
    """A memory-mapped array. From a store that cannot be mapped, a copy is fetched first."""
    system, path = _place(folder)
    if isinstance(system, fs.LocalFileSystem):
        return np.load(f"{path}/{name}.npy", mmap_mode="r")
    with system.open_input_stream(f"{path}/{name}.npy") as source, tempfile.NamedTemporaryFile() as copy:
        while block := source.read(1 << 22):
            copy.write(block)
        copy.flush()
        return np.load(copy.name, mmap_mode="r")     # the mapping outlives the file's name


def _store_bigrams(folder: str):
    """Per shard: distinct bigrams to a file; returns what words and contexts get from them."""

    def store(key: tuple, group: pa.Table) -> pa.Table:
        (context,), token, n = _unpacked(group, 2)
        grams, at, n = _summed(gram(context, token), n)
        _save(folder, f"{_kind(2)}-{key[0].as_py()}",
              {"hash": grams, "count": np.minimum(n, 2 ** 32 - 1).astype(np.uint32)})
        context, token = context[at], token[at]
        heads, where = np.unique(context, return_inverse=True)
        tails, contexts = np.unique(token, return_counts=True)
        sums = [np.bincount(where, v, len(heads)).astype(np.int64)
                for v in (n, n == 1, n == 2, n >= 3, n == 3, n == 4)]
        none = np.zeros(len(tails), np.int64)
        columns = [np.concatenate([heads, tails]).view(np.int64),
                   np.concatenate([np.zeros(len(heads), np.int64), contexts]),
                   *[np.concatenate([s, none]) for s in sums]]
        return pa.table(dict(zip(_PARTIAL, columns)))

    return store


_PARTIAL = ("key", "contexts", "total", "n1", "n2", "n3plus", "n3", "n4")


def _store_words(folder: str, discounts: tuple[float, float, float], level: tuple[float, float, float],
                 total: int, unknown: float):
    def store(key: tuple, group: pa.Table) -> pa.Table:
        word = group["key"].to_numpy().view(np.uint64)
        order = np.argsort(word)
        col = {c: group[c].to_numpy()[order] for c in ("n", "contexts", "total", "n1", "n2", "n3plus")}
        seen = col["contexts"]
        below = np.array([0.0, *level])[np.minimum(seen, 3)]
        p = np.maximum(seen - below, 0) / max(total, 1) + unknown
        left = discounts[0] * col["n1"] + discounts[1] * col["n2"] + discounts[2] * col["n3plus"]
        _save(folder, f"word-{key[0].as_py()}", {
            "hash": word[order], "count": col["n"], "p": p, "total": col["total"],
            "backoff": left / np.maximum(col["total"], 1)})
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())})

    return store


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts; (0.5, 1, 1.5) where undefined."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(k - (k + 1) * y * b / a, 0.0), float(k))
                 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def train(texts: DataFrame, text_col: str = "text", tokens_a_shard: int = TOKENS_A_SHARD,
          words_a_shard: int = WORDS_A_SHARD, order: int = ORDER) -> Model:
    """Count the texts and write the model of n-grams up to ``order`` words below the session's checkpoint
    folder."""
    if order < 2:
        raise ValueError("the order is at least 2")
    spark = texts.sparkSession
    folder = scratch_path(spark, "kneser-ney")
    texts = texts.select(F.col(text_col).alias("text"))
    start = int(START)
    words = stored(texts.mapInArrow(_count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "words")
    release_shuffles(spark)
    real = F.col("key") != start
    size = words.agg(F.sum(F.when(real, F.col("n"))).alias("tokens"), F.count_if(real).alias("words")).first()
    tokens, vocabulary = size["tokens"] or 0, size["words"]
    shards = max(1, ceil(tokens / tokens_a_shard))
    often = max(1, tokens / (4 * shards))        # at most about 4 hot contexts a shard
    rows = words.where(F.col("n") > often).toPandas() if shards > 1 else pd.DataFrame({"key": [], "n": []})
    key = rows["key"].to_numpy(np.int64).view(np.uint64)
    by_key = np.argsort(key)
    spread = np.minimum(np.ceil(rows["n"].to_numpy(np.float64) / often), shards).astype(np.int64)
    hot = Hot(key[by_key], spread[by_key])

    packed, longer = texts.mapInArrow(_pack(shards, hot, order), _PACKED), []
    for level in range(order, 2, -1):
        packed = stored(packed.groupBy("shard").applyInArrow(_store_longer(folder, level, shards, hot), _PACKED), "grams")
        counts = [np.frombuffer(r["counts"], np.int64) for r in packed.where("level = 0").select("counts").collect()]
        longer.insert(0, discounts(*np.sum(counts or [np.zeros(4, np.int64)], axis=0).tolist()))   # 4 numbers a shard
        packed = packed.where("level > 0")
    parts = stored(packed.groupBy("shard").applyInArrow(
        _store_bigrams(folder), ", ".join(f"{c} long" for c in _PARTIAL)), "sums")
    del packed
    release_shuffles(spark)
    sums = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in _PARTIAL[1:]])
    table = stored(words.join(sums, "key", "left").na.fill(0), "word-table")
    del words, parts, sums
    release_shuffles(spark)
    whole = table.agg(*[F.sum(c).alias(c) for c in ("contexts", "n1", "n2", "n3", "n4")],
                      *[F.count_if(F.col("contexts") == k).alias(f"w{k}") for k in (1, 2, 3, 4)],
                      F.count_if(F.col("contexts") >= 3).alias("w3plus")).first()
    counted = {k: v or 0 for k, v in whole.asDict().items()}
    high = discounts(*[counted[f"n{k}"] for k in (1, 2, 3, 4)])
    low = discounts(*[counted[f"w{k}"] for k in (1, 2, 3, 4)])
    mass = low[0] * counted["w1"] + low[1] * counted["w2"] + low[2] * counted["w3plus"]
    backoff = mass / counted["contexts"] if counted["contexts"] else 1.0
    unknown = backoff / (vocabulary + 1)
    word_shards = max(1, ceil((vocabulary + 1) / words_a_shard))
    (table.withColumn("shard", F.pmod(F.col("key"), F.lit(word_shards)).cast("int"))
     .groupBy("shard").applyInArrow(_store_words(folder, high, low, counted["contexts"], unknown), "shard int")
     .write.format("noop").mode("overwrite").save())
    return Model(folder, word_shards, shards, hot, tokens, vocabulary, (high, *longer), unknown)


# -- scoring ------------------------------------------------------------------------------

def _look_up(folder: str, kind: str, shard: np.ndarray, key: np.ndarray,
             columns: dict[str, float]) -> dict[str, np.ndarray]:
    """Values of sorted distinct keys' columns, each with its default for keys not there."""
    out = {c: np.full(len(key), d) for c, d in columns.items()}
    order = np.argsort(shard, kind="stable")
    for s, a, z in _runs(shard[order]):
        mine = order[a:z]
        there = _load(folder, f"{kind}-{s}-hash")
        if not len(there):
            continue
        at = np.minimum(np.searchsorted(there, key[mine]), len(there) - 1)
        hit = there[at] == key[mine]
        for c in columns:
            out[c][mine[hit]] = _load(folder, f"{kind}-{s}-{c}")[at[hit]]
    return out


def _word_values(model: Model, key: np.ndarray) -> dict[str, np.ndarray]:
    shard = np.mod(key.view(np.int64), model.word_shards)
    return _look_up(model.folder, "word", shard, key,
                    {"count": 0.0, "p": model.unknown, "total": 0.0, "backoff": 1.0})


def _counts(model: Model, level: int, context: np.ndarray, token: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of the n-grams of some places; 0 elsewhere."""
    out = np.zeros(len(token))
    grams, first, where = np.unique(gram(context[at], token[at]), return_index=True, return_inverse=True)
    shard = shard_of(context[at][first], grams, model.shards, model.hot if level == 2 else NO_HOT)
    out[at] = _look_up(model.folder, _kind(level), shard, grams, {"count": 0.0})["count"][where]
    return out


def _context_values(model: Model, level: int, context: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(total, back-off weight) of longer contexts at places where they are known to have been seen; total 0
    elsewhere. Those not in the files were seen once."""
    total, backoff = np.zeros(len(context)), np.ones(len(context))
    keys, where = np.unique(context[at], return_inverse=True)
    shard = shard_of(keys, keys, model.shards, NO_HOT)
    found = _look_up(model.folder, f"context{level}", shard, keys, {"total": 1.0, "n1": 1.0, "n2": 0.0, "n3": 0.0})
    less = model.discounts[level - 2]
    weight = sum(d * found[c] for d, c in zip(less, ("n1", "n2", "n3"))) / found["total"]
    total[at], backoff[at] = found["total"][where], weight[where]
    return total, backoff


def score_texts(model: Model, texts: list[str]) -> pd.DataFrame:
    """n_tokens, n_known, base_score and score of each text."""
    row, context, token = bigrams(texts)
    if model.tokens:
        keys, at = np.unique(np.concatenate([context, token]), return_inverse=True)
        known = _word_values(model, keys)
        of_context, of_token = at[:len(context)], at[len(context):]
        p, c = known["p"][of_token], known["count"][of_token]
        every, place = contexts(context, token, model.order)
        before = np.zeros(len(token))               # count of the n-gram one word shorter, a token ago
        for level, (own, less) in enumerate(zip(every, model.discounts), start=2):
            if level == 2:
                total, backoff = known["total"][of_context], known["backoff"][of_context]
            else:
                total, backoff = _context_values(model, level, own, np.flatnonzero((place >= level - 2) & (before > 0)))
            count = _counts(model, level, own, token, np.flatnonzero(total > 0))
            off = np.array([0.0, *less])[np.minimum(count, 3).astype(int)]
            p = np.where(total > 0, np.maximum(count - off, 0) / np.maximum(total, 1) + backoff * p, p)
            before = np.concatenate([[0.0], count[:-1]])
    else:
        p, c = np.full(len(token), model.unknown), np.zeros(len(token))
    base = np.log10((c + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
    n = len(texts)
    return pd.DataFrame({"n_tokens": np.bincount(row, minlength=n), "n_known": np.bincount(row, c > 0, n).astype(np.int64),
                         "base_score": np.bincount(row, base, n), "score": np.bincount(row, np.log10(p), n)})


def score(text: Column, model: Model) -> Column:
    """text -> struct<n_tokens, n_known, base_score, score>."""

    @F.pandas_udf("n_tokens long, n_known long, base_score double, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [score_texts(model, part) for _, part in slices(texts.tolist(), _SLICE)]
            yield pd.concat(parts, ignore_index=True)
        release_memory()

    return scored(text)
