"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A text is cut into chunks where a rolling hash of its last 8 bytes meets a mask, so passages that
documents share fall into the same chunks wherever they stand. A worker encodes each distinct
chunk once a task and keeps its ids in a bounded cache. A cut may split a word, so each joint is then
repaired: the stretch around it is encoded anew, widened to the nearest points on either side
where any encoding has a token boundary (a space before an ASCII letter and after a printable
ASCII character: no pre-token runs over such a point, whatever stands around it). Left and right
of the stretch both encodings agree, so the ids equal those of the whole text.

A chunk's pre-tokens are looked up in a second bounded cache and only unknown ones are merged by
the library; chunks with characters outside ``plain.RANGE`` are encoded by the library as a whole.

Special strings of the tokenizer inside a text become their ids, as in the library.

Defined cases: NULL is encoded as the empty text (no ids); texts of any length are encoded whole,
with working memory for a slice of texts and the cache bound; rows that repeat are each encoded
(from the cache); an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm import hashed_words, plain
from stratum.llm.hashed_words import arrow_slices, release_memory

MASK_BITS = 10              # a cut every 1024 bytes on average
MIN_CHUNK = 64
MAX_CHUNK = 1 << 16
CACHE_BYTES = 8 << 20      # of a worker's chunk cache, texts and ids
CACHE_WORDS = 150_000       # of a worker's pre-token cache
LINES_A_CALL = 500
SLICE_BYTES = 1 << 19       # texts encoded together
# fixed value: the pre-token pattern that byte-level BPE files name as use_regex
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the
    others, in order, for the code points from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ChunkCache:
    """Chunk bytes -> ids, bounded in bytes: the older half goes when the newer half is full."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.used, self.new, self.old = limit // 2, 0, {}, {}

    def get(self, key: bytes):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: bytes, ids: np.ndarray) -> None:
        self.used += len(key) + ids.nbytes + 200
        if self.used > self.limit:
            self.old, self.new, self.used = self.new, {}, len(key) + ids.nbytes + 200
        self.new[key] = ids


class ByteBpe:
    """Encoder and decoder of one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, mask_bits: int = MASK_BITS, cache_bytes: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        to_byte = byte_alphabet()
        vocab = self.library.get_vocab(with_added_tokens=False)
        self.bytes_of: dict[int, bytes] = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()}
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        every = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.length = np.fromiter(map(len, every), np.int64, len(every))
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(every), np.uint8)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.shift = np.uint64(64 - mask_bits)
        self.cache = ChunkCache(cache_bytes)
        self.words: dict[str, bytes] = {}
        self.find = re.compile(plain.spelled_out(PATTERN)).findall

    # -- chunks ---------------------------------------------------------------------------
    def cuts(self, data: bytes) -> list[int]:
        """Inner cut places of a text, by content, at character starts."""
        n = len(data)
        if n <= MIN_CHUNK:
            return []
        view = np.frombuffer(data, np.uint8)
        window = np.lib.stride_tricks.sliding_window_view(view, 8).copy().view("<u8")[:, 0]
        wanted = np.flatnonzero((window * _MULTIPLIER) >> self.shift == 0) + 8
        found, last = [], 0
        for at in [*wanted.tolist(), n]:
            while at - last > MAX_CHUNK:
                last = self._char_start(data, last + MAX_CHUNK)
                found.append(last)
            at = self._char_start(data, at)
            if at - last >= MIN_CHUNK and at < n:
                found.append(at)
                last = at
        return found

    @staticmethod
    def _char_start(data: bytes, at: int) -> int:
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        return at

    @staticmethod
    def _stretches(data: bytes, cuts: list[int]) -> list[tuple[int, int]]:
        """The stretches around the cuts that must be encoded anew; none where a cut is safe."""
        view = np.frombuffer(data, np.uint8)
        lower = view[2:] | 0x20
        safe = np.flatnonzero((view[1:-1] == 0x20) & (lower >= 97) & (lower <= 122)
                              & (view[:-2] > 0x20) & (view[:-2] < 0x7F)) + 1
        places = np.asarray(cuts)
        left, right = np.searchsorted(safe, places, "right") - 1, np.searchsorted(safe, places)
        out: list[tuple[int, int]] = []
        for c, i, j in zip(cuts, left.tolist(), right.tolist()):
            a, z = int(safe[i]) if i >= 0 else 0, int(safe[j]) if j < len(safe) else len(data)
            if a == c == z:
                continue
            if out and a < out[-1][1]:
                out[-1] = (out[-1][0], max(z, out[-1][1]))
            else:
                out.append((a, z))
        return out

    def _plan(self, data: bytes) -> list[tuple[bytes, int, int]]:
        """Pieces to encode, each with the part of it (from, to) whose ids are used, in order."""
        if not data:
            return []
        cuts = self.cuts(data)
        if not cuts:
            return [(data, 0, len(data))]
        ends = [*cuts, len(data)]
        redo = self._stretches(data, cuts)
        plan, start, k = [], 0, 0
        for end in ends:
            a = start
            while k < len(redo) and redo[k][0] < end:
                p, q = redo[k]
                if p > a:
                    plan.append((data[start:end], a - start, p - start))
                if p >= start:
                    plan.append((data[p:q], 0, q - p))
                a = max(a, q)
                if q > end:
                    break
                k += 1
            if a < end:
                plan.append((data[start:end], a - start, end - start))
            start = end
        return plan

    # -- encoding -------------------------------------------------------------------------
    def _library_ids(self, texts: list[str]) -> list[bytes]:
        made = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens that hold no line feed, many to a call of the library.

        A line feed before a pre-token is a pre-token of its own and leaves what follows as it
        is, so the words are encoded one to a line and told apart by the tokens' lengths.
        """
        out: list[bytes] = []
        for k in range(0, len(words), LINES_A_CALL):
            part = words[k:k + LINES_A_CALL]
            ids = np.array(self.library.encode("\n" + "\n".join(part), add_special_tokens=False).ids, "<u4")
            ends = np.cumsum(self.length[ids])
            stop = np.cumsum([len(w.encode()) + 1 for w in part])
            start = np.concatenate(([0], stop[:-1])) + 1
            i, j = np.searchsorted(ends, start), np.searchsorted(ends, stop)
            if not (np.array_equal(ends[i], start) and np.array_equal(ends[j], stop)):
                raise AssertionError("a pre-token runs over a line feed")
            out += [ids[a:z].tobytes() for a, z in zip((i + 1).tolist(), (j + 1).tolist())]
        return out

    def _encode(self, pieces: set[bytes]) -> dict[bytes, np.ndarray]:
        known = {p: ids for p in pieces if (ids := self.cache.get(p)) is not None}
        missing = [(p, p.decode()) for p in pieces if p not in known]
        plain_ones = [(p, t) for p, t in missing if plain.is_plain(t)]
        rest = [(p, t) for p, t in missing if not plain.is_plain(t)]
        made = list(zip([p for p, _ in plain_ones], self._by_words([t for _, t in plain_ones])))
        made += [(p, np.frombuffer(ids, "<u4")) for (p, _), ids in
                 zip(rest, self._library_ids([t for _, t in rest]))]
        for p, ids in made:
            known[p] = ids
            self.cache.put(p, ids)
        return known

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts from those of their pre-tokens."""
        split = [self.find(t) for t in texts]
        code, words = hashed_words.distinct(split)
        ids_of = list(map(self.words.get, words))
        unknown = [k for k, ids in enumerate(ids_of) if ids is None]
        for encode, kind in ((self._word_ids, [k for k in unknown if not words[k].isspace()]),
                             (self._library_ids, [k for k in unknown if words[k].isspace()])):
            for k, ids in zip(kind, encode([words[k] for k in kind])):
                ids_of[k] = self.words[words[k]] = ids
        if len(self.words) > CACHE_WORDS:       # those in use now hold all the frequent ones
            self.words = dict(zip(words, ids_of))
        table, size = np.frombuffer(b"".join(ids_of), "<u4"), np.fromiter(map(len, ids_of), np.int64, len(ids_of)) >> 2
        start = np.cumsum(size) - size
        here = size[code]
        ends = np.concatenate(([0], np.cumsum(here)))
        ids = table[np.arange(ends[-1]) + np.repeat(start[code] - ends[:-1], here)]
        edge = ends[np.cumsum([len(s) for s in split])] if split else ends[:0]
        return [x.copy() for x in np.split(ids, edge[:-1])] if split else []

    def _used(self, ids: np.ndarray, a: int, z: int, whole: int) -> np.ndarray:
        """The ids of bytes a to z of a piece; both must be token boundaries."""
        if a == 0 and z == whole:
            return ids
        ends = np.concatenate(([0], np.cumsum(self.length[ids])))
        i, j = np.searchsorted(ends, [a, z])
        if ends[i] != a or ends[j] != z:
            raise AssertionError("a joint does not agree with its neighbours")
        return ids[i:j]

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        plans: list[list] = []
        pieces: set[bytes] = set()
        for text in texts:
            parts = [text] if not self.split_special or not any(s in text for s in self.special) \
                else self.split_special.split(text)
            plan: list = []
            for k, part in enumerate(parts):
                if k % 2:
                    plan.append(self.special[part])
                else:
                    made = self._plan(part.encode())
                    plan += made
                    pieces.update(p for p, _, _ in made)
            plans.append(plan)
        ids = self._encode(pieces)
        empty = np.empty(0, np.uint32)
        return [np.concatenate([np.array([x], np.uint32) if isinstance(x, int)
                                else self._used(ids[x[0]], x[1], x[2], len(x[0])) for x in plan] or [empty])
                for plan in plans]

    def forget(self) -> None:
        """Empty the caches."""
        self.words, self.cache = {}, ChunkCache(2 * self.cache.limit)

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        size = self.length[ids]
        ends = np.cumsum(size)
        places = np.arange(ends[-1]) + np.repeat(self.start[ids] - (ends - size), size)
        return self.flat[places].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    """One encoder a worker and file, with its cache."""
    return ByteBpe(path)


def encode(df: DataFrame, path: str, text_col: str = "text", ids: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """``df`` with ``ids``, the token ids as little-endian unsigned 32-bit integers, and, if named,
    ``decoded``, their text. Columns of these names are replaced."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in batches:
            for start, part in arrow_slices(batch.column(batch.num_columns - 1), SLICE_BYTES):
                made = coder.encode_texts(part)
                kept = batch.slice(start, len(part))
                columns = [kept.column(k) for k in range(batch.num_columns - 1)]
                columns.append(pa.array([x.astype("<u4").tobytes() for x in made], pa.binary()))
                if decoded:
                    columns.append(pa.array([coder.decode(x) for x in made], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        coder.forget()
        release_memory()

    rest = df.drop(ids, *([decoded] if decoded else []))
    names = [*rest.columns, ids, *([decoded] if decoded else [])]
    schema = T.StructType([*rest.schema.fields, T.StructField(ids, T.BinaryType()),
                           *([T.StructField(decoded, T.StringType())] if decoded else [])])
    texts = df.select(*[rest[f"`{c}`"] for c in rest.columns], df[f"`{text_col}`"].alias("__bpe_text"))
    return texts.mapInArrow(work, schema)


def decode(ids: Column, path: str) -> Column:
    """ids as little-endian unsigned 32-bit integers -> text (NULL: the empty text)."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for blobs in batches:
            yield pd.Series([tokenizer(path).decode(np.frombuffer(b or b"", "<u4")) for b in blobs], dtype=object)

    return text(ids)
