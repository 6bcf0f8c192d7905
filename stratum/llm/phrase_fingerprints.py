"""Document fingerprints by locally consistent parsing.

A text is parsed level by level, from code points up to one name for the whole. On each level runs of one
symbol become one symbol; then deterministic coin tossing gives every symbol a label from it and its
left neighbour: twice the place of the lowest bit in which they differ, plus its own bit there.
Neighbours keep different labels, and four tosses leave six labels, so local minima of the labels come
at least every ten symbols and at most every second one. A phrase begins at each of them, and its name, a
hash of its symbols in order, is a symbol of the next level. Where a phrase begins depends on a few
symbols around it only, so equal substrings have the same phrases inside whatever their offset, and
differ from each other at their ends only.

A fingerprint is the name of the whole text and a sketch of the names of its phrases: those of level
``LEVEL`` and up (from level 1 if the text has fewer than ``SHORT`` code points), and the whole. The sketch
keeps the least hash in each of ``BINS`` bins, as 16 bits. Likeness is the share of phrases that two texts
have in common, 2 J / (1 + J), with J, the Jaccard likeness of their sets of names, estimated by the share
of bins that agree (a standard error of 0.045 at most); it is 1 for equal texts.

Scale: fingerprints need no shuffle. To compare each document with the next one, rows are range-
partitioned by (id, hash of the text, place in the scan), so neither an id nor a group of copies has to
fit a task; a task walks its sorted rows with one document held back. Only the last row of each
partition needs a row of another task: these pairs are joined by the number of the partition. Working
memory is some 100 bytes a code point for slices of ``SLICE`` code points, or for one text that is longer.

Defined cases: NULL is the empty text, whose whole is 0 and whose sketch is empty; it is like itself (1)
and nothing else (0). Texts of any length are parsed whole. Rows with a NULL id come last in the order;
rows of one id are ordered by a hash of their texts; repeated rows are each other's next. A table of
one row is its own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import stored
from stratum.llm.hashed_words import arrow_slices, mix, release_memory

LEVEL = 2
SHORT = 64
BINS = 128
SLICE = 1 << 19
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BIN_SHIFT = np.uint64(64 - (BINS - 1).bit_length())


# -- parsing -------------------------------------------------------------------------------------

def toss(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Label of each symbol against its left neighbour; the first of a text against itself with the
    lowest bit turned."""
    differ = np.empty_like(symbols)
    differ[1:] = symbols[1:] ^ symbols[:-1]
    differ[starts] = 1
    lowest = differ & (~differ + differ.dtype.type(1))
    label = np.bitwise_count(lowest - differ.dtype.type(1))
    label <<= np.uint8(1)
    label |= (symbols & lowest) != 0
    return label


def cuts(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where phrases begin, in texts whose neighbouring symbols differ: at every local minimum of the
    labels inside a text, and at its start."""
    label = toss(symbols, starts)
    for _ in range(3):
        label = toss(label, starts)
    cut = np.zeros(len(symbols), bool)
    falls = label[1:] < label[:-1]
    cut[1:-1] = falls[:-1] & ~falls[1:]
    cut[ends - 1] = False
    cut[starts] = True
    return np.flatnonzero(cut)


def without_runs(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol as one symbol of their own; (symbols, bounds of the texts)."""
    first = np.empty(len(symbols), bool)
    np.not_equal(symbols[1:], symbols[:-1], out=first[1:])
    first[bounds[:-1]] = True
    at = np.flatnonzero(first)
    if len(at) == len(symbols):
        return symbols, bounds
    length = np.diff(at, append=len(symbols))
    out = symbols[at]
    run = np.flatnonzero(length > 1)
    out[run] = mix(out[run] * _MULTIPLIER + length[run].astype(np.uint64))
    return out, np.searchsorted(at, bounds)


def next_level(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each text, and the texts' new bounds. No text may be empty."""
    symbols, bounds = without_runs(symbols, bounds)
    at = cuts(symbols, bounds[:-1], bounds[1:])
    size = np.diff(at, append=len(symbols))
    name = mix(symbols[at])
    left = np.flatnonzero(size > 1)
    step = 1
    while len(left):
        own = (name[left] ^ symbols[at[left] + step]) * _MULTIPLIER
        name[left] = own ^ (own >> np.uint64(31))
        step += 1
        left = left[size[left] > step]
    return name, np.searchsorted(at, bounds)


def parse(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(level, names, number of the text of each name) of level 0, the code points, and up; a text leaves
    with the level on which one name is left of it."""
    symbols = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    text = np.flatnonzero(size)
    bounds = np.concatenate([[0], np.cumsum(size[text])])
    level = 0
    while len(text):
        size = np.diff(bounds)
        number = np.repeat(text, size)
        yield level, symbols, number
        go_on = size > 1
        if not go_on.all():
            symbols, text = symbols[np.repeat(go_on, size)], text[go_on]
            bounds = np.concatenate([[0], np.cumsum(size[go_on])])
        if len(text):
            symbols, bounds = next_level(symbols, bounds)
        level += 1


def fingerprint(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(name of the whole text, sketch of its phrases: 16 bits a bin, 0 for an empty one)."""
    whole, least = np.zeros(len(texts), np.uint64), np.full(len(texts) * BINS, np.iinfo(np.uint64).max)
    short = np.fromiter((len(t) < SHORT for t in texts), bool, len(texts))
    for level, names, text in parse(texts):
        last = np.ones(len(text), bool)
        last[1:] = text[1:] != text[:-1]
        last[:-1] &= text[:-1] != text[1:]
        alone = np.flatnonzero(last)                    # the only name left of its text
        whole[text[alone]] = mix(names[alone] + np.uint64(level + 1))
        kept = slice(None) if level >= LEVEL else np.flatnonzero(last | short[text] if level else last)
        hashed = mix(names[kept] + np.uint64(level + 1))
        at = text[kept] * BINS + (hashed >> _BIN_SHIFT).astype(np.int64)
        np.minimum.at(least, at, hashed)
    sketch = (least % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    sketch[least == np.iinfo(np.uint64).max] = 0
    return whole, sketch.reshape(-1, BINS)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Share of phrases in common, text by text."""
    filled = ((a[1] | b[1]) != 0).sum(axis=1)
    agree = ((a[1] == b[1]) & (a[1] != 0)).sum(axis=1)
    j = agree / np.maximum(filled, 1)
    return np.where((a[0] == b[0]) & (a[1] == b[1]).all(axis=1), 1.0, 2 * j / (1 + j))


def packed(prints: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """Each fingerprint as bytes: the whole, then the sketch, big-endian."""
    whole, sketch = prints[0].astype(">u8").tobytes(), prints[1].astype(">u2").tobytes()
    return [whole[8 * k:8 * k + 8] + sketch[2 * BINS * k:2 * BINS * (k + 1)] for k in range(len(prints[0]))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint binary) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in arrow_slices(batch.column("text"), SLICE):
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(start, len(texts)),
                                                  pa.array(packed(fingerprint(texts)), pa.binary())], names=["id", "fingerprint"])
        release_memory()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint binary")


# -- each document and the next one --------------------------------------------------------------

def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of another one."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


_FIELDS = pa.schema([("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
                     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_FOUND = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(texts: list[str], following: list[str] | None = None) -> list[pa.Array]:
    """Columns of ``_FIELDS`` for texts against their following ones: those given, or else each text but
    the last against the one after it."""
    n = len(texts) if following else len(texts) - 1
    after = following or texts[1:]
    changed = [edited(t, f) for t, f in zip(texts, after)]
    whole, sketch = fingerprint(texts + changed + (following or []))
    part = lambda a, z: (whole[a:z], sketch[a:z])
    own, new = part(0, n), part(len(texts), len(texts) + n)
    nxt = part(len(texts) + n, None) if following else part(1, n + 1)
    columns = [[len(t) for t in texts[:n]], [hashlib.sha256(c.encode()).hexdigest() for c in changed],
               packed(own), packed(new), likeness(own, new), likeness(own, nxt)]
    return [pa.array(c, type=f.type) for c, f in zip(columns, _FIELDS)]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition: every row but the last with the one after it (edge 0); then the first
    (edge 1) and the last row (edge 2) with their texts."""
    number, held, first = TaskContext.get().partitionId(), None, None
    none = lambda n, f: pa.nulls(n, f)

    def edge(kind: int, row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([kind], pa.int32()), pa.array([number], pa.int32()), row[0], pa.array([row[1]], pa.string()),
             *[none(1, f.type) for f in _FIELDS]], names=["edge", "part", "id", "text", *_FIELDS.names])

    for batch in batches:
        for start, texts in arrow_slices(batch.column("text"), SLICE):
            ids = batch.column("id").slice(start, len(texts))
            if held is None:
                first = (ids.slice(0, 1), texts[0])
            else:
                ids, texts = pa.concat_arrays([held[0], ids]), [held[1], *texts]
            held = (ids.slice(len(texts) - 1, 1), texts[-1])
            if (n := len(texts) - 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, number, np.int32)), ids.slice(0, n),
                     none(n, pa.string()), *_compared(texts)], names=["edge", "part", "id", "text", *_FIELDS.names])
    if held is not None:
        yield edge(1, first)
        yield edge(2, held)
    release_memory()


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, following) rows compared one by one: such texts are few."""
    for batch in batches:
        for k in range(batch.num_rows):
            text, following = (batch.column(c)[k].as_py() or "" for c in ("text", "following"))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(k, 1), *_compared([text], [following])],
                                             names=["id", *_FIELDS.names])
    release_memory()


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text, and the likeness of both, and of it and the
    next document (by ascending id; after the last comes the first)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    order: list[Column] = [F.col("id").asc_nulls_last(), F.xxhash64("text").asc(), F.col("__place").asc()]
    kind = rows.schema["id"].dataType.simpleString()
    walked = (rows.withColumn("__place", F.monotonically_increasing_id())
              .repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
              .mapInArrow(_walk, f"edge int, part int, id {kind}, text string, {_FOUND}"))
    found = stored(walked, "fingerprints")
    firsts = found.where("edge = 1").select("part", F.col("text").alias("following"))
    # one row a partition: the number of the next one that has rows, after the last the first
    by_part = Window.orderBy("part")
    after = F.coalesce(F.lead("part").over(by_part),
                       F.first("part").over(by_part.rowsBetween(Window.unboundedPreceding, 0)))
    chain = firsts.select("part").select("part", after.alias("after"))
    lasts = (found.where("edge = 2").select("part", "id", "text").join(chain, "part")
             .join(firsts.withColumnRenamed("part", "after"), "after").select("id", "text", "following")
             .mapInArrow(_beside, f"id {kind}, {_FOUND}"))
    return found.where("edge = 0").select(*lasts.columns).unionByName(lasts)
