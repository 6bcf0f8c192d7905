"""Texts to 64-bit word hashes, a slice of texts at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc


def release_memory() -> None:
    """Hand freed memory back to the system at the end of a task: Spark keeps its Python workers,
    and an idle one should not hold what its last task needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(texts: list[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) of runs of texts with about ``chars`` characters; NULL is empty."""
    start, part, size = 0, [], 0
    for k, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= chars:
            yield start, part
            start, part, size = k + 1, [], 0
    if part:
        yield start, part


def arrow_slices(column: pa.Array, chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """``slices`` of a text column that only ever holds one run as Python texts."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for k, n in enumerate(size.tolist()):
        total += n
        if total >= chars or k == len(size) - 1:
            yield start, [t or "" for t in column.slice(start, k + 1 - start).to_pylist()]
            start, total = k + 1, 0


def distinct(split: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word among the distinct ones, the distinct ones) of lists of words."""
    words = np.empty(sum(map(len, split)), dtype=object)
    words[:] = [w for ws in split for w in ws]
    return pd.factorize(words)


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of words by text, hash of every word); A-Z lower-cased, split at ASCII white space."""
    split = [t.encode().lower().split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    if not sizes.sum():
        return sizes, np.empty(0, np.uint64)
    code, words = distinct(split)
    return sizes, pd.util.hash_array(words, categorize=False)[code]
