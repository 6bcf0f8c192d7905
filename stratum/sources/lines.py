"""Landed JSON lines on their way into a table: dealt as compressed blocks, plain records parsed in batches.

A line names its fields, so a shuffle of lines is some three times as large as the landed files. A map task
gathers its lines by unit and date, and each group is compressed as a block of text; blocks are what is
shuffled. A line reaches the other side as it was, byte by byte.

After that a *plain* line (an object of known keys, each once, whose values are texts or null) is read by Arrow's
JSON reader. Every other line, whatever it holds, is read by :func:`stratum.sources.raw.parse_records`, whose
rows those of plain lines equal.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.json as pj
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sources.raw import EXTRA_COL, parse_records

GATHERED_BYTES = 32 * 1024 ** 2     # text that a map task holds before it is cut into blocks
OPENED_BYTES = 8 * 1024 ** 2        # text that is parsed at once
PLAIN_BYTES = 1024 ** 2             # a longer line is not plain
BUCKETS = 200                       # the dates of a unit go to so many groups, which adaptive execution splits
# Of blocks: some 500,000 lines, whose rows a task sorts in memory. Blocks are a third of what lines take in a shuffle.
SHUFFLED_BYTES_A_TASK = 24 * 1024 ** 2
CODEC = "zstd"

_CHAR = r'[^"\\\x00-\x1f]'
# an escape, but for those of half a code point
_ESCAPE = r'\\(?:["\\/bfnrt]|u(?:[0-9a-ce-fA-CE-F][0-9a-fA-F]{3}|[dD][0-7][0-9a-fA-F]{2}))'
_BLOCK = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("bytes", T.LongType()),
                       T.StructField("block", T.BinaryType())])


def plain_pattern(columns) -> str:
    """What a plain line matches (RE2)."""
    pair = rf'"(?:{"|".join(map(re.escape, columns))})":(?:"(?:{_CHAR}|{_ESCAPE})*"|null)'
    return rf"^\{{(?:{pair}(?:,{pair})*)?\}}$"


def _gather(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        parts = max(1, -(-batch.nbytes // most))
        rows = max(1, -(-batch.num_rows // parts))
        for k in range(0, batch.num_rows, rows):
            held.append(batch.slice(k, rows))
            size += held[-1].get_total_buffer_size() if parts == 1 else most
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _array(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _blocks(date_col: str, buckets: int, most: int):
    """(unit, line) -> (unit, bucket, bytes, block): the lines of a unit and bucket, joined and compressed."""
    found = rf'"{re.escape(date_col)}"\s*:\s*"(?P<date>[^"]{{10}})'

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gather(batches, most):
            unit, line = _array(table.column(0)).dictionary_encode(), _array(table.column(1))
            # where a line's date is not found here its row is right all the same, in a file of its own
            date = pc.fill_null(pc.struct_field(pc.extract_regex(line, found), [0]), "").dictionary_encode()
            hashed = np.array([zlib.crc32(d) % buckets for d in date.dictionary.cast(pa.binary()).to_pylist()])
            group = unit.indices.to_numpy().astype(np.int64) * buckets + hashed[date.indices.to_numpy()]
            order = np.lexsort((date.indices.to_numpy(), group))
            group = group[order]
            start = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)])).astype(np.int32)
            texts = pc.binary_join(pa.ListArray.from_arrays(start, line.take(pa.array(order))), "\n").cast(pa.binary())
            first = group[start[:-1]]
            yield pa.RecordBatch.from_arrays([
                unit.dictionary.take(pa.array(first // buckets)), pa.array(first % buckets, pa.int32()),
                pc.binary_length(texts).cast(pa.int64()),
                pa.array([pa.compress(t.as_buffer(), CODEC, asbytes=True) for t in texts], pa.binary())],
                names=["unit", "bucket", "bytes", "block"])

    return blocks


def _parsed(lines: pa.Array, schema: pa.Schema) -> pa.Table | None:
    """The records of plain lines; none if Arrow does not find one record a line."""
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")[0].as_buffer()
    try:
        table = pj.read_json(pa.BufferReader(text), pj.ReadOptions(use_threads=False, block_size=len(text) + 1),
                             pj.ParseOptions(explicit_schema=schema, unexpected_field_behavior="error"))
    except pa.ArrowInvalid:
        return None
    return table.select(schema.names) if table.num_rows == len(lines) else None


def _records(lines: pa.Array, plain: np.ndarray, schema: pa.Schema) -> tuple[np.ndarray, list[pa.Array]]:
    """(which lines were read, their columns): of all lines, null where one was not."""
    if not plain.any():
        return plain, [pa.nulls(len(lines), pa.string())] * len(schema)
    whole = bool(plain.all())
    table = _parsed(lines if whole else lines.filter(pa.array(plain)), schema)
    if table is not None:
        columns = [_array(c) for c in table.columns]
        if not whole:
            place = pa.array(np.cumsum(plain) - 1, mask=~plain)
            columns = [c.take(place) for c in columns]
        return plain, columns
    if len(lines) == 1:                 # a key that comes twice
        return np.array([False]), [pa.nulls(1, pa.string())] * len(schema)
    half = len(lines) // 2
    (a, left), (b, right) = _records(lines[:half], plain[:half], schema), _records(lines[half:], plain[half:], schema)
    return np.concatenate((a, b)), [pa.concat_arrays(pair) for pair in zip(left, right)]


def _opened(columns, most: int):
    """(unit, bytes, block) -> (unit, line, *columns): the line itself is kept only if it is not plain."""
    pattern, schema = plain_pattern(columns), pa.schema([(c, pa.string()) for c in columns])
    names = ["unit", "value", *[f"c{k}" for k in range(len(columns))]]

    def read(units: list[pa.Array], texts: list[pa.Array]) -> pa.RecordBatch:
        lines = pa.concat_arrays(texts)
        plain = pc.and_(pc.match_substring_regex(lines, pattern), pc.less_equal(pc.binary_length(lines), PLAIN_BYTES))
        try:
            lines.validate(full=True)
        except pa.ArrowInvalid:         # not UTF-8
            plain = pa.array([False] * len(lines))
        done, read = _records(lines, plain.to_numpy(zero_copy_only=False), schema)
        odd = pc.if_else(pa.array(done), pa.scalar(None, pa.string()), lines)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(units), odd, *read], names=names)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, texts, size = [], [], 0
        for batch in batches:
            for unit, length, block in zip(*(batch.column(k) for k in range(3))):
                text = pa.decompress(block.as_buffer(), length.as_py(), CODEC)
                whole = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(text)], np.int32)), text])
                texts.append(pc.split_pattern(whole, "\n").flatten())
                units.append(pa.repeat(unit, len(texts[-1])))
                size += len(text)
                if size >= most:
                    yield read(units, texts)
                    units, texts, size = [], [], 0
        if units:
            yield read(units, texts)

    return opened


def dealt_records(lines: DataFrame, unit_col: str, columns, date_col: str, extra_col: str = EXTRA_COL) -> DataFrame:
    """Lines (``unit_col``, ``value``) as rows of :func:`parse_records`, those of a unit and date together."""
    unit = lines.schema[unit_col]
    blocks = (lines.select(F.col(unit_col).alias("unit"), "value")
              .mapInArrow(_blocks(date_col, BUCKETS, GATHERED_BYTES),
                          T.StructType([T.StructField("unit", unit.dataType), *_BLOCK]))
              .hint("rebalance", "unit", "bucket").select("unit", "bytes", "block"))
    parts = [f"c{k}" for k in range(len(columns))]
    opened = blocks.mapInArrow(_opened(list(columns), OPENED_BYTES), T.StructType(
        [T.StructField("unit", unit.dataType), *[T.StructField(n, T.StringType()) for n in ("value", *parts)]]))
    # of a plain line the text is NULL, which parses to NULL everywhere
    mark, unit_name, own = "__plain", "__unit", {n: f"__{n}" for n in parts}
    odd = parse_records(opened.select(F.col("unit").alias(unit_name), F.col("value").isNull().alias(mark), "value",
                                      *[F.col(n).alias(own[n]) for n in parts]), columns, extra_col)
    return odd.select(F.col(unit_name).alias(unit_col),
                      *[F.coalesce(F.col(f"`{c}`"), own[n]).alias(c) for c, n in zip(columns, parts)],
                      F.when(F.col(mark), _no_keys()).otherwise(F.col(extra_col)).alias(extra_col))


def _no_keys() -> Column:
    text = F.array().cast("array<string>")
    return F.map_from_arrays(text, text)
