"""Exact n-gram Jaccard join by universe partition and pigeonhole.

A document's set holds the 64-bit hashes of its distinct word shingles. Documents with equal sets
form a class, and classes are what is joined.

Candidates. Sizes are cut into bands so that the sizes of a linked pair lie in one band or in
neighbours. In each band the universe of shingles is dealt by hash into segments. Two
sets of sizes s <= l with Jaccard similarity at least t differ in at most
H = l + s - 2 * ceil(t / (1 + t) * (l + s)) shingles, so among any H + 1 segments at least one is
equal in both sets. Each set indexes its non-empty segments in its own band and probes its own band
and the one below. In small bands, where such segments would be too few and mostly empty, they are
fewer and larger, and each is also indexed with its one-deletion neighbourhood: of any (H + 1) / 2
segments, one then differs by one shingle at most.

Allocation by cost. A set has more segments than it must probe. The cost of a segment is the number
of other sets indexed under it or its neighbourhood; the cheapest that suffice are probed. Those
of cost 0 come first and need no work, so a set that merely shares a common passage has enough of
them and probes nothing; hot segments are probed last.

Verification. Members of a probed bucket are compared with one centre of the bucket first; linked
ones merge into components, which collapses groups of near copies with a number of comparisons linear in
their size. While very many pairs of different components are left and a round removes a tenth of them, more
rounds follow with other centres. Then every remaining pair of a probing and an indexed set of one
bucket whose components differ is compared; the sets of a large family are dealt into parts, and
each two parts meet in a task of their own. A comparison first counts the bits in which bitmaps of the two sets differ; sets
differ in at least as many shingles, so more than H rule the pair out, block by block inside a
task. Only pairs that pass are written, and those intersect the two whole sets.

Scale: signatures are shuffled packed, about 10 bytes each and 0.7 a shingle. Sets are read again
only for members of probed buckets, found by a Bloom filter of bounded size. Nothing but counts and that
filter reaches the driver.

Classes and shingles are 64-bit hashes. Two different sets of n have one class with a chance of about
n * n / 2 ** 65: 1e-7 for two million sets, some twelve such pairs expected among 3e10.

Defined cases: NULL, empty and wordless texts have the empty set, no links and themselves as
component; fewer words than a shingle: the whole sequence is the one shingle; rows that repeat
are in one class; a NULL id is no component name, so a component without ids has NULL; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import spread_join, stored
from stratum.llm.components import connected_components
from stratum.llm.hashed_words import arrow_slices, hashed_words, mix, release_memory, slices

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100
SMALL_BAND = 128            # bands that end below have one-deletion neighbourhoods
SEGMENTS_PER_SIZE = 0.6     # segments of a larger band, by its smallest size
FILTER_BITS = 1 << 29       # bound of the broadcast Bloom filter: 64 MB
BYTES_A_GROUP = 64 << 20    # bitmaps and bucket rows, about, that one task compares
MANY_PAIRS = 1 << 27        # pairs of two components beyond which another star round is tried
PAIRS_A_ROW = 64            # in buckets with more of them a row
_BLOCK = 1 << 19            # pairs compared at a time
_FLUSH = 700_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD6E8FEB86659FD93)


class Rule(NamedTuple):
    """Linked: denominator * intersection >= numerator * union, of shingles of ``words`` words."""
    words: int = WORDS
    numerator: int = NUMERATOR
    denominator: int = DENOMINATOR


# -- sets ---------------------------------------------------------------------------------

def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    sizes, token = hashed_words(texts)
    run = token[:max(0, len(token) - words + 1)].copy()
    for j in range(1, words):
        run = mix(run * _STEP + token[j:len(token) - words + 1 + j]) if len(run) else run
    ends = np.concatenate(([0], np.cumsum(sizes)))
    out = []
    for a, z in zip(ends.tolist(), ends[1:].tolist()):
        if z - a >= words:
            out.append(np.unique(run[a:z - words + 1]))
        elif z > a:
            h = np.array([z - a], np.uint64)
            for j in range(a, z):
                h = mix(h * _STEP + token[j:j + 1])
            out.append(h)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def class_of(shingles: np.ndarray) -> np.uint64:
    """A 64-bit name of the set, from two independent sums over it and its size."""
    with np.errstate(over="ignore"):
        one, two = np.add.reduce(mix(shingles ^ _SALT)), np.add.reduce(mix(shingles + _STEP))
        return mix(np.array([one * _STEP + two + np.uint64(len(shingles))], np.uint64))[0]


# -- bands --------------------------------------------------------------------------------

@functools.lru_cache(maxsize=4)
def band_ends(rule: Rule) -> np.ndarray:
    """Largest size of each band: the next one holds the sizes that can be linked beyond it."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] * rule.denominator // rule.numerator, ends[-1] + 1))
    return np.array(ends)


def most_different(rule: Rule, l: np.ndarray, s: np.ndarray) -> np.ndarray:
    """H: the most shingles in which linked sets of sizes l and up to s <= l differ."""
    n, d = rule.numerator, rule.denominator

    def differ(s: np.ndarray) -> np.ndarray:
        return l + s - 2 * -(-n * (l + s) // (n + d))

    return np.maximum(np.maximum(differ(s), differ(np.maximum(s - 1, 0))), 0)


def segments(rule: Rule, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of segments, whether with one-deletion neighbourhoods) of bands."""
    ends = band_ends(rule)
    low, high, above = np.where(band > 0, ends[band - 1] + 1, 1), ends[band], ends[band + 1]
    small = high < SMALL_BAND
    half = (most_different(rule, above, high) + 2) // 2
    return np.where(small, half + half // 4 + (half > 2), (SEGMENTS_PER_SIZE * low).astype(np.int64) + 1), small


class Signatures(NamedTuple):
    """By value: its entry, whether a shingle was left out, the segment if it is one of several
    of it. By entry: set, size, whether indexed, segments that need not be probed."""
    value: np.ndarray
    entry: np.ndarray
    deleted: np.ndarray
    segment: np.ndarray
    node: np.ndarray
    size: np.ndarray
    indexed: np.ndarray
    spare: np.ndarray


def signatures(rule: Rule, sets: list[np.ndarray], nodes: np.ndarray) -> Signatures:
    """Segment signatures of non-empty sets in their own band and, to probe, the one below."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    own = np.searchsorted(band_ends(rule), sizes)
    entry_set = np.concatenate([np.arange(len(sets)), np.flatnonzero(own > 0)])
    band = np.concatenate([own, own[own > 0] - 1])
    indexed = np.arange(len(entry_set)) < len(sets)
    m, small = segments(rule, band)
    size = sizes[entry_set]
    must = most_different(rule, size, np.minimum(size, band_ends(rule)[band])) + 1

    shingle = np.concatenate([sets[i] for i in entry_set])
    entry = np.repeat(np.arange(len(entry_set)), size)
    first = np.concatenate(([0], np.cumsum(m)))[:-1]
    segment = first[entry] + (mix(shingle) % m[entry].astype(np.uint64)).astype(np.int64)
    element = mix(shingle ^ _SALT)
    content = np.zeros(int(m.sum()), np.uint64)
    np.add.at(content, segment, element)
    filled = np.zeros(len(content), bool)
    filled[segment] = True
    of_entry = np.repeat(np.arange(len(entry_set)), m)
    name = mix((np.arange(len(content)) - first[of_entry]).astype(np.uint64) * _STEP
               + band[of_entry].astype(np.uint64) * _SALT)
    spare = np.where(small, m - (must + 1) // 2, np.bincount(of_entry, filled, len(entry_set)).astype(np.int64) - must)
    if (spare < 0).any():       # odds below 1e-13 a set; to lose a link silently would be worse
        raise ArithmeticError("a set fills too few segments to be probed; choose another _SALT")
    used = np.flatnonzero(filled | small[of_entry])
    less = np.flatnonzero(small[entry])
    value = np.concatenate([mix(content[used] + name[used]),
                            mix(content[segment[less]] - element[less] + name[segment[less]])])
    place = np.concatenate([used, segment[less]])
    of_value = of_entry[place]
    number = np.where(small[of_value], place - first[of_value] + 1, 0).astype(np.uint8)
    return Signatures(value, of_value, np.arange(len(value)) >= len(used), number, nodes[entry_set], size,
                      indexed, spare)


def _set_batches(rule: Rule, batches: Iterator[pa.RecordBatch]):
    """(first row, sets, classes) of slices of the batches' text column, which is the last."""
    for batch in batches:
        for start, part in arrow_slices(batch.column(batch.num_columns - 1)):
            sets = shingle_sets(part, rule.words)
            yield batch, start, sets, np.array([class_of(s) for s in sets], np.uint64)


_BLOB = ("value", "entry", "segment", "node", "size", "spare", "flags")


def _planes(x: np.ndarray) -> bytes:
    """Bytes of a number array, all lowest bytes first, and so on: near-equal numbers compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplaned(data, kind: str) -> np.ndarray:
    x = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(x.T).view(kind)[:, 0]


def _pack(value: np.ndarray, entry: np.ndarray, held: Signatures, rows: np.ndarray) -> list[bytes]:
    """One block: sorted 32-bit values as differences, the place of each one's entry, the entries.

    Sets of one-deletion values get an entry of their own, told by a flag.
    """
    there, local = np.unique(entry * 2 + held.deleted[rows], return_inverse=True)
    e = there >> 1
    return [_planes(np.diff(value, prepend=0).astype("<u4")), _planes(local.astype("<u4")),
            held.segment[rows].astype("u1").tobytes(),
            held.node[e].astype("<u8").tobytes(), _planes(held.size[e].astype("<u4")),
            _planes(held.spare[e].astype("<i4")), ((there & 1) + 2 * held.indexed[e]).astype("u1").tobytes()]


def _send_signatures(rule: Rule, shards: int):
    """text -> one packed block per shard and run of texts. A task sends a class once."""

    def blocks(parts: list[Signatures]) -> Iterator[pa.RecordBatch]:
        base = np.cumsum([0] + [len(h.node) for h in parts])
        held = Signatures(*[np.concatenate([getattr(h, c) + b if c == "entry" else getattr(h, c)
                                            for h, b in zip(parts, base)]) for c in Signatures._fields])
        parts.clear()
        shard = ((held.value >> np.uint64(32)) % np.uint64(shards)).astype(np.uint64)
        order = np.argsort(shard << np.uint64(32) | held.value & np.uint64(0xFFFFFFFF))
        edges = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
        for k in range(shards):
            at = order[edges[k]:edges[k + 1]]
            if len(at):
                blob = _pack((held.value[at] & np.uint64(0xFFFFFFFF)).astype(np.int64), held.entry[at], held, at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32())] + [pa.array([x], pa.binary()) for x in blob], names=["shard", *_BLOB])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Signatures] = []
        recent: set[int] = set()
        for _, _, sets, classes in _set_batches(rule, batches):
            fresh = [k for k, c in enumerate(classes.tolist())
                     if len(sets[k]) and c not in recent and not recent.add(c)]
            if len(recent) > 1_000_000:
                recent.clear()
            if fresh:
                held.append(signatures(rule, [sets[k] for k in fresh], classes[fresh]))
            if sum(len(h.value) for h in held) > _FLUSH:
                yield from blocks(held)
                held.clear()
        if held:
            yield from blocks(held)
        del held, recent
        release_memory()

    return send


def _buckets(key: tuple, group: pa.Table) -> pa.Table:
    """Signature values that an indexed set shares with another set: a row for each member."""
    def column(name: str, kind: str) -> list[np.ndarray]:
        return [_unplaned(b.as_buffer(), kind) for b in group[name]]

    value = np.concatenate([np.cumsum(x, dtype=np.uint32) for x in column("value", "<u4")])
    node = [np.frombuffer(b.as_buffer(), "<u8") for b in group["node"]]
    base = np.cumsum([0] + [len(x) for x in node])
    entry = np.concatenate([x.astype(np.int64) + b for x, b in zip(column("entry", "<u4"), base)])
    node, size, spare = np.concatenate(node), np.concatenate(column("size", "<u4")), np.concatenate(column("spare", "<i4"))
    flags, segment = (np.concatenate([np.frombuffer(b.as_buffer(), "u1") for b in group[c]])
                      for c in ("flags", "segment"))
    deleted_entry, indexed = flags & 1, flags >> 1
    # only values that occur twice or more are sorted by set
    order = np.argsort(value, kind="stable")
    same = value[order][1:] == value[order][:-1]
    often = np.zeros(len(order), bool)
    often[1:] |= same
    often[:-1] |= same
    at = order[often]
    deleted = deleted_entry[entry]
    at = at[np.lexsort((deleted[at], node[entry[at]], value[at]))]
    v, n = value[at], node[entry[at]]
    new = np.ones(len(at), bool)
    new[1:] = (v[1:] != v[:-1]) | (n[1:] != n[:-1])       # a copy of a set in another task
    at, v = at[new], v[new]
    starts = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1]))) if len(v) else np.empty(0, np.int64)
    e = entry[at]
    members = np.diff(np.append(starts, len(v)))
    left_out = deleted[at].astype(bool)

    def count(x: np.ndarray) -> np.ndarray:
        return np.repeat(np.add.reduceat(x.astype(np.int64), starts), members) if len(v) else members

    inside, whole = count(indexed[e]), count(~left_out)
    inside_whole = count(indexed[e].astype(bool) & ~left_out)
    # two neighbours with a shingle left out on both sides may differ by two: they do not count
    cost = np.where(left_out, inside_whole, inside - indexed[e])
    good = (np.repeat(members, members) > 1) & (whole > 0) & (inside > 0)
    bucket = np.int64(key[0].as_py()) << np.int64(32) | v.astype(np.int64)
    number = np.where(segment[at] > 0, segment[at], bucket)
    return pa.table({"bucket": bucket[good], "node": node[e][good].view(np.int64),
                     "size": size[e][good].astype(np.int64), "indexed": indexed[e][good].astype(bool),
                     "left_out": left_out[good], "segment": number[good].astype(np.int64),
                     "spare": spare[e][good], "cost": cost[good].astype(np.int64)})


# -- verification -------------------------------------------------------------------------

def _read_sets(rule: Rule, wanted, bits: int):
    """(id, text) -> id, size, class, and the set itself if the class may be wanted (once a task)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(wanted.value, np.uint8) if wanted is not None else None
        sent: set[int] = set()
        for batch, start, sets, classes in _set_batches(rule, batches):
            may = np.ones(len(sets), bool)
            if marks is not None:
                p = _places(classes, bits)
                may = (marks[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).all(axis=0)
            blobs, maps = [], []
            for s, c, ask in zip(sets, classes.tolist(), may.tolist()):
                ask = ask and len(s) and c not in sent and not sent.add(c)
                blobs.append(s.tobytes() if ask else None)
                maps.append(bitmap(s).tobytes() if ask else None)
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(sets)), pa.array(sizes, pa.int64()),
                 pa.array([c if n else None for c, n in zip(classes.view(np.int64).tolist(), sizes)], pa.int64()),
                 pa.array(maps, pa.binary()), pa.array(blobs, pa.binary())],
                names=["id", "size", "node", "bits", "shingles"])
        release_memory()

    return read


def _places(classes: np.ndarray, bits: int) -> np.ndarray:
    """Four Bloom filter places of each class."""
    places, h = [], classes
    for _ in range(4):
        h = mix(h + _STEP)
        places.append(h % np.uint64(bits))
    return np.stack(places)


def _filter_batches(bits: int):
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_places(batch.column(0).to_numpy().view(np.uint64), bits))
            byte, where = np.unique(places >> np.uint64(3), return_inverse=True)
            value = np.zeros(len(byte), np.uint8)
            np.bitwise_or.at(value, where, np.left_shift(1, (places & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(byte.view(np.int64)), pa.array(value.astype(np.int32))],
                                             names=["byte", "marks"])
    return marks


def _bloom(nodes: DataFrame, count: int) -> tuple[object, int]:
    """Broadcast Bloom filter of classes and its bits: 16 a class, fewer beyond the bound. Then it passes
    sets that are not wanted, 7 % at 6 bits and 40 % at 2, which cost their writing; (None, 0) at less than one."""
    bits = min(max(1024, 16 * count), FILTER_BITS)
    if bits < count:
        return None, 0
    rows = (nodes.mapInArrow(_filter_batches(bits), "byte long, marks int")
            .groupBy("byte").agg(F.bit_or("marks").alias("marks")).toPandas())
    marks = np.zeros(bits // 8 + 1, np.uint8)
    marks[rows["byte"].to_numpy(np.int64)] = rows["marks"].to_numpy(np.uint8)
    return nodes.sparkSession.sparkContext.broadcast(marks.tobytes()), bits


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """One bit a shingle, in a power of two of bytes with at least eight bits a shingle."""
    bits = 1 << max(6, (8 * len(shingles) - 1).bit_length())
    marks = np.zeros(bits, np.uint8)
    marks[(mix(shingles) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little")


def _differ(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two bitmaps differ, the longer one folded to the shorter one's length."""
    if len(x) != len(y):
        x, y = (x, y) if len(x) < len(y) else (y, x)
        y = np.bitwise_or.reduce(y.reshape(-1, len(x)))
    return int(np.bitwise_count(x ^ y).sum())


def _may_link(rule: Rule):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [batch.column(k).to_numpy() for k in (2, 3)]
            most = most_different(rule, np.maximum(*size), np.minimum(*size)).tolist()
            ok = [_differ(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)) <= m
                  for x, y, m in zip(batch.column(4), batch.column(5), most)]
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(ok, pa.bool_())) for c in (batch.column(0), batch.column(1))], names=["a", "b"])
    return check


def _linked(rule: Rule):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(rule.denominator * both >= rule.numerator * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(ok, pa.bool_())) for c in (batch.column(0), batch.column(1))], names=["a", "b"])
    return check


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets (node, size, bits, shingles) are similar enough."""
    left, right = (sets.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("bits").alias(f"bits_{c}"))
                   for c in "ab")
    near = stored(pairs.join(left, "a").join(right, "b").select("a", "b", "size_a", "size_b", "bits_a", "bits_b")
                  .mapInArrow(_may_link(rule), "a long, b long"), "near")
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    return near.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(
        _linked(rule), "a long, b long")


# -- the join -----------------------------------------------------------------------------

def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               rule: Rule = Rule()) -> DataFrame:
    """(id, n_shingles, class, component, component_id) of every row of ``df``.

    ``class`` names the set and ``component`` what is reached from it by links (NULL if empty);
    ``component_id`` is the smallest id among these.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = texts.select("text").mapInArrow(
        _send_signatures(rule, shards), "shard int, " + ", ".join(f"{c} binary" for c in _BLOB))
    members = stored(sent.groupBy("shard").applyInArrow(
        _buckets, "bucket long, node long, size long, indexed boolean, left_out boolean, segment long, "
                  "spare int, cost long"), "members")

    # the cheapest segments that a set must probe beyond its spare ones and those of cost 0
    entry = Window.partitionBy("node", "indexed")      # a set has one entry in its own band and one below it
    of_segment = Window.partitionBy("node", "indexed", "segment")
    ranked = stored(members.where("cost > 0").withColumn("all", F.sum("cost").over(of_segment))
                    .withColumn("turn", F.dense_rank().over(entry.orderBy("all", "segment")))
                    .withColumn("must", F.max("turn").over(entry) - F.col("spare"))
                    .where("turn <= must").select("bucket", "node", "size", "left_out"), "probes")
    index = (members.where("indexed").select("bucket", "node", "size", "left_out")
             .join(ranked.select("bucket").distinct(), "bucket", "left_semi"))
    both = stored(ranked.withColumn("asks", F.lit(True)).withColumn("indexed", F.lit(False))
                  .union(index.withColumn("asks", F.lit(False)).withColumn("indexed", F.lit(True)))
                  .groupBy("bucket", "node", "size", "left_out")
                  .agg(F.max("asks").alias("asks"), F.max("indexed").alias("indexed")), "probed")

    nodes = both.select("node").distinct()
    count = nodes.count()
    bloom, bits = _bloom(nodes, count)
    rows = texts.mapInArrow(_read_sets(rule, bloom, bits),
                            "id long, size long, node long, bits binary, shingles binary")
    rows = stored(rows, "sets")
    sets = rows.where("shingles is not null").drop("id")      # a set may be there once a task
    one = sets.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    if count and one.where("n > 1").take(1):
        sets = stored(sets.dropDuplicates(["node"]), "sets")

    links = _all_links(both, sets, rule) if count else None
    labels = connected_components(links) if links is not None else None
    return _named(rows.select("id", "size", "node"), labels)


def _named(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows with the smallest id of their component. Classes are joined, one row each, and their components'
    names are given back to the rows, so neither a class of many copies nor a component of many
    classes is one task's."""
    classes = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    if labels is not None:
        classes = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    else:
        classes = classes.withColumn("label", F.col("node"))
    classes = stored(classes, "classes")
    names = classes.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = spread_join(classes.select("node", "label", "n"), stored(names, "names"), "label")
    named = stored(named.select("node", "label", "component_id", "n"), "named")
    return (spread_join(rows, named, "node")
            .select("id", F.col("size").alias("n_shingles"), F.col("node").alias("class"), F.col("label").alias("component"),
                    F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


@F.pandas_udf(T.LongType())
def class_of_text(texts: pd.Series) -> pd.Series:
    """The class of each text under the default rule; NULL for an empty set."""
    out: list[int | None] = []
    for _, part in slices(texts.tolist()):
        out += [int(class_of(s).view(np.int64)) if len(s) else None for s in shingle_sets(part, WORDS)]
    return pd.Series(out, dtype="Int64")


def _fits(rule: Rule, x: str, y: str):
    """Sizes that can be linked."""
    return (rule.denominator * F.least(x, y) >= rule.numerator * F.greatest(x, y))


def _star(members: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of each bucket's centre, its first set, with the others."""
    centre = members.groupBy("bucket").agg(F.min(F.struct("node", "size")).alias("c"))
    pairs = members.join(centre, "bucket").where(F.col("node") != F.col("c.node")).where(_fits(rule, "size", "c.size"))
    return pairs.select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct()


def _all_links(members: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Enough links to join every linked pair of ``members``."""
    links = stored(verified(_star(members, rule), sets, rule), "links")
    labels = connected_components(links)
    before, turn = None, 0
    while True:
        rows = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = stored(rows.groupBy("bucket").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("centre"),
            (F.sum(F.col("asks").cast("double")) * F.sum(F.col("indexed").cast("double"))).alias("pairs"))
            .where("low <> high").select("bucket", "centre", "pairs"), "mixed")
        if not (mixed.agg(F.sum("pairs")).first()[0] or 0) > MANY_PAIRS:
            break
        many, total = _many_pairs(rows, mixed)
        if not total > MANY_PAIRS or (before is not None and total > 0.9 * before):
            break
        before, turn = total, turn + 1
        more = stored(verified(_star_again(rows, many, turn, rule), sets, rule), "links")
        links = links.union(more)
        labels = connected_components(links)
    left = _remaining(rows, mixed, sets, rule)
    return stored(links.union(verified(left, sets, rule)), "links")


def _many_pairs(rows: DataFrame, mixed: DataFrame) -> tuple[DataFrame, float]:
    """(buckets with many pairs of two components for their rows, number of such pairs in all of them)."""
    sums = [F.sum(F.col(c).cast("double")).alias(c) for c in ("asks", "indexed")]
    of_label = (rows.join(mixed.select("bucket"), "bucket").groupBy("bucket", "label")
                .agg(*sums, F.count(F.lit(1)).alias("n")))
    pairs = F.sum("asks") * F.sum("indexed") - F.sum(F.col("asks") * F.col("indexed"))
    many = stored(of_label.groupBy("bucket").agg(pairs.alias("pairs"), F.sum("n").alias("n"))
                  .where(F.col("pairs") > PAIRS_A_ROW * F.col("n")).select("bucket", "pairs"), "many")
    return many.select("bucket"), many.agg(F.sum("pairs")).first()[0] or 0.0


def _star_again(rows: DataFrame, many: DataFrame, turn: int, rule: Rule) -> DataFrame:
    """Pairs of another centre of each bucket, drawn by a hash, with the members of other components."""
    rows = rows.join(many, "bucket")
    centre = rows.groupBy("bucket").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("draw"), "node", "size",
                                                       "label")).alias("c"))
    pairs = rows.join(centre, "bucket").where(F.col("label") != F.col("c.label")).where(_fits(rule, "size", "c.size"))
    return pairs.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()


def _remaining(rows: DataFrame, mixed: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of a probing and an indexed set of one bucket whose components differ and whose
    bitmaps allow a link.

    Buckets with more than one component are dealt out by their centre, so that buckets of one
    family meet and each of its pairs is looked at once. The sets of a centre that would outgrow
    ``BYTES_A_GROUP`` are dealt by hash into k parts; each two of the parts, and each by itself, are a
    group of their own, so any pair of sets still meets in exactly one group, however many share
    one bucket. A task compares bitmaps in blocks and returns the pairs that pass.
    """
    nodes = stored(rows.join(mixed.select("bucket", "centre"), "bucket")
                   .groupBy("centre", "node", "label", "size").agg(F.collect_list(F.struct(
                       "bucket", (F.col("asks").cast("int") + 2 * F.col("indexed").cast("int")
                                  + 4 * F.col("left_out").cast("int")).alias("flags"))).alias("buckets")), "mixed")
    held = F.sum(F.lit(64) + 12 * F.size("buckets") + 2 * F.col("size"))
    # a row for each BYTES_A_GROUP of all sets at most
    heavy = (nodes.groupBy("centre").agg(held.alias("held")).where(F.col("held") > BYTES_A_GROUP)
             .select("centre", F.ceil(2 * F.col("held") / F.lit(BYTES_A_GROUP)).cast("int").alias("parts")))
    parted = (nodes.join(F.broadcast(heavy), "centre", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
              .withColumn("part", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("parts")).cast("int"))
              .join(sets.select("node", "bits"), "node")
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    return (parted.select("centre", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                          "part", "node", "label", "size", "buckets", "bits")
            .groupBy("centre", "i", "j").applyInArrow(_compare(rule), "a long, b long").distinct())


class _Bitmaps:
    """Bitmaps of a group's sets; two of different lengths are compared at the shorter one's."""

    def __init__(self, maps: list[np.ndarray]):
        self.maps, self.length = maps, np.fromiter(map(len, maps), np.int64, len(maps))

    def differ(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of bits in which maps x and y differ, pair by pair."""
        shorter, out = np.minimum(self.length[x], self.length[y]), np.empty(len(x), np.int64)
        for n in np.unique(shorter).tolist():
            here = np.flatnonzero(shorter == n)
            used = np.unique(np.concatenate([x[here], y[here]]))
            rows = np.stack([np.bitwise_or.reduce(self.maps[k].reshape(-1, n)) for k in used.tolist()]).view(np.uint64)
            p, q = np.searchsorted(used, x[here]), np.searchsorted(used, y[here])
            step = max(1, _BLOCK * 8 // n)
            for k in range(0, len(here), step):
                part = slice(k, k + step)
                out[here[part]] = np.bitwise_count(rows[p[part]] ^ rows[q[part]]).sum(axis=1)
        return out


def _mixed_pairs(ask: np.ndarray, there: np.ndarray, ask_label: np.ndarray,
                 label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of an ask and an entry there of another label, block by block; ``there`` is sorted by label."""
    low, high = np.searchsorted(label, ask_label), np.searchsorted(label, ask_label, "right")
    skip = high - low
    n = len(there) - skip
    ends = np.cumsum(n)
    start, done = 0, 0
    while start < len(ask):
        stop = max(start + 1, int(np.searchsorted(ends, done + _BLOCK, "right")))
        x = np.repeat(np.arange(start, stop), n[start:stop])
        y = np.arange(done, ends[stop - 1]) - (ends - n)[x]
        y += np.where(y >= low[x], skip[x], 0)
        yield ask[x], there[y]
        start, done = stop, int(ends[stop - 1])


def _compare(rule: Rule):
    def compare(key: tuple, group: pa.Table) -> pa.Table:
        split = key[1].as_py() != key[2].as_py()       # only pairs across the two parts
        node, label, size = (group[c].to_numpy() for c in ("node", "label", "size"))
        far = group["part"].to_numpy() != key[1].as_py()
        bits = _Bitmaps([np.frombuffer(b.as_buffer(), np.uint8) for b in group["bits"]])
        buckets = group["buckets"].combine_chunks()
        of = np.repeat(np.arange(len(node)), buckets.value_lengths().to_numpy())
        entries = buckets.flatten()
        bucket, flags = entries.field("bucket").to_numpy(), entries.field("flags").to_numpy()
        order = np.lexsort((label[of], bucket))
        of, flags = of[order], flags[order]
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-2))
        asks, indexed, out = ((flags & k).astype(bool) for k in (1, 2, 4))
        passed: list[np.ndarray] = []
        waiting: list[np.ndarray] = []

        def settle() -> None:
            code = np.unique(np.concatenate(waiting))
            waiting.clear()
            x, y = np.divmod(code, len(node))
            most = most_different(rule, np.maximum(size[x], size[y]), np.minimum(size[x], size[y]))
            passed.append(code[bits.differ(x, y) <= most])

        def sides(mine: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
            ask, there = mine[asks[mine]], mine[indexed[mine]]
            if not split:
                return [(ask, there)]
            return [(ask[far[of[ask]] == s], there[far[of[there]] != s]) for s in (False, True)]

        held = 0
        for a, z in zip(edges, edges[1:]):
            if label[of[a]] == label[of[z - 1]]:
                continue
            for ask, there in sides(np.arange(a, z)):
                for x, y in _mixed_pairs(ask, there, label[of[ask]], label[of[there]]):
                    p, q = of[x], of[y]
                    small, large = np.minimum(size[p], size[q]), np.maximum(size[p], size[q])
                    good = ~(out[x] & out[y]) & (rule.denominator * small >= rule.numerator * large)
                    p, q = p[good], q[good]
                    waiting.append(np.unique(np.minimum(p, q) * len(node) + np.maximum(p, q)))
                    held += len(waiting[-1])
                    if held > 8 * _BLOCK:
                        settle()
                        held = 0
        if waiting:
            settle()
        code = np.unique(np.concatenate(passed)) if passed else np.empty(0, np.int64)
        x, y = np.divmod(code, max(1, len(node)))
        return pa.table({"a": np.minimum(node[x], node[y]), "b": np.maximum(node[x], node[y])})

    return compare
