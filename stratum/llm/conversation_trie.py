"""Prefix trie of conversations, as balanced parentheses by shard.

A conversation is the sequence of its turns, a turn a digest of role and text. Sorted by their digests,
conversations that begin alike lie next to each other, so any run of the sorted rows holds a
contiguous piece of the trie. Each run of about ``SHARD_TURNS`` turns is a shard: its piece is written
down as balanced parentheses in preorder, with the running excess in blocks whose minima and maxima form
a tree of ranges. ``find_close`` searches these for the end of a node's subtree; the rows between are
its conversations, the rank of ``()`` pairs counts its leaves, and a cumulative array over the preorder
gives what it saves.

Nodes on the first and last path of a shard, its spine, may go on in its neighbours. They leave the shard
with what their finished children give, and are merged by one task that reads them in the order of the
shards with a stack of the nodes that are open. All other nodes are finished where they are.

Scale: texts leave the scan as digests (16 bytes a turn). Rows are range-partitioned by path and then id,
so copies of one conversation are spread as well. A shard's arrays take some 10 MB. The merging task
reads two paths a shard, however many rows there are between; it holds the open path and one number a
shard. Identifiers of conversations that end in a node are hashed as they stream by, each shard's
part as one text. One conversation's digests are held in one row (16 bytes a turn): that is the only
group kept together, and the limit is some 50 million turns of one conversation.

Defined cases: rows with a NULL id belong to no conversation; a NULL role or text is empty; a NULL
turn comes first and equal turns are ordered by their digest; repeated rows are turns of their own; texts
of any length are digested whole; an empty table has no nodes, not even the root; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.hashed_words import release_memory
from stratum.session import scratch_path

SHARD_TURNS = 1 << 17
BLOCK = 64                  # parentheses in a block of the range tree
DIGEST = 16                 # bytes of a turn's digest
EMPTY = hashlib.sha256().hexdigest()


# -- conversations -------------------------------------------------------------------------------

def conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (digest, code points of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = (rows.where(F.col(conv_col).isNotNull())
             .select(F.col(conv_col).cast("long").alias("conv_id"),
                     F.struct(F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).alias("chars")).alias("t")))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"),
                                                                         t["chars"].alias("chars"))).alias("turns"))


def with_shared_heads(convs: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """Conversations whose first h turns are those of the first of their family (ids c - c % family),
    with h the crc32 of the id as text modulo ``heads``; own turns follow after the first h."""
    most = heads - 1
    first = (convs.where(F.col("conv_id") % family == 0)
             .select(F.col("conv_id").alias("__first"), F.slice("turns", 1, most).alias("__head")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    none = F.slice("turns", 1, 0)
    return (convs.withColumn("__first", F.col("conv_id") - F.col("conv_id") % family).join(first, "__first", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("__head", none), F.lit(1), h),
                                        F.slice("turns", h + 1, F.size("turns"))).alias("turns")))


# -- balanced parentheses ------------------------------------------------------------------------

class Parentheses:
    """A balanced sequence (1 opens, 0 closes) with blocks of excess under a tree of ranges."""

    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.block = block
        self.excess = np.cumsum(2 * bits.astype(np.int32) - 1, dtype=np.int32)
        filled = np.full(-(-len(bits) // block) * block, self.excess[-1], np.int32)
        filled[:len(bits)] = self.excess
        rows = filled.reshape(-1, block)
        self.least, self.most = [rows.min(axis=1)], [rows.max(axis=1)]
        while len(self.least[-1]) > 1:
            self.least.append(np.minimum.reduceat(self.least[-1], np.arange(0, len(self.least[-1]), 2)))
            self.most.append(np.maximum.reduceat(self.most[-1], np.arange(0, len(self.most[-1]), 2)))

    def _holds(self, level: int, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Whether a range reaches an excess; steps of one leave out no value between its bounds."""
        inside = at < len(self.least[level])
        at = np.where(inside, at, 0)
        return inside & (self.least[level][at] <= value) & (value <= self.most[level][at])

    def _scan(self, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
        """First place from ``start`` before ``end`` with that excess, or -1."""
        found, left = np.full(len(start), -1, np.int64), np.arange(len(start))
        for step in range(self.block):
            left = left[start[left] + step < end[left]]
            if not len(left):
                break
            hit = self.excess[start[left] + step] == value[left]
            found[left[hit]] = start[left[hit]] + step
            left = left[~hit]
        return found

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """For each opening parenthesis the place of the one that closes it."""
        opens = np.asarray(opens, np.int64)
        value, size = self.excess[opens] - 1, len(self.excess)
        own = opens // self.block
        close = self._scan(opens + 1, np.minimum((own + 1) * self.block, size), value)
        left = np.flatnonzero(close < 0)
        if not len(left):
            return close
        at, level = own[left], np.zeros(len(left), np.int64)        # climb until a range to the right holds it
        climbing = np.arange(len(left))
        for k in range(len(self.least)):
            sibling = at[climbing] + 1
            hit = (at[climbing] % 2 == 0) & self._holds(k, sibling, value[left[climbing]])
            at[climbing[hit]], level[climbing[hit]] = sibling[hit], k
            climbing = climbing[~hit]
            at[climbing] //= 2
        for k in range(len(self.least) - 1, 0, -1):                 # and go down to its first block
            here = np.flatnonzero(level == k)
            child = at[here] * 2
            at[here] = np.where(self._holds(k - 1, child, value[left[here]]), child, child + 1)
            level[here] = k - 1
        close[left] = self._scan(at * self.block, np.minimum((at + 1) * self.block, size), value[left])
        return close


def least_of_runs(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum of values[first:end] for many runs, from a table of minima over powers of two."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        step = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    out = np.empty(len(first), values.dtype)
    power = np.frexp((end - first).astype(np.float64))[1] - 1
    for k in np.unique(power).tolist():
        at = np.flatnonzero(power == k)
        out[at] = np.minimum(table[k][first[at]], table[k][end[at] - (1 << k)])
    return out


# -- shards --------------------------------------------------------------------------------------

def common_turns(turns: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Number of leading turns that each row shares with the row before."""
    out, left = np.zeros(len(sizes), np.int64), np.arange(1, len(sizes))
    depth = 0
    while len(left):
        left = left[np.minimum(sizes[left], sizes[left - 1]) > depth]
        left = left[(turns[starts[left] + depth] == turns[starts[left - 1] + depth]).all(axis=1)]
        out[left] += 1
        depth += 1
    return out


class Shard:
    """The piece of the trie over a run of sorted rows."""

    def __init__(self, ids: np.ndarray, paths: list[bytes], chars: np.ndarray):
        rows = len(ids)
        sizes = np.fromiter(map(len, paths), np.int64, rows) // DIGEST
        starts = np.cumsum(sizes) - sizes
        turns = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)
        common = common_turns(turns, starts, sizes)
        opens, closes = sizes - common, np.zeros(rows, np.int64)
        closes[1:] = sizes[:-1] - common[1:]
        runs = np.stack([closes, opens], axis=1).ravel()
        bits = np.concatenate([[1], np.repeat(np.tile([0, 1], rows), runs), np.zeros(sizes[-1] + 1, np.int64)])
        nodes = int(opens.sum()) + 1

        # nodes in preorder, the root first; each was opened by a row, at a turn of it
        row = np.repeat(np.arange(rows), opens)
        self.depth = np.ones(nodes, np.int64)
        self.depth[1:] = common[row] + np.arange(1, nodes) - np.repeat(np.cumsum(opens) - opens, opens)
        at = starts[row] + self.depth[1:] - 1
        self.depth[0] = 0
        self.turn = np.zeros((nodes, 2), np.uint64)
        self.turn[1:] = turns[at]
        self.chars = np.zeros(nodes, np.int64)
        self.chars[1:] = chars[at]

        start = np.flatnonzero(bits)
        close = Parentheses(bits).find_close(start)
        first = np.concatenate([[0], row])
        ends_at = np.cumsum(closes + opens)                         # place where each row ends
        end = np.searchsorted(ends_at, close)
        self.convs, self.conv_id = end - first, least_of_runs(ids, first, end)
        self.ids, self.end_node = ids, np.cumsum(opens)

        # the spine: nodes on the first row's path and on the last one's
        self.left = np.arange(nodes) <= sizes[0]
        self.right = close >= len(bits) - 1 - sizes[-1]
        self.spine = self.left | self.right

        order = np.sort(self.depth * nodes + np.arange(nodes))
        above = (self.depth[1:] - 1) * nodes
        self.parent = np.full(nodes, -1, np.int64)
        self.parent[1:] = order[np.searchsorted(order, above + np.arange(1, nodes)) - 1] - above
        inner = ~self.spine
        self.children = np.bincount(self.parent[inner], minlength=nodes)
        pair = np.zeros(len(bits) + 1, np.int64)
        pair[1:-1] = bits[:-1] & (1 - bits[1:])
        pair[start[self.spine] + 1] = 0
        rank = np.cumsum(pair)
        self.leaves = rank[close] - rank[start]
        saved = np.concatenate([[0], np.cumsum(np.where(inner, (self.convs - 1) * self.chars, 0))])
        size = (close - start + 1) // 2
        self.saved = saved[np.arange(nodes) + size] - saved[:-1]
        # what a spine node gets from its finished children only
        below = np.flatnonzero(self.spine)[1:]
        leaves, gains = self.leaves[below], self.saved[below]
        np.subtract.at(self.leaves, self.parent[below], leaves)
        np.subtract.at(self.saved, self.parent[below], gains)

    def ending(self, node: np.ndarray) -> list[str]:
        """Ids of the conversations that end in each node, ascending, as one text."""
        a, z = np.searchsorted(self.end_node, node), np.searchsorted(self.end_node, node, side="right")
        return [",".join(map(str, self.ids[i:j].tolist())) if j > i else "" for i, j in zip(a.tolist(), z.tolist())]


_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
_PIECE = f"kind int, shard long, place long, {_NODE}, ends string, turn binary, chars long, on_left boolean"


def _finished(shard: Shard, number: int) -> pa.RecordBatch:
    node = np.flatnonzero(~shard.spine)
    spine = np.flatnonzero(shard.spine)
    parent = shard.parent[node]
    through = shard.spine[parent]
    place = np.where(through, np.searchsorted(spine, parent), -1)
    ends = [hashlib.sha256(e.encode()).hexdigest() if e else EMPTY for e in shard.ending(node)]
    none = pa.nulls(len(node))
    return _piece(len(node), 0, number, [
        place, shard.conv_id[node], shard.depth[node], pa.array(shard.conv_id[parent], mask=through), shard.convs[node],
        shard.children[node], shard.leaves[node], shard.saved[node], ends, none.cast(pa.string()),
        none.cast(pa.binary()), shard.chars[node], none.cast(pa.bool_())])


def _open(shard: Shard, number: int) -> pa.RecordBatch:
    """The spine: the first path from the root down, then what the last path has beyond it."""
    node = np.flatnonzero(shard.spine)
    none = pa.nulls(len(node))
    return _piece(len(node), 1, number, [
        np.arange(len(node)), shard.conv_id[node], shard.depth[node], none.cast(pa.int64()), shard.convs[node],
        shard.children[node], shard.leaves[node], shard.saved[node], none.cast(pa.string()), shard.ending(node),
        [t.tobytes() for t in shard.turn[node]], shard.chars[node], pa.array(shard.left[node])])


_COLUMNS = [c.split(" ")[0] for c in _PIECE.split(", ")]


def _piece(rows: int, kind: int, number: int, columns: list) -> pa.RecordBatch:
    arrays = [pa.array(np.full(rows, kind, np.int32)), pa.array(np.full(rows, number, np.int64))]
    for name, c in zip(_COLUMNS[2:], columns):
        text = pa.string() if name in ("ends_sha256", "ends") else pa.binary() if name == "turn" else None
        arrays.append(c if isinstance(c, pa.Array) else pa.array(c, type=text or pa.int64()))
    return pa.RecordBatch.from_arrays(arrays, names=_COLUMNS)


def _sharder(shard_turns: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held, size, number = [], 0, 0
        for batch in _slices(batches, shard_turns):
            held.append(batch)
            size += len(batch.column("chars").flatten()) + batch.num_rows
            if size >= shard_turns:
                yield from _pieces(held, first + number)
                held, size, number = [], 0, number + 1
        if held:
            yield from _pieces(held, first + number)
        release_memory()
    return shards


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that none has many more turns than a shard."""
    for batch in batches:
        ends = np.cumsum(np.diff(batch.column("chars").offsets.to_numpy()) + 1)
        cuts = np.unique(np.concatenate([np.searchsorted(ends, np.arange(most, ends[-1], most)) + 1, [batch.num_rows]])
                         if len(ends) else np.empty(0, np.int64))
        start = 0
        for end in cuts.tolist():
            yield batch.slice(start, end - start)
            start = end


def _pieces(held: list[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held).combine_chunks()
    shard = Shard(table["conv_id"].to_numpy(), table["path"].to_pylist(),
                  np.concatenate([b.column("chars").flatten().to_numpy() for b in held]).astype(np.int64))
    yield _finished(shard, number)
    yield _open(shard, number)


# -- the spines ----------------------------------------------------------------------------------

@dataclass
class _Node:
    turn: bytes
    chars: int
    depth: int
    conv_id: int
    parent: tuple[int, int] | None      # the parent's first (shard, place)
    convs: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    names: list[tuple[int, int]] = field(default_factory=list)
    ends: object = None

    def add(self, piece: dict) -> None:
        self.conv_id = min(self.conv_id, piece["conv_id"])
        self.convs += piece["n_convs"]
        self.children += piece["n_children"]
        self.leaves += piece["n_leaves"]
        self.saved += piece["saved_tokens"]
        self.names.append((piece["shard"], piece["place"]))
        if piece["ends"]:
            text = piece["ends"].encode()
            if self.ends is None:
                self.ends = hashlib.sha256(text)
            else:
                self.ends.update(b"," + text)


_MERGED = f"kind int, shard long, place long, {_NODE}"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spine nodes of all shards in order: finished nodes (kind 0, with their parent's first name), and the
    smallest conversation of each name, a (shard, place) (kind 1)."""
    stack: list[_Node] = []
    out: list[dict] = []
    fields = [c.split(" ")[0] for c in _MERGED.split(", ")]
    schema = pa.schema([(f, pa.int32() if f == "kind" else pa.string() if f == "ends_sha256" else pa.int64())
                        for f in fields])

    def close(depth: int) -> None:
        while len(stack) > depth:
            n = stack.pop()
            if not n.children:
                n.leaves = 1
            n.saved += (n.convs - 1) * n.chars
            if stack:
                stack[-1].leaves += n.leaves
                stack[-1].saved += n.saved
            shard, place = n.parent or (None, None)
            out.append({"kind": 0, "shard": shard, "place": place, "conv_id": n.conv_id, "depth": n.depth,
                        "n_convs": n.convs, "n_children": n.children, "n_leaves": n.leaves, "saved_tokens": n.saved,
                        "ends_sha256": n.ends.hexdigest() if n.ends else EMPTY})
            out.extend({"kind": 1, "shard": s, "place": p, "conv_id": n.conv_id} for s, p in n.names)

    def follow(piece: dict) -> None:        # the last path of a shard stays open for the next one
        depth = piece["depth"]
        if depth < len(stack) and (stack[depth].turn != piece["turn"] or not piece["on_left"]):
            close(depth)
        if depth == len(stack):
            if stack:
                stack[-1].children += 1
            stack.append(_Node(piece["turn"], piece["chars"], depth, piece["conv_id"],
                               stack[-1].names[0] if stack else None))
        stack[depth].add(piece)

    for batch in batches:
        for piece in batch.to_pylist():
            follow(piece)
        if len(out) > 10_000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
    close(0)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def prefix_trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row a node: conv_id (the smallest conversation through it), depth, parent_conv_id, n_convs,
    n_children, n_leaves and saved_tokens of its subtree, ends_sha256 (ids that end there).

    ``convs``: (conv_id, turns array<struct<digest: 32 hex digits, chars>>), one row a conversation.
    """
    spark = convs.sparkSession
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = convs.select("conv_id", path.alias("path"),
                        F.transform("turns", lambda t: t["chars"].cast("long")).alias("chars"))
    pieces = (rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
              .mapInArrow(_sharder(shard_turns), _PIECE))
    folder = scratch_path(spark, "trie")
    pieces.write.partitionBy("kind").parquet(f"{folder}/pieces")
    pieces = spark.read.schema(pieces.schema).parquet(f"{folder}/pieces")
    spine = pieces.where("kind = 1").drop("kind", "parent_conv_id", "ends_sha256")
    merged = spine.repartition(1).sortWithinPartitions("shard", "place").mapInArrow(_merge, _MERGED)
    merged.write.parquet(f"{folder}/merged")
    merged = spark.read.schema(merged.schema).parquet(f"{folder}/merged")

    names = merged.where("kind = 1").select("shard", "place", F.col("conv_id").alias("parent"))
    inner = pieces.where("kind = 0")
    columns = [c.split(" ")[0] for c in _NODE.split(", ")]
    open_ = (inner.where("place >= 0").select("shard", "place", *columns)
             .unionByName(merged.where("kind = 0").select("shard", "place", *columns)))
    named = (open_.join(names, ["shard", "place"], "left")
             .withColumn("parent_conv_id", F.col("parent")).select(*columns))
    return inner.where("place < 0").select(*columns).unionByName(named)
