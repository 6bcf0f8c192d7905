import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import conversation_trie as ct
from stratum.llm.registry import op13_conversation_trie

FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_trie(convs):
    """Nodes of {id: [(role, text), ...]} by their whole sequences."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, who in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += (len(who) - 1) * (len(n[-1][1]) if n else 0)
    return sorted((min(w), len(n), min(members[n[:-1]]) if n else None, len(w), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
                  for n, w in members.items())


def rebuilt(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def found(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()),
                  key=lambda r: tuple((x is not None, x) for x in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.fixture(scope="module")
def trie(spark):
    def run(convs, **kw):
        digest = {t: hashlib.md5(repr(t).encode()).hexdigest() for turns in convs.values() for t in turns}
        rows = [(c, [(digest[t], len(t[1])) for t in turns]) for c, turns in convs.items()]
        return found(ct.prefix_trie(spark.createDataFrame(
            rows, "conv_id long, turns array<struct<digest:string,chars:int>>"), **kw))
    return run


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert found(op13_conversation_trie(spark, sf)) == ordered(brute_trie(rebuilt(rows)))


@pytest.mark.parametrize("shard_turns", [1, 7, 60, 1 << 17])
def test_spines_merge_over_any_shards(spark, trie, shard_turns):
    """Copies, prefixes, a hot first turn, empty conversations, cut into shards of every size."""
    rng = random.Random(shard_turns)
    turns = [("user", "a" * k) for k in range(3)]
    convs = {rng.randrange(-500, 5000): [("user", "hello")] * (k % 3 > 0) + rng.choices(turns, k=rng.randrange(5))
             for k in range(150)}
    convs |= {9000 + k: [("user", "hello"), turns[0], turns[1]] for k in range(70)}      # a third are copies
    convs |= {20_000: [turns[0]] * 300, 20_001: [turns[0]] * 299 + [turns[1]]}
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        assert trie(convs, shard_turns=shard_turns) == ordered(brute_trie(convs))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", parts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.booleans(), max_size=600), st.sampled_from([2, 4, 64]))
def test_find_close(steps, block):
    bits, depth = [1], 1
    for up in steps:
        if up or depth > 1:
            bits.append(int(up))
            depth += 1 if up else -1
    bits += [0] * depth
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    opens = np.flatnonzero(bits)
    assert ct.Parentheses(np.array(bits), block).find_close(opens).tolist() == [close[i] for i in opens.tolist()]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=70), st.data())
def test_least_of_runs(values, data):
    runs = data.draw(st.lists(st.tuples(st.integers(0, len(values) - 1), st.integers(1, len(values))), min_size=1))
    first = np.array([a for a, _ in runs])
    end = np.minimum(first + [n for _, n in runs], len(values))
    got = ct.least_of_runs(np.array(values), first, end)
    assert got.tolist() == [min(values[a:z]) for a, z in zip(first.tolist(), end.tolist())]


def test_edge_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, None, "user", "first"), (1, 2, None, None), (1, 1, "user", "Ä😀"), (None, 1, "user", "nobody"),
            (7, 1, "user", "x"), (7, 1, "user", "x"), (8, 3, "us", "erx"), (9, 0, "user", "y" * 200_000)]
    extra = spark.createDataFrame(rows, schema).withColumns({"turns": F.lit(1), "t": F.lit(2), "path": F.lit("p")})
    plain = {1: [("user", "first"), ("user", "Ä😀"), ("", "")], 7: [("user", "x")] * 2, 8: [("us", "erx")],
             9: [("user", "y" * 200_000)]}
    assert found(ct.prefix_trie(ct.conversations(extra))) == ordered(brute_trie(plain))
    # heads of another conversation: absent, shorter than asked, a conversation left without turns
    rows = [(c, k, "user", f"{c // 100} {k}") for c in (200, 201, 202, 205, 317, 999) for k in range(2)]
    rows += [(400, k, "user", str(k)) for k in range(9)] + [(c + k, 0, "user", "own") for c in (400, 600) for k in range(1, 30)]
    want = rebuilt(rows)
    assert [] in want.values() and any(len(t) > 1 for c, t in want.items() if c > 400)
    got = ct.prefix_trie(ct.with_shared_heads(ct.conversations(spark.createDataFrame(rows, schema))))
    assert found(got) == ordered(brute_trie(want))
    none = spark.createDataFrame([], schema)
    assert ct.prefix_trie(ct.with_shared_heads(ct.conversations(none))).count() == 0
