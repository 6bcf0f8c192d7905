import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.llm import phrase_fingerprints as pf
from stratum.llm.registry import op11_phrase_fingerprints

ALL = (1 << 64) - 1
GOLD = 0x9E3779B97F4A7C15


def mix(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & ALL
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & ALL
    return h ^ (h >> 31)


def labels(symbols):
    out = []
    for i, s in enumerate(symbols):
        other = symbols[i - 1] if i else s ^ 1
        place = ((s ^ other) & -(s ^ other)).bit_length() - 1
        out.append(2 * place + (s >> place & 1))
    return out


def plain_level(symbols):
    """Names of the phrases of one text, symbol by symbol."""
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    symbols = [s if n == 1 else mix((s * GOLD + n) & ALL) for s, n in runs]
    label = symbols
    for _ in range(4):
        label = labels(label)
        assert all(a != b for a, b in zip(label, label[1:]))
    assert max(label) < 6
    starts = [0] + [i for i in range(1, len(symbols) - 1) if label[i] < label[i - 1] and label[i] < label[i + 1]]
    names = []
    for a, z in zip(starts, [*starts[1:], len(symbols)]):
        name = mix(symbols[a])
        for s in symbols[a + 1:z]:
            name = ((name ^ s) * GOLD) & ALL
            name ^= name >> 31
        names.append(name)
    return names


def plain_parse(text):
    levels = [[ord(c) for c in text]] if text else []
    while levels and len(levels[-1]) > 1:
        levels.append(plain_level(levels[-1]))
    return levels


def plain_fingerprint(text):
    levels, least = plain_parse(text), {}
    for level, names in enumerate(levels):
        if level >= pf.LEVEL or (level and len(text) < pf.SHORT) or len(names) == 1:
            for name in names:
                h = mix((name + level + 1) & ALL)
                least[h >> 57] = min(least.get(h >> 57, ALL), h)
    whole = mix((levels[-1][0] + len(levels)) & ALL) if levels else 0
    sketch = b"".join((least[b] % 65535 + 1 if b in least else 0).to_bytes(2, "big") for b in range(128))
    return (whole.to_bytes(8, "big") + sketch).hex()


def plain_likeness(a, b):
    if a == b:
        return 1.0
    cells = [(a[k:k + 4], b[k:k + 4]) for k in range(16, len(a), 4)]
    filled = [(x, y) for x, y in cells if (x, y) != ("0000", "0000")]
    j = sum(x == y for x, y in filled) / max(len(filled), 1)
    return 2 * j / (1 + j)


def expected(rows):
    """(id, text) rows in their order to the query's rows."""
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        changed = text[:len(text) - n] + following[:n]
        a, b, c = map(plain_fingerprint, (text, changed, following))
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, plain_likeness(a, b),
                    plain_likeness(a, c)))
    return out


def compared(df):
    return [(r.id, r.n_chars, r.edited_sha256, r.fingerprint.hex(), r.edited_fingerprint.hex(), r.near_edited, r.near_next)
            for r in pf.compare_with_next(df).collect()]


def key(row):
    return tuple((x is None, x) for x in row)


TEXTS = st.lists(st.one_of(st.text(max_size=90), st.text("ab", max_size=200), st.text(max_size=3).map(lambda t: t * 40)),
                 max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_parse_and_fingerprint_against_plain_versions(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    levels = [[] for _ in texts]
    for level, names, text in pf.parse(texts):
        for k in np.unique(text).tolist():
            assert len(levels[k]) == level
            levels[k].append(names[text == k].tolist())
    assert levels == [plain_parse(t) for t in texts]
    assert [p.hex() for p in pf.packed(pf.fingerprint(texts))] == [plain_fingerprint(t) for t in texts]


def test_equal_substrings_share_their_phrases_at_any_offset():
    rng = random.Random(5)
    middle = "".join(rng.choices("abcdefg hijklm", k=4000))
    for _ in range(5):
        ends = ["".join(rng.choices("abcdefg hijklm", k=rng.randrange(1, 300))) for _ in range(4)]
        a, b = plain_parse(ends[0] + middle + ends[1]), plain_parse(ends[2] + middle + ends[3])
        for level in range(1, 5):
            inside = set(plain_parse(middle)[level][3 * level:-3 * level])
            assert len(inside - set(a[level])) <= 4 and len(inside - set(b[level])) <= 4
    near = pf.likeness(pf.fingerprint([middle]), pf.fingerprint([ends[0] + middle]))
    apart = pf.likeness(pf.fingerprint([middle]), pf.fingerprint(["".join(rng.choices("abcdefg hijklm", k=4000))]))
    assert near[0] > 0.85 and apart[0] < 0.1


def test_likeness_follows_the_share_in_common():
    rng = random.Random(6)
    new = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    texts = [new(8000) for _ in range(40)]
    for share in (0.25, 0.5, 0.9):
        other = [t[:int(8000 * share)] + new(8000 - int(8000 * share)) for t in texts]
        got = pf.likeness(pf.fingerprint(texts), pf.fingerprint(other))
        assert abs(got.mean() - share) < 0.04 and np.abs(got - share).max() < 0.2


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in op11_phrase_fingerprints(spark, sf).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect())
    assert got == sorted(expected(rows))
    other = [r for r in got if r[6] < 0.5]
    assert np.mean([r[5] > 0.5 for r in got]) > 0.95 and np.mean([r[5] > r[6] for r in other]) > 0.97


@pytest.mark.parametrize("parts", [1, 7])
def test_order_edges_and_partitions(spark, parts):
    """Every partition's last row finds its next one; NULL and empty texts, one code point, long texts."""
    rng = random.Random(7)
    rows = [(k * 3, None if k % 11 == 0 else "" if k % 13 == 0 else "xyé😀 "[:1 + k % 5] * rng.randrange(40))
            for k in range(60)] + [(400, "w" * 300_000), (401, "w" * 299_999 + "v"), (402, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"id": F.lit("clash"), "part": F.lit(1), "edge": F.lit(2), "n_chars": F.lit(3), "__place": F.lit(0)})
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert sorted(compared(df.repartition(3)), key=key) == sorted(expected(sorted(rows)), key=key)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_few_rows_repeated_rows_and_no_id(spark):
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    assert compared(make([])) == []
    assert compared(make([(5, "only one of them")])) == expected([(5, "only one of them")])
    twice = [(5, "the same row"), (5, "the same row"), (None, "no id")]
    assert sorted(compared(make(twice[::-1])), key=key) == sorted(expected(twice), key=key)
    prints = {r.id: r.fingerprint for r in pf.fingerprints(make([(1, "copy"), (2, "copy"), (3, None), (4, "")])).collect()}
    assert prints[1] == prints[2] and prints[3] == prints[4] != prints[1]
