"""URL filter: host and path rules, then a list of URLs behind a blocked Bloom filter.

A rule (host, path, verdict) fits a URL whose host is the rule's or a subdomain of it and whose
path starts with the rule's; the longest fitting rule decides (ties: the first given). URLs
that no rule fits are looked up in a list of canonical URLs: a blocked Bloom filter of the list
(blocks of 256 bits, two bits in each of four 64-bit words) passes possible hits, and only those
go to an exact join with the list, which removes false positives. DataFrame functions only.

Scale: the filter is one row per block, built by a map-side-combined bitwise OR. It is broadcast
only when its block count, computed from the list's size, stays below ``MAX_BROADCAST_BLOCKS``;
beyond that it is joined by block number, and rows without a URL to look up get numbers of their own.
Rows the filter clears never meet the list.

Defined cases: NULL urls and urls without ``://`` have empty host and path, fit no rule and have
no canonical form, so they are allowed; empty list -> nothing is blocked by it; NULL entries of
the list are ignored and repeats count once; rows that repeat are judged each; columns other
than the named ones pass through unless they use a result's name, which then holds the result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_URL = 16
BLOCK_BITS = 256
WORDS = 4
MAX_BROADCAST_BLOCKS = 1 << 20      # 1M blocks of 32 bytes
_P = "__url_"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for NULL or no ``://``."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """host + path without trailing slashes + sorted query without tracking fields; else NULL."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    fields = F.array_sort(F.filter(F.split(query, "&"),
                                   lambda x: (x != "") & ~x.startswith("utm_") & ~x.startswith("ref=")))
    text = F.concat(url_host(url), F.regexp_replace(url_path(url), "/+$", ""),
                    F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&")))
                    .otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, text)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Number of the longest fitting rule, or NULL. The rules are a short, given list."""
    longest_first = sorted(range(len(rules)), key=lambda i: -len(rules[i][0] + rules[i][1]))
    found = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(i))
             for i in longest_first for h, p, _ in [rules[i]]]
    return F.coalesce(*found) if found else F.lit(None).cast("int")


def _bits(url: Column) -> list[Column]:
    """Per word of a block: the two bits that the URL sets."""
    h = F.xxhash64(F.lit(1), url)
    one = F.lit(1).cast("long")

    def bit(k: int) -> Column:
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), url), F.lit(blocks))


def _no_block() -> Column:
    """A number that no block has, spread over rows without a URL to look up: they are no join key."""
    return -1 - F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))


def bloom_filter(urls: DataFrame, url_col: str, blocks: int) -> DataFrame:
    """(block, w0..w3): the filter of a list of canonical URLs."""
    url = F.col(url_col)
    marks = urls.select(_block(url, blocks).alias("block"),
                        *[b.alias(f"w{k}") for k, b in enumerate(_bits(url))])
    return marks.groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]],
          url_col: str = "url", listed_col: str = "url", listed_verdict: str = "block",
          default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict. ``listed`` holds canonical URLs."""
    results = ["host", "path", "rule", "verdict"]
    keep = [c for c in pages.columns if c not in results]
    canon = _P + "canon"
    urls = listed.select(F.col(listed_col).alias(canon)).where(F.col(canon).isNotNull()).distinct()
    blocks = max(1, math.ceil(urls.count() * BITS_PER_URL / BLOCK_BITS))

    url = F.col(url_col)
    rows = (pages.withColumn(_P + "host", url_host(url)).withColumn(_P + "path", url_path(url))
            .withColumn(_P + "no", matching_rule(F.col(_P + "host"), F.col(_P + "path"), rules))
            .withColumn(canon, F.when(F.col(_P + "no").isNull(), canonical_url(url)))
            .withColumn(_P + "of", F.when(F.col(canon).isNull(), _no_block()).otherwise(_block(F.col(canon), blocks))))
    bloom = bloom_filter(urls, canon, blocks).withColumnRenamed("block", _P + "block")
    bloom = bloom.select(_P + "block", *[F.col(f"w{k}").alias(f"{_P}w{k}") for k in range(WORDS)])
    if blocks <= MAX_BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)
    hit = reduce(lambda a, b: a & b, [F.col(f"{_P}w{k}").bitwiseAND(b) == b
                                      for k, b in enumerate(_bits(F.col(canon)))])
    rows = (rows.join(bloom, F.col(_P + "of") == F.col(_P + "block"), "left")
            .withColumn(_P + "maybe", F.coalesce(F.col(canon).isNotNull() & hit, F.lit(False))))
    listed_as = _P + "listed"
    exact = (rows.where(F.col(_P + "maybe"))
             .join(urls.withColumn(listed_as, F.lit(True)), canon, "left"))
    clear = rows.where(~F.col(_P + "maybe")).withColumn(listed_as, F.lit(None).cast("boolean"))
    both = exact.unionByName(clear)
    names = F.array(*[F.lit(h + p) for h, p, _ in rules]) if rules else F.array(F.lit(""))
    verdicts = F.array(*[F.lit(v) for _, _, v in rules]) if rules else F.array(F.lit(default))
    no = F.col(_P + "no") + 1
    return both.select(
        *[both[f"`{c}`"] for c in keep], F.col(_P + "host").alias("host"), F.col(_P + "path").alias("path"),
        F.when(no.isNotNull(), F.element_at(names, no)).alias("rule"),
        F.when(no.isNotNull(), F.element_at(verdicts, no))
        .when(F.coalesce(F.col(listed_as), F.lit(False)), F.lit(listed_verdict))
        .otherwise(F.lit(default)).alias("verdict"))
