import re

from pyspark.sql import functions as F

from stratum.llm import url_filter
from stratum.llm.registry import URL_RULES


def expected(url, listed):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest)[0]):])[0]
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    query = re.match(r"[^?#]*(?:\?([^#]*))?", rest)[1] or ""
    fields = sorted(f for f in query.split("&") if f and not f.startswith(("utm_", "ref=")))
    canon = host + path.rstrip("/") + ("?" + "&".join(fields) if fields else "")
    return host, path, None, "block" if canon in listed else "allow"


URLS = ["http://A.example.NET/en/1", "http://a.example.net/EN/1", "https://example.com/de/", "https://example.com/de",
        "https://notexample.com/de/x", "http://x.org/fr/1?utm_source=a", "http://x.org/frx", "http://net/", "http://net",
        "http://x.net?q#f", "ftp://b.org/a/?b=2&a=1&utm_x=3#t", "http://b.org/a?a=1&b=2", "http://b.org/a", "no url",
        "", None, "a://b://c.org/d", "http://B.ORG/a///", "http://b.org/" + "x" * 200_000, "http://é.org/ü", "http://"]


def test_rules_list_and_edges(spark):
    listed = {"b.org/a?a=1&b=2", "c.org/d", "b.org/a", "é.org/ü"}
    pages = spark.createDataFrame([(i, u, 5) for i, u in enumerate(URLS * 2)], "page_id long, url string, block int")
    pages = pages.withColumn("rule", F.lit("clash"))
    rows = spark.createDataFrame([(u,) for u in [*listed, None, "b.org/a"]], "url string")
    found = url_filter.judge(pages, rows, URL_RULES).collect()
    assert len(found) == len(URLS) * 2
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == expected(r.url, listed), r.url


def test_bloom_filter_has_no_false_negative_and_few_false_positives(spark):
    n, blocks = 20_000, 20_000 * url_filter.BITS_PER_URL // url_filter.BLOCK_BITS
    urls = spark.range(2 * n).select(F.concat(F.lit("h.org/"), "id").alias("url"), (F.col("id") < n).alias("listed"))
    bloom = url_filter.bloom_filter(urls.where("listed"), "url", blocks)
    bits = url_filter._bits(F.col("url"))
    hit = F.lit(True)
    for k, b in enumerate(bits):
        hit = hit & (F.col(f"w{k}").bitwiseAND(b) == b)
    rows = (urls.withColumn("block", url_filter._block(F.col("url"), blocks)).join(bloom, "block", "left")
            .groupBy("listed").agg(F.count_if(hit).alias("hits")).collect())
    hits = {r.listed: r.hits for r in rows}
    assert hits[True] == n
    assert hits[False] < 0.03 * n


def test_empty_tables(spark):
    none = spark.createDataFrame([], "url string")
    some = spark.createDataFrame([("http://q.org/1",)], "url string")
    assert url_filter.judge(none, some, URL_RULES).collect() == []
    assert [r.verdict for r in url_filter.judge(some, none, URL_RULES).collect()] == ["allow"]
    assert [r.verdict for r in url_filter.judge(some, none, []).collect()] == ["allow"]


def test_main_path_has_no_python(spark):
    some = spark.createDataFrame([("http://q.org/1",)], "url string")
    plan = url_filter.judge(some, some, URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rows_without_a_url_to_look_up_are_no_join_key(spark, monkeypatch):
    """Beyond the bound of the broadcast the filter is joined by block: rows decided by a rule, or without
    a URL, each get a number that no block has, and results stay the same."""
    listed = {"b.org/a?a=1&b=2", "c.org/d", "b.org/a", "é.org/ü"}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "page_id long, url string")
    rows = spark.createDataFrame([(u,) for u in listed], "url string")
    monkeypatch.setattr(url_filter, "MAX_BROADCAST_BLOCKS", 0)
    for r in url_filter.judge(pages, rows, URL_RULES).collect():
        assert (r.host, r.path, r.rule, r.verdict) == expected(r.url, listed), r.url
    spread = spark.range(1000).select(url_filter._no_block().alias("n"))
    assert spread.distinct().count() > 990 and spread.where("n >= 0").count() == 0
