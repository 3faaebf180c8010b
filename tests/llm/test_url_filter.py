"""URL parts and rules against plain code; the regression on URLs that it has not seen."""

import re

import oracle
from pyspark.sql import functions as F

from salesloom.llm import url_filter
from salesloom.llm.queries import QUERIES, URL_RULES

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.NET/en/1?x#y", "http://net/", "http://net", "ftp://x.org/fr/?q",
    "http://ÄB.org/fr", "a://b://c/d", "http://example.com/de/\nx", "http://badexample.net/en/", "http://x.notorg/fr/a",
    "http://h?q=/en/", "http://h#f/en/", "http://" + "l" * 20_000 + ".net/" + "p" * 100_000, "http://[::1]:80/fr/",
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [(n + p, v) for n, p, v in URL_RULES if (host == n or host.endswith("." + n)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def judged(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    parts = df.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    return url_filter.judge(parts, URL_RULES, url_filter.rule_labels(parts, URL_RULES)).orderBy("page_id").collect()


def test_parts_and_rules(spark):
    for url, r in zip(URLS, judged(spark, URLS)):
        assert (r["host"], r["path"]) == plain(url)
        rule, verdict = ruled(r["host"], r["path"])
        assert r["rule"] == rule and (r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block"))


def test_whole_table(spark):
    sf = f"{oracle.TESTDATA}/sf0.01"
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op3_url_filter"](spark, sf).collect()
    assert len(got) == len(urls)
    for r in got:
        rule, verdict = ruled(*plain(urls[r["page_id"]]))
        assert r["rule"] == rule and (rule is None or r["verdict"] == verdict)
    again = {r["page_id"]: r["verdict"] for r in QUERIES["op3_url_filter"](spark, sf).collect()}
    assert again == {r["page_id"]: r["verdict"] for r in got}


def test_learns_unseen_urls(spark):
    """Labels by rules, learnt from two thirds and tried on the rest without the rules."""
    sf = f"{oracle.TESTDATA}/sf0.1"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    parts = pages.select(url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    labels = url_filter.rule_labels(parts, URL_RULES)
    fold = F.crc32(F.concat("host", "path").cast("binary")) % 3
    tried = labels.where(fold == 1).withColumnRenamed("verdict", "truth")
    rows = url_filter.judge(tried, [], labels.where(fold != 1)).collect()
    assert sum(r["truth"] == r["verdict"] for r in rows) >= 0.95 * len(rows) and len(rows) > 100


def test_few_labels_and_no_rows(spark):
    assert {r["verdict"] for r in judged(spark, ["http://a.com/en/", None])} == {"allow"}
    assert {r["verdict"] for r in judged(spark, ["http://a.net/x", "http://a.com/en/"])} == {"block"}
    assert judged(spark, []) == []


def test_extra_columns_of_any_name(spark):
    urls = [u for u in URLS if u] + ["http://a.com/en/", "http://a.net/x"]
    names = ["ngrams", "terms", "prediction", "probability", "rawPrediction", "Label", "a.b"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    parts = df.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    labels = url_filter.rule_labels(parts, URL_RULES)
    extra = parts.select("*", *[F.lit(n).alias(n) for n in (*names, "rule", "Verdict")])
    for tried in (labels, labels.where("verdict = 'block'")):  # learnt, and one verdict only
        got = url_filter.judge(extra, URL_RULES, tried)
        assert got.columns == ["page_id", "host", "path", *names, "rule", "verdict"]
        plain_rows = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(parts, URL_RULES, tried).collect()}
        for r in got.collect():
            assert [r[n] for n in names] == names and (r["rule"], r["verdict"]) == plain_rows[r["page_id"]]
