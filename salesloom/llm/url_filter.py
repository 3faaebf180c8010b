"""Judge URLs: rules first, else logistic regression on hashed character n-grams of host and path.

A rule (host, path, verdict) fits its host and all subdomains if the URL's path starts with the
rule's; of several the longest wins. The regression learns from a small labelled table of (host, path,
verdict); ``rule_labels`` makes one of the URLs that rules decide, so that the verdicts carry over to
URLs like them. N-grams come from a look-ahead pattern, are hashed and weighed on the JVM.

Scale: judging is one pass without a shuffle. The labelled table is a bounded sample (``SAMPLE``
distinct URLs with the smallest hash). Rules are a list of the caller's, part of the expression.

Defined results: a null URL and one without "://" have an empty host and path and are judged by the
method, by its intercept. Without labels the verdict is allow; with one verdict only it is that one.
Other columns stay, whatever their names, but for those called ``rule`` and ``verdict`` in any case: the
results take their place. Repeated rows are judged each.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ascii_lower, fresh
from salesloom.operators.staging import stage

Rule = tuple[str, str, str]
#: Distinct labelled URLs that are learnt from, at most.
SAMPLE = 20_000
SLOTS = 1 << 14
NGRAMS = (3, 4)


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; equal lengths go by the rule's text."""
    rule = verdict = F.lit(None).cast("string")
    for name, start, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _with_ngrams(urls: DataFrame, column: str) -> DataFrame:
    """Add a column of n-grams: those of the host, with its ends marked, and of the path."""

    def grams(mark: str, text: Column, n: int) -> Column:
        found = F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1))
        return F.transform(found, lambda g: F.concat(F.lit(mark), g))

    host = F.when(F.col("host") != "", F.concat(F.lit("^"), "host", F.lit("$"))).otherwise("")
    parts = [grams("h", host, n) for n in NGRAMS] + [grams("p", F.col("path"), n) for n in NGRAMS]
    return urls.withColumn(column, F.concat(*parts))


def rule_labels(urls: DataFrame, rules: list[Rule], sample: int = SAMPLE) -> DataFrame:
    """A labelled table of the distinct (host, path) that rules decide, ``sample`` at most."""
    _, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    return (
        urls.select("host", "path", verdict.alias("verdict"))
        .where(F.col("verdict").isNotNull())
        .distinct()
        .orderBy(F.xxhash64("host", "path"), "host", "path")
        .limit(sample)
    )


def judge(urls: DataFrame, rules: list[Rule], labelled: DataFrame) -> DataFrame:
    """Add ``rule`` and ``verdict`` to rows with host and path; other columns stay."""
    others = [F.col(f"`{c}`") for c in urls.columns if c.lower() not in ("rule", "verdict")]
    urls = urls.select(*others)
    labelled = stage(labelled.select("host", "path", "verdict"), "url_labels")
    verdicts = sorted(r["verdict"] for r in labelled.select("verdict").distinct().collect())
    rule, decided = longest_rule(rules, F.col("host"), F.col("path"))
    if len(verdicts) < 2:
        learnt = F.lit(verdicts[0] if verdicts else "allow")
        return urls.withColumn("rule", rule).withColumn("verdict", F.coalesce(decided, learnt))
    names = ("ngrams", "terms", "prediction", "probability", "rawPrediction")
    ngrams, features, prediction, probability, raw = (fresh(urls, name) for name in names)
    terms = HashingTF(inputCol=ngrams, outputCol=features, numFeatures=SLOTS, binary=True)
    # one sorted partition of a bounded table: sums run in one order, so reruns agree
    rows = _with_ngrams(labelled, ngrams).select(
        "host", "path", ngrams, (F.col("verdict") == "block").cast("double").alias("label")
    )
    rows = rows.coalesce(1).sortWithinPartitions("host", "path")
    model = LogisticRegression(
        featuresCol=features,
        labelCol="label",
        predictionCol=prediction,
        probabilityCol=probability,
        rawPredictionCol=raw,
        maxIter=40,
        regParam=1e-3,
        standardization=False,
    ).fit(terms.transform(rows))
    judged = model.transform(terms.transform(_with_ngrams(urls, ngrams)))
    learnt = F.when(F.col(prediction) == 1.0, "block").otherwise("allow")
    return judged.select(*others, rule.alias("rule"), F.coalesce(decided, learnt).alias("verdict"))
