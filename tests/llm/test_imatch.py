"""Fingerprints: neighbours by id, equal texts, odd input. The whole query has an SQL twin."""

import oracle
import pytest
from pyspark.sql import functions as F

from salesloom.llm import imatch

DOCS = "doc_id long, text string, bucket int, term string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS)


@pytest.mark.parametrize("partitions", [1, 7])
def test_next_document(spark, partitions):
    rows = [(i * i % 997, f"text {i}") for i in range(300)] + [(None, "null id"), (None, "another")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = imatch.with_next(frame(spark, rows)).where(~F.col("guest")).select("doc_id", "text", "next_text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = {(i, t): order[(k + 1) % len(order)][1] for k, (i, t) in enumerate(order)}
    assert len(got) == len(rows) and all(expected[r["doc_id"], r["text"]] == r["next_text"] for r in got)


def test_edited_is_near_and_next_is_not(spark):
    docs = spark.read.parquet(f"{oracle.TESTDATA}/sf0.1/documents.parquet")
    got = imatch.fingerprints(docs).where("n_chars > 500").agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert got[0] > 0.4 and got[1] < 0.15


def test_equal_texts_and_odd_rows(spark):
    long = " ".join(f"w{i % 50}x{i % 7}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "a"), (4, "A b c d e"), (5, "a B c d e"), (None, "a b"), (6, long), (7, long)]
    rows += [(i, f"a b q{i % 5} r{i % 3} s{i % 4}") for i in range(10, 40)] + [(40, "twin"), (40, "twin")]
    got = imatch.fingerprints(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[6]["fingerprint"] == by[7]["fingerprint"]
    assert by[1]["near_next"] == 1.0 and by[6]["near_next"] == 1.0 and by[1]["n_chars"] == 0
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_one_and_no_rows(spark):
    only = imatch.fingerprints(frame(spark, [(1, "abcdefgh")])).first()
    assert only["near_next"] == 1.0 and only["edited_sha256"] == imatch.fingerprints(frame(spark, [(2, "abcdefab")])).first()["edited_sha256"]
    assert imatch.fingerprints(frame(spark, [])).count() == 0
