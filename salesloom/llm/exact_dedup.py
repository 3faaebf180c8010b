"""Exact dedup against a persistent digest index.

The index is a Parquet table, bucketed and sorted by digest, with one row per text ever seen. A
batch is reduced to one row per digest, a sort-merge anti-join with the index leaves the digests
that are new, and those are appended. The index is never shuffled: its buckets meet the batch's.
Everything is DataFrame code; only digests and ids are shuffled, never texts.

Defined results: a null text counts as empty. Texts are equal when they agree after each run of
white space became one space. Of equal texts the smallest id stays; null ids only stay where a
group has no other. Rows that repeat an id and its text are one document and share its verdict.
An empty batch leaves the index as it is. Other columns are ignored, whatever their names.

Recovery: an index row depends on nothing but its digest, so a batch that stopped half-way is run
again; what was appended before is then found and not appended twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import SPACE, text_of
from salesloom.operators.staging import shared_folder, stage


def text_digest(column: str = "text"):
    """SHA-256 of the text in UTF-8, white space normalised, as 32 bytes."""
    normal = F.regexp_replace(text_of(column), SPACE, " ")
    return F.unhex(F.sha2(normal.cast("binary"), 256))


def open_index(spark: SparkSession, path: str, buckets: int = 64) -> str:
    """Name of the index table at ``path``; made if it is not there, attached again if it is."""
    name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return name


def append_new(batch: DataFrame, index: str, buckets: int = 64) -> None:
    """Append the digests of ``batch`` (digest, keep_id) that the index does not have."""
    spark = batch.sparkSession
    known = spark.table(index).select("digest").hint("merge")
    new = batch.select("digest", "keep_id").join(known, "digest", "left_anti")
    new = stage(new, "new_digests")  # a table cannot be read and written by one job
    new.repartition(buckets, "digest").sortWithinPartitions("digest").write.insertInto(index)
    spark.catalog.refreshTable(index)


def dedup(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = 64,
) -> DataFrame:
    """Add ``docs`` to the index at ``path``; one verdict per row.

    Returns doc_id, keep_id (the document that stays, maybe of an earlier batch), group_size (equal
    texts in this batch), kept and text_sha256.
    """
    spark = docs.sparkSession
    index = open_index(spark, path, buckets)
    digests = stage(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("digest")),
        "digests",
    )
    groups = stage(
        digests.groupBy("digest").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        ),
        "digest_groups",
    )
    append_new(groups, index, buckets)
    stored = spark.table(index).hint("merge")
    verdicts = stage(groups.drop("keep_id").join(stored, "digest"), "digest_verdicts")
    # Both sides are shuffled, so adaptive execution can split the rows of a hot digest.
    return digests.join(verdicts, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def new_index_path(spark: SparkSession) -> str:
    """A folder for an index that is to be built from nothing."""
    return f"{shared_folder(spark)}/digest_index/{uuid.uuid4().hex}"
