"""The training-data pipeline: from documents to packed windows.

STAGES are run in order; each works on all rows that the one before kept, written as Parquet and read
again. All but the last return the columns of ``documents``. Ids may be null or repeated: verdicts on
rows are joined by a number that each row gets where its stage stores it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm import line_dedup, mixing, near_dedup, packing, toxicity
from salesloom.llm.common import fresh, read
from salesloom.operators.staging import stage, step

#: A word sequence cannot be tagged in SQL, so the pipeline is tested against plain versions.
ORACLE_SQL = None


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` stored with a number for each row, and that column's name."""
    row = fresh(docs, "row")
    return stage(docs.withColumn(row, F.monotonically_increasing_id()), label), row


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the others go."""
    model = toxicity.fit(*toxicity.training_sample(docs, read(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated cross-site lines; ``n_chars`` follows the text."""
    cleaned = line_dedup.remove_boilerplate(docs, min_words=1).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, null ids last."""
    rows, row = numbered(docs, "near_rows")
    groups = near_dedup.dedup(rows, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    ids = rows.select(row, F.col("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull(), "id", row))[row].alias(row)
    kept = stage(groups.join(ids, row).groupBy("component_id").agg(first).select(row), "near_kept")
    # the same join at every size: the table of kept rows grows with the texts
    return rows.join(kept.hint("merge"), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def whole_copies(mixed: DataFrame, row: str) -> DataFrame:
    """``row`` and ``copies`` of rows with words: what the mix takes, rounded to whole documents.

    Along the seeded order one copy more or less is taken until a source has its target, to within half
    of the document that it stops in. Prefix sums run within shards, whose sums are few.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~"))
    copies = F.expr("(2 * taken + size) div (2 * size)")
    near = stage(mixed.where("size > 0").withColumn("key", key).withColumn("copies", copies), "mix_near")
    lack = near.groupBy("key").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("lack"))
    able = near.join(lack, "key").where(f"(lack > 0 AND copies < {mixing.REPEATS}) OR (lack < 0 AND copies > 0)")
    before = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = able.groupBy("key", "shard").agg(F.sum("size").alias("words"))
    shards = shards.select("key", "shard", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    along = Window.partitionBy("key", "shard").orderBy("place", row).rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("offset") + F.sum("size").over(along) - F.col("size") / 2
    moved = able.join(shards, ["key", "shard"]).where("offset <= abs(lack)").withColumn("middle", middle)
    moved = moved.where("middle <= abs(lack)").select(row, F.signum("lack").cast("long").alias("moved"))
    met = near.select(row, "copies").join(moved, row, "left")
    return met.select(row, (F.col("copies") + F.coalesce("moved", F.lit(0))).alias("copies"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each whole, so that sources keep their targets."""
    rows, row = numbered(docs, "mix_rows")
    taken = whole_copies(mixing.mix(rows, row_col=row), row)
    taken = stage(taken.where("copies > 0"), "mix_copies")
    left, right = rows.alias("d"), taken.hint("merge").alias("t")
    met = left.join(right, F.col(f"d.{row}") == F.col(f"t.{row}"))
    repeat = F.explode(F.sequence(F.lit(1).cast("long"), F.col("t.copies"))).alias(fresh(rows, "copy"))
    return met.select("d.*", repeat).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", keep_one_of_each_group),
    ("mix_sources", mix_sources),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; what each returns is stored for the next.

    What a stage stores on its way is removed as soon as its result is stored.
    """
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        with step(spark, name) as keep:
            docs = keep(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
