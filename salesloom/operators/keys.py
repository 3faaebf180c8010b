"""Keys: deduplication, global numbering, surrogate keys and key checks."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.operators.staging import stage

SURROGATE_OFFSET = 100000  # fixed value: surrogate keys start above the source's own ids


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order; NULL keys form groups as well.

    Filtering ``row_number`` at 1 lets Spark put a group limit below the shuffle: each input
    partition sends one row per key at most, so a hot key never gathers in one task.
    """
    best = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def global_row_number(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``row_number() over (order by ...)`` of the whole table without one task sorting it all.

    Rows are range-partitioned on the order columns, with the other columns breaking ties, so
    that equal order values spread over partitions too. ``monotonically_increasing_id`` over the
    sorted partitions packs (partition, position) into one number. The sorted rows are written
    once; then the number of a row is its position plus the rows of all partitions before it.
    """
    ties = [c for c in df.columns if c not in order]
    sort = [F.col(c).asc_nulls_first() for c in (*order, *ties)]
    placed = (
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, "global-row-number")

    partition = F.shiftright("_place", 33)
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition, so what reaches the driver does not grow with the rows.
    sizes = placed.groupBy(partition.alias("_partition")).count().orderBy("_partition").collect()
    starts = [0, *accumulate(row["count"] for row in sizes)]
    offsets = df.sparkSession.createDataFrame(
        [(row["_partition"], start) for row, start in zip(sizes, starts)],
        "_partition bigint, _before bigint",
    )
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")  # one row per partition
        .withColumn(name, F.col("_before") + position + 1)
        .select(*df.columns, name)
    )


def surrogate_key(
    df: DataFrame, source_id: str, order: Sequence[str], name: str, offset: int = SURROGATE_OFFSET
) -> DataFrame:
    """The source's id, or a number above ``offset`` by global order where it has none."""
    numbered = global_row_number(df, order, "_number")
    key = F.coalesce(F.col(source_id), F.col("_number") + F.lit(offset))
    return numbered.select(key.alias(name), *df.columns)


def orphans(fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Fact keys that the dimension lacks, with their row counts. NULL keys refer to nothing.

    Both sides shrink to one row per key before the join.
    """
    counted = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = dimension.select(F.col(dimension_key).alias(key)).distinct()
    return counted.join(known, key, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, after checking that no key repeats."""
    repeated = duplicate_keys(df, keys).take(3)
    if repeated:
        raise ValueError(f"repeated {', '.join(keys)}: {[tuple(r)[:-1] for r in repeated]}")
    return df
