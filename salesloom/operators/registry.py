"""Surrogate keys that last: a stored registry gives each natural key its number once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.operators.keys import SURROGATE_OFFSET, global_row_number
from salesloom.operators.staging import stage
from salesloom.sources import files

# Folders of a registry: numbers by the build that gave them, and the builds that count.
NUMBERS, COMMITS = "numbers", "commits"
COMMIT = "build string, last bigint"
BUILD, NUMBER = "registry_build", "registry_number"


def read_registry(spark: SparkSession, path: str) -> DataFrame | None:
    """Natural keys and their ``registry_number``; None before the first build.

    What a build left that was not committed is not read.
    """
    if not files.exists(spark, f"{path}/{COMMITS}"):
        return None
    numbers = spark.read.parquet(f"{path}/{NUMBERS}").withColumn(BUILD, F.col(BUILD).cast("string"))
    builds = spark.read.schema(COMMIT).parquet(f"{path}/{COMMITS}").select(F.col("build").alias(BUILD))
    return numbers.join(builds, BUILD, "left_semi").drop(BUILD)


def _same(left: DataFrame, right: DataFrame, natural: Sequence[str]) -> Column:
    """Equality of natural keys; NULL is a value of its own."""
    condition = F.lit(True)
    for c in natural:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def register(members: DataFrame, path: str, natural: Sequence[str]) -> DataFrame:
    """Give the natural keys that the registry lacks the next numbers, by their order.

    Only new keys are numbered and written; what is there is never touched. A build counts once its
    row is in the list of commits, so one that stops before has given no number. One build at a time.
    """
    spark = members.sparkSession
    known = read_registry(spark, path)
    new, last = members.select(*natural).distinct(), 0
    if known is not None:
        new = new.join(known, _same(new, known, natural), "left_anti")
        last = spark.read.schema(COMMIT).parquet(f"{path}/{COMMITS}").agg(F.max("last")).first()[0]
    new = stage(new, "unregistered")
    if new.isEmpty():
        nothing = T.StructType([*new.schema, T.StructField(NUMBER, T.LongType())])
        return spark.createDataFrame([], nothing) if known is None else known
    build = uuid.uuid4().hex
    numbers = global_row_number(new, natural, "_place").withColumn(NUMBER, F.col("_place") + F.lit(last))
    target = f"{path}/{NUMBERS}/{BUILD}={build}"
    numbers.select(*natural, NUMBER).write.parquet(target)
    last += spark.read.parquet(target).count()
    spark.createDataFrame([(build, last)], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/{COMMITS}")
    return read_registry(spark, path)


def lasting_key(
    df: DataFrame,
    path: str,
    source_id: str,
    natural: Sequence[str],
    name: str,
    offset: int = SURROGATE_OFFSET,
) -> DataFrame:
    """The source's id, or a number above ``offset`` that a natural key keeps from build to build.

    Rows of one natural key without an id share a number, even if it is NULL. The registry under
    ``path`` grows by the keys that are new. The first build numbers keys as ``surrogate_key`` does.
    """
    df = stage(df, "members")  # read twice below, computed once
    known = register(df.where(F.col(source_id).isNull()), path, natural)
    met = df.join(known, _same(df, known, natural), "left")
    key = F.coalesce(df[source_id], known[NUMBER] + F.lit(offset))
    return met.select(key.alias(name), *[df[c] for c in df.columns])
