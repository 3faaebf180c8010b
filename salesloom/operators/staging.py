"""Intermediate tables in the folder that every executor shares."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from salesloom.sources import files


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, one in the session's warehouse.

    The warehouse holds the tables, so executors share it too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return folder.rstrip("/")


def _staged(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}"


# The folders of the steps that are under way, the innermost last.
_steps: list[str] = []


def staged_path(spark: SparkSession, label: str) -> str:
    """A new folder for what an application stores by itself; ``clear_staged`` removes it, too."""
    return f"{_steps[-1] if _steps else _staged(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Unlike a cache it survives lost executors and is computed once. Unlike a checkpoint it
    carries its real size, by which Spark picks broadcast joins, and it can be read by column.
    ``clear_staged`` removes what an application has staged.
    """
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def step(spark: SparkSession, label: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A step of a job: what it stages is removed when it ends, but for its result.

    Gives a function that stores the result, which is to be called before the step ends.
    """
    target, folder = staged_path(spark, f"{label}_result"), staged_path(spark, label)

    def keep(df: DataFrame) -> DataFrame:
        df.write.parquet(target)
        return spark.read.schema(df.schema).parquet(target)

    _steps.append(folder)
    try:
        yield keep
    finally:
        _steps.remove(folder)
        files.remove(spark, folder)


def clear_staged(spark: SparkSession) -> None:
    """Remove the tables that this application has staged; call it when its results are stored."""
    files.remove(spark, _staged(spark))
