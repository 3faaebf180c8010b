"""Whole folders of any file system that Spark can write: test, move, swap and remove."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """File system and path, as Spark itself resolves them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if it is not there."""
    system, place = _at(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    system, place = _at(spark, path)
    _, goal = _at(spark, target)
    system.mkdirs(goal.getParent())
    if not system.rename(place, goal):
        raise OSError(f"cannot move {path} to {target}")


def beside(path: str) -> str:
    """A fresh folder next to ``path`` that Spark's readers pass over."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name.replace('=', '-')}-{uuid.uuid4().hex}"


def swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the finished folder ``fresh`` in the place of ``path``; the old one goes last."""
    old = beside(path)
    if exists(spark, path):
        move(spark, path, old)
    move(spark, fresh, path)
    remove(spark, old)
