"""What several operators share: reading tables, words, safe names."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
#: A word is a longest run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of the folder, wherever Spark can read it."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that starts with ``name`` and that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once per application.

    Python workers import it by name, wherever the driver found it. The archive stands in the
    driver's temporary folder only until Spark has taken it; executors fetch it from Spark.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="salesloom-code-"), "salesloom_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
