"""Which groups of a table have other rows than before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def digests(df: DataFrame, by: str) -> DataFrame:
    """One row per value of ``by``: its rows and a digest of them that does not depend on their order.

    The digest is the sum of two 64-bit hashes of each row, so repeated rows count and sums combine
    before the shuffle, which moves one row per value and task. NULL is told from every other value
    and from NULL in another column. Columns must be of types that Spark hashes, so no maps.
    """
    columns = [F.col(f"`{c}`") for c in df.columns if c != by]
    values = [*columns, *[c.isNull() for c in columns]]

    def total(seed: int):
        return F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)")).cast("string")

    sums = df.groupBy(F.col(f"`{by}`").alias("value")).agg(
        F.count(F.lit(1)).alias("rows"), total(1).alias("one"), total(2).alias("two")
    )
    return sums.select("value", "rows", F.concat_ws(":", "rows", "one", "two").alias("digest"))
