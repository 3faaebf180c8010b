"""Row shapes: renaming projections, flattened structs, tiers and distinct members."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Iterable[tuple[str, str | Column]]) -> DataFrame:
    """Output columns in order, each from an input field (dots reach into structs) or a Column."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns]
    )


def flatten_struct(
    df: DataFrame, struct: str, renamed: Mapping[str, str] | None = None
) -> DataFrame:
    """Fields of a struct as columns of their own, in place of the struct."""
    renamed = renamed or {}
    fields = df.schema[struct].dataType.names
    return df.select(
        *[c for c in df.columns if c != struct],
        *[F.col(f"{struct}.`{f}`").alias(renamed.get(f, f)) for f in fields],
    )


def tier(c: Column, bounds: Sequence[tuple[int, str]], lowest: str) -> Column:
    """Label of the first bound that the value exceeds; NULL gets the lowest label."""
    labels = [F.when(c > bound, F.lit(label)) for bound, label in bounds]
    return F.coalesce(*labels, F.lit(lowest))


def distinct_members(df: DataFrame, columns: Iterable[tuple[str, str | Column]]) -> DataFrame:
    """Distinct rows of a projection."""
    return project(df, columns).distinct()


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Rows with at least one value."""
    return df.dropna(how="all")
