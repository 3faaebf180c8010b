"""Connected components of a graph as DataFrames, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.staging import stage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Edges with the least node that touches ``u``.

    Minima are combined before the shuffle. They are stored, so that the join shuffles both sides by
    itself and adaptive execution can split the edges of a hub.
    """
    least = stage(edges.groupBy("u").agg(F.min("v").alias("least")), "component_least")
    return edges.join(least, "u")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v); the root is the least node reachable.

    Each round hangs every node's larger neighbours on its least neighbour, then its smaller ones.
    The number of rounds grows with the logarithm of the longest path. Each is stored, so lineage stays
    short and a lost executor costs one round at most. Nodes may be of any type that can be ordered;
    nulls and loops are dropped.
    """
    now = stage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u != v")
        .distinct(),
        "component_edges",
    )
    mark = None
    for _ in range(rounds):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(
            _least_neighbour(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
            .where("u != v")
            .distinct(),
            "component_large",
        )
        small = _least_neighbour(large)
        small = small.select("u", F.col("least").alias("v")).unionAll(
            small.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        )
        now = stage(small.distinct(), "component_edges")
        # done when a round changes nothing: compared by count and an order-free checksum
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
