"""Mix sources to target weights with Sainte-Laguë apportionment.

Each source's documents are laid end to end, in an order drawn by a seed, and cut into blocks of
equally many words. Sainte-Laguë gives each source a whole number of blocks (highest quotients
weight / (2k + 1)), then does the same for the source's shards. A shard that gets q of its n blocks
is taken q // n times in whole, plus q mod n consecutive blocks from a seeded start, around the
end. All of it is window sums: nothing is exploded per block, so block size costs nothing.

Scale: texts are read once, for their word counts; what is shuffled is (id, source, size). A source
of w words has about sqrt(w / 2^15) shards, so a hot source is split and both its number of shards
and the size of one grow with the square root. The tables of sources and of shards are small, but
joined like any other: Spark broadcasts them by their real, stored size.

Defined results: null text has size 0, a null source is a source (the last), null ids take part.
Documents that agree in all columns take neighbouring places in the order. A source without words
gets target 0. No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import WORD, text_of
from salesloom.operators.staging import stage

#: Words per block, and the most times that a document may be taken.
BLOCK = 16
REPEATS = 3
SEED = "mix-1"
SHARD_WORDS = 32768


def sainte_lague(rows: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Apportion ``seats`` (equal within a group ``by``) by ``weight``; adds ``quota``.

    Rounding weight * seats / total gives all but at most n / 2 of the n rows' seats; the rest is
    dealt by highest quotients, or taken back by lowest. Only about 2 n quotients are looked at,
    which suffices: a divisor that makes up n / 2 seats gives a row at most its share of them, and one
    by rounding. Equal quotients go to the smallest key. ``key`` is unique within a group.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    wide = (
        rows.withColumn("_all", F.sum("weight").over(group))
        .withColumn("_rows", F.count(F.lit(1)).over(group))
        .withColumn(
            "_base",
            F.expr(
                "CASE WHEN _all > 0 THEN (2 * CAST(weight AS DECIMAL(19,0)) * CAST(seats AS DECIMAL(18,0))"
                " + _all) div (2 * CAST(_all AS DECIMAL(19,0))) ELSE 0L END"
            ),
        )
        .withColumn("_lack", F.col("seats") - F.sum("_base").over(group))
    )
    tries = wide.where("_lack != 0 AND weight > 0").withColumn(
        "_k", F.explode(F.expr("sequence(0L, CAST(ceil(weight * _rows / (2.0D * _all)) AS BIGINT) + 1L)"))
    )
    adds = F.col("_lack") > 0
    quotient = F.col("weight").cast("double") / F.when(
        adds, 2 * (F.col("_base") + F.col("_k")) + 1
    ).otherwise(2 * (F.col("_base") - F.col("_k")) - 1)
    tries = tries.withColumn("_quotient", quotient).where(adds | (F.col("_k") < F.col("_base")))
    first = [
        F.when(adds, -F.col("_quotient")).otherwise(F.col("_quotient")),
        F.when(adds, F.col(key)).asc(),
        F.when(~adds, F.col(key)).desc(),
    ]
    order = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(*first)
    moved = (
        tries.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= F.abs("_lack"))
        .groupBy(*by, key)
        .agg(F.sum(F.signum("_lack").cast("long")).alias("_moved"))
    )
    return (
        wide.join(moved, [*by, key], "left")
        .withColumn("quota", F.col("_base") + F.coalesce("_moved", F.lit(0)))
        .drop("_all", "_rows", "_base", "_lack", "_moved")
    )


def targets(sources: DataFrame) -> DataFrame:
    """Add ``weight`` and ``target`` to (key, source_size).

    Weights are 1, 2, 3, repeating by key. Targets share the total by weight; one that would pass
    ``REPEATS`` times its source's size stops there and the rest is shared anew. Sorted by size per
    weight, the sources that stop are a prefix, so prefix sums find the level at once. The table of
    sources is one row per source name: a single window over it is meant.
    """
    everything = Window.partitionBy(F.lit(0))
    by_key = everything.orderBy("key")
    # a / 1, a / 2, a / 3 compare exactly as 6a, 3a, 2a
    rising = everything.orderBy(F.col("source_size") * F.lit(6) / F.col("weight"), "key")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(0, Window.unboundedFollowing)
    rows = sources.withColumn("weight", (F.row_number().over(by_key) - 1) % 3 + 1)
    rows = (
        rows.withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_left", F.col("_total") - F.coalesce(REPEATS * F.sum("source_size").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(onward))
    )
    fits = F.col("_left") * F.col("weight") <= REPEATS * F.col("source_size") * F.col("_weights")
    rows = rows.withColumn("_fits", F.max(fits).over(rising))
    level = Window.partitionBy(F.lit(0))
    rows = rows.withColumn(
        "_level", F.max(F.when(F.col("_fits"), F.struct(F.col("_weights"), F.col("_left")))).over(level)
    )
    shared = (F.col("_level._left") * F.col("weight")).cast("double") / F.col("_level._weights")
    return rows.select(
        "key",
        "source_size",
        F.col("weight").cast("long").alias("weight"),
        (~F.col("_fits")).alias("stopped"),
        F.when(F.col("_fits"), shared)
        .otherwise((REPEATS * F.col("source_size")).cast("double"))
        .alias("target"),
        F.col("_level._left").alias("shared_words"),
    )


def _blocks(words: Column) -> Column:
    return F.floor((words + (BLOCK - 1)) / BLOCK).cast("long")


def _draw(*what: Column) -> Column:
    """32 bits of a seeded hash."""
    text = F.concat_ws(":", F.lit(SEED), *what)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target and taken.

    ``row_col`` numbers the rows, for ids that do not: it breaks ties in the order and is returned, too,
    with each row's shard and place there.
    """
    row = [row_col] if row_col else []
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("~"))  # null sorts last
    sizes = stage(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).alias("source"),
            key.alias("key"),
            F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
            *row,
        ),
        "mix_sizes",
    )
    sources = stage(
        targets(sizes.groupBy("key").agg(F.sum("size").alias("source_size"))).withColumn(
            "n_shards", F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("source_size") / SHARD_WORDS))).cast("long")
        ),
        "mix_sources",
    )
    seats = (
        sources.where("NOT stopped")
        .withColumn("seats", F.floor((F.col("shared_words") + BLOCK // 2) / BLOCK).cast("long"))
        .select("key", "weight", "seats")
    )
    source_quota = stage(sainte_lague(seats, "key").select("key", F.col("quota").alias("seats")), "mix_quota")
    sources = stage(sources.join(source_quota, "key", "left"), "mix_source_quota")

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    placed = sizes.join(sources.select("key", "n_shards"), "key").select(
        "doc_id",
        "source",
        "key",
        "size",
        F.md5(F.concat_ws(":", F.lit(SEED), F.lit("order"), name).cast("binary")).alias("place"),
        F.pmod(_draw(F.lit("shard"), name), F.col("n_shards")).alias("shard"),
        *row,
    )
    shards = (
        placed.groupBy("key", "shard")
        .agg(F.sum("size").alias("weight"))
        .join(sources.select("key", "stopped", "seats", "source_size", "target"), "key")
    )
    quotas = sainte_lague(shards.withColumn("seats", F.coalesce("seats", F.lit(0))), "shard", ("key",))
    n = F.col("blocks")
    quotas = stage(
        quotas.withColumn("blocks", _blocks(F.col("weight")))
        .withColumn("quota", F.when(F.col("stopped"), REPEATS * n).otherwise(F.least("quota", REPEATS * n)))
        .withColumn("passes", F.when(n > 0, F.expr("quota div blocks")).otherwise(0))
        .withColumn("rest", F.when(n > 0, F.col("quota") % n).otherwise(0))
        .withColumn(
            "start", F.when(n > 0, _draw(F.lit("start"), F.col("key"), F.col("shard").cast("string")) % n).otherwise(0)
        )
        .select("key", "shard", "source_size", "target", F.col("weight").alias("words"), "blocks", "passes", "rest", "start"),
        "mix_shards",
    )
    along = Window.partitionBy("key", "shard").orderBy("place", "doc_id", "size", *row)
    laid = (
        placed.join(quotas, ["key", "shard"])
        .withColumn("end", F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("begin", F.col("end") - F.col("size"))
    )

    def common(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("end"), high) - F.greatest(F.col("begin"), low))

    stop = F.col("start") + F.col("rest")
    run = common(F.col("start") * BLOCK, F.least(stop, F.col("blocks")) * BLOCK)
    around = common(F.lit(0), (stop - F.col("blocks")) * BLOCK)
    return laid.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + run + around).cast("long").alias("taken"),
        *(["shard", "place", *row] if row else []),
    )
