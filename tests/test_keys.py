import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesloom.operators import keys, shape


def hot_rows(n=6000):
    """A third of the rows share one key, another part has none."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{rng.randrange(400)}"
        rows.append((i, key, rng.randrange(50)))
    return rows


def test_dedup_first_equals_brute_force(spark):
    rows = hot_rows()
    best = {}
    for i, key, value in rows:
        if key not in best or (value, i) > best[key]:
            best[key] = (value, i)
    df = spark.createDataFrame(rows, "i int, k string, v int").repartition(8)
    got = keys.dedup_first(df, ["k"], [F.col("v").desc(), F.col("i").desc()])
    assert {r.k: (r.v, r.i) for r in got.collect()} == best
    assert got.count() == len(best)


def test_dedup_first_limits_groups_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame(hot_rows(), "i int, k string, v int")
    keys.dedup_first(df, ["k"], [F.col("v").desc()]).explain()
    plan = capsys.readouterr().out
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_global_row_number_equals_window(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(hot_rows(), "i int, k string, v int").repartition(8)
        got = keys.global_row_number(df, ["k"], "n")
        window = Window.orderBy(F.col("k").asc_nulls_first(), "i", "v")
        expected = df.withColumn("n", F.row_number().over(window))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(
            map(tuple, expected.collect()), key=str
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_global_row_number_spreads_a_hot_value(spark):
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        df = spark.createDataFrame(hot_rows(), "i int, k string, v int").repartition(8)
        sort = [F.col(c).asc_nulls_first() for c in ("k", "i", "v")]
        sizes = df.repartitionByRange(*sort).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < df.count() / 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_global_row_number_needs_no_single_partition(spark, capsys):
    df = spark.createDataFrame(hot_rows(), "i int, k string, v int")
    keys.global_row_number(df, ["k"], "n").explain()
    assert "SinglePartition" not in capsys.readouterr().out


def test_global_row_number_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert keys.global_row_number(empty, ["k"], "n").count() == 0


def test_surrogate_key(spark):
    df = spark.createDataFrame([(7, "b"), (None, "a"), (None, "c")], "id bigint, name string")
    got = keys.surrogate_key(df, "id", ["name"], "sk")
    assert got.columns == ["sk", "id", "name"]
    assert {(r.name, r.sk) for r in got.collect()} == {("a", 100001), ("b", 7), ("c", 100003)}


def test_orphans_and_duplicates(spark):
    fact = spark.createDataFrame(hot_rows(), "i int, k string, v int")
    dim = spark.createDataFrame([(f"k{i}",) for i in range(400)], "key string")
    assert [tuple(r) for r in keys.orphans(fact, "k", dim, "key").collect()] == [("hot", 2000)]
    assert keys.duplicate_keys(dim, ["key"]).count() == 0
    assert keys.assert_unique(dim, ["key"]) is dim
    with pytest.raises(ValueError, match="hot"):
        keys.assert_unique(fact.where("k = 'hot'"), ["k"])


def test_shapes(spark):
    df = spark.sql("""select 1 as id, named_struct('a', 2, 'b', array('x')) as s
        union all select 2, null""")
    flat = shape.flatten_struct(df, "s", {"b": "list"})
    assert flat.columns == ["id", "a", "list"]
    assert sorted(map(tuple, flat.collect())) == [(1, 2, ["x"]), (2, None, None)]

    tiers = spark.sql("select * from values (11), (10), (6), (5), (null) as t(v)")
    label = shape.tier(F.col("v"), ((10, "high"), (5, "middle")), "low")
    assert [r[0] for r in tiers.select(label).collect()] == [
        "high", "middle", "middle", "low", "low",
    ]
    blanks = spark.createDataFrame([(None, None), (None, "x")], "a string, b string")
    assert shape.drop_blank_rows(blanks).count() == 1
