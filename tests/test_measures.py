import random
import time
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from salesloom.functions import measures

NANO = Decimal("0.000000001")


def test_cycle_days(spark):
    df = spark.sql("""
        select timestamp'2024-01-01 15:00:00' as a, timestamp'2024-02-09 10:00:00' as won,
            cast(null as timestamp) as lost""")
    row = df.select(
        measures.cycle_days(F.col("a"), F.col("won"), F.col("lost")).alias("elapsed"),
        measures.cycle_days(F.col("a"), F.col("won"), mode="calendar").alias("calendar"),
        measures.cycle_days(
            F.col("a"), F.col("lost"), as_of=F.lit("2024-01-03 15:00:00").cast("timestamp")
        ).alias("still_open"),
    ).first()
    assert tuple(row) == (38, 39, 2)


def test_month_of(spark):
    row = spark.sql("select timestamp'2024-02-29 23:59:59' t, date'2024-12-31' d").select(
        measures.month_of(F.col("t")).cast("string"), measures.month_of(F.col("d")).cast("string")
    )
    assert tuple(row.first()) == ("2024-02-01", "2024-12-01")


def test_ratio_is_exact(spark):
    rng = random.Random(5)

    def amount(low, high):
        return Decimal(rng.randint(low, high)) / 10 ** rng.randint(0, 4)

    pairs = [(amount(-(10**14), 10**14), amount(1, 10**12)) for _ in range(5000)]
    pairs += [(amount(-(10**9), 10**9), amount(1, 10**5) * rng.choice((1, -1))) for _ in range(5000)]
    pairs += [(Decimal(n) / 10**4, Decimal(d)) for n in range(-9, 10) for d in (-16, -3, 3, 16, 5 * 10**4)]
    pairs += [(Decimal(n), Decimal(d)) for n, d in [(1, 2 * 10**9), (-3, 2 * 10**9), (-7, 3)]]
    pairs += [(Decimal(10**15), Decimal("0.01")), (Decimal(1), 3 * NANO)]
    df = spark.createDataFrame(pairs, "n decimal(38,9), d decimal(38,9)")
    rows = df.select(
        "n",
        "d",
        measures.ratio(F.col("n"), F.col("d")).alias("ratio"),
        measures.weighted_value(F.col("n"), F.lit(35)).alias("weighted"),
    ).collect()
    with localcontext() as context:
        context.prec = 80
        for row in rows:
            assert row.ratio == (row.n / row.d).quantize(NANO, ROUND_HALF_UP)
            assert row.weighted == (row.n * 35 / 100).quantize(NANO, ROUND_HALF_UP)


def test_ratio_or_zero_keeps_null_numerators(spark):
    df = spark.sql("""
        select * from values (1.0, 0.0), (1.0, null), (null, 2.0), (1.0, 2.0), (1.0, -2.0)
        as t(n, d)""")
    got = [r[0] for r in df.select(measures.ratio_or_zero(F.col("n"), F.col("d"))).collect()]
    assert got == [0, 0, None, Decimal("0.5"), 0]


def test_fill_zero(spark):
    df = spark.sql("select cast(null as decimal(18,2)) as a, 3 as b")
    row = df.select(measures.fill_zero(F.col("a")), measures.fill_zero(F.col("b"))).first()
    assert tuple(row) == (0, 3)


def test_wide_amounts_are_exact_or_null(spark):
    """From 1e-9 to 1e28 a result is right, or NULL where it does not fit; never another number."""
    rng = random.Random(9)

    def amount():
        size = rng.randint(-9, 28)
        return (Decimal(rng.randint(1, 10**38 - 1)).scaleb(size - 38)).quantize(NANO)

    with localcontext() as context:
        context.prec = 80
        pairs = [(amount() * rng.choice((1, -1)), amount() or NANO, rng.randint(-(10**12), 10**12)) for _ in range(4000)]
        edges = [Decimal(10) ** k for k in range(-9, 29)]
        pairs += [(a, b, 10**18) for a in edges for b in edges]
        pairs += [(Decimal("1e12"), NANO, 1), (Decimal("1e17"), Decimal(3), 2 * 10**10)]
        df = spark.createDataFrame(pairs, "n decimal(38,9), d decimal(38,9), p bigint")
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            rows = df.select(
                "*",
                measures.ratio(F.col("n"), F.col("d")).alias("ratio"),
                measures.weighted_value(F.col("n"), F.col("p")).alias("weighted"),
            ).collect()
            missing = 0
            for r in rows:
                for got, exact in ((r.ratio, r.n / r.d), (r.weighted, r.n * r.p / 100)):
                    expected = exact.quantize(NANO, ROUND_HALF_UP)
                    if abs(expected) < Decimal(10) ** 28:
                        assert got == expected, (r, exact)
                    else:
                        assert got is None or got == expected
                        missing += 1
            assert missing > 100
    spark.conf.unset("spark.sql.ansi.enabled")


def test_a_ratio_by_zero_is_null(spark):
    df = spark.sql("select cast(1 as decimal(38,9)) as n, cast(0 as decimal(38,9)) as d")
    assert df.select(measures.ratio(F.col("n"), F.col("d"))).first()[0] is None


def test_ratios_of_a_thousand_and_more_compile_and_are_quick(spark):
    """Most quotients of real amounts are above a thousand; they are divided natively."""
    rows = spark.range(200_000).select(
        ((F.col("id") * 7919 + 1_000_003) / 100).cast("decimal(38,9)").alias("n"),
        ((F.col("id") % 97 + 1) / 7).cast("decimal(38,9)").alias("d"),
    )
    rows = rows.select("n", "d", measures.ratio(F.col("n"), F.col("d")).alias("r"))
    start = time.perf_counter()
    wrong = rows.where("abs(cast(r as double) / (cast(n as double) / cast(d as double)) - 1) > 1e-9 or r is null")
    assert wrong.count() == 0
    assert time.perf_counter() - start < 15
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(rows._jdf.queryExecution().executedPlan())
    assert "Found 1 WholeStageCodegen" in code
    assert len(code) < 400_000


def test_wide_measures_compute_each_part_once(spark):
    """Remainders of wide amounts are dear, so none stands in the plan for each use of its result."""
    rows = spark.createDataFrame([(Decimal(10**24), Decimal(8), 2 * 10**10)], "n decimal(38,9), d decimal(38,9), p bigint")
    for measure, most in ((measures.weighted_value(F.col("n"), F.col("p")), 4), (measures.ratio(F.col("n"), F.col("d")), 20)):
        plan = rows.select(measure.alias("m"))._jdf.queryExecution().analyzed().toString()
        assert plan.count(" % ") <= most
