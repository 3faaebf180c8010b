"""Shapes of physical plans: what is pushed down, broadcast, split or never planned."""

import contextlib
import io

import oracle
import pytest
from pyspark.sql import functions as F

from salesloom.operators.staging import shared_folder, stage
from salesloom.plans import gold, silver
from workload.queries import QUERIES

SF = f"{oracle.TESTDATA}/sf0.001"


def plan(df, run=False):
    if run:
        df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_single_partition_cross_join_or_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("SinglePartition", "CartesianProduct", "NestedLoop", "Python", "InPandas"):
        assert node not in text


def test_status_filter_and_columns_reach_the_scan(spark):
    deals = stage(
        spark.sql("""select 'a' as deal_id, 'won' as status_deal, 5 as valor_estimado,
            1 as sk_vendedor, current_timestamp() as data_ganho, 'x' as titulo"""),
        "deals",
    )
    text = plan(gold.won_by_month(deals))
    assert "EqualTo(status_deal,won)" in text
    assert "titulo" not in text


def _hot_deals(spark, rows=60000):
    """A third of the deals belong to one company, some to none."""
    company = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, F.lit(None))
    return spark.range(rows).select(
        F.concat(F.lit("deal_"), "id").alias("deal_id"),
        company.otherwise(F.col("id") % 5000).cast("bigint").alias("organizacao_id"),
        (F.col("id") % 25).alias("vendedor_id"),
        F.concat(F.lit("Pedido "), F.sha2(F.col("id").cast("string"), 256)).alias("titulo"),
        F.col("id").cast("decimal(38,9)").alias("valor_estimado"),
        F.lit(50).cast("bigint").alias("probabilidade_pct"),
        F.lit("won").alias("status_deal"),
        F.lit("x").alias("etapa_funil"),
        F.lit("2024-01-01").cast("timestamp").alias("data_criacao"),
        F.lit("2024-02-01").cast("date").alias("data_previsao_fechamento"),
        F.lit("2024-03-01").cast("timestamp").alias("data_ganho"),
        F.lit(None).cast("timestamp").alias("data_perda"),
    )


def _dims(spark):
    sellers = spark.range(25).select(
        F.col("id").alias("sk_vendedor"),
        F.col("id").alias("vendedor_id"),
        F.concat(F.lit("Seller "), "id").alias("nome_vendedor"),
    )
    companies = spark.range(4000).select(
        F.col("id").alias("organizacao_id"),
        F.concat(F.lit("c"), "id").alias("nome_empresa"),
        *[F.lit("x").alias(c) for c in ("setor", "porte_empresa", "cidade", "estado", "pais")],
    )
    return stage(sellers, "sellers"), stage(companies, "companies")


def test_small_dimensions_are_broadcast(spark):
    text = plan(silver.sales_fact(_hot_deals(spark), *_dims(spark)))
    assert text.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_hot_company_is_split_when_its_dimension_is_too_large_to_broadcast(spark):
    deals = stage(_hot_deals(spark).repartition(8), "hot-deals")
    sellers, companies = _dims(spark)
    expected = silver.sales_fact(deals, sellers, companies).agg(
        F.count("*"), F.count("fk_organizacao"), F.sum("valor_ponderado_pipeline")
    )
    want = expected.first()
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    ):
        fact = silver.sales_fact(deals, sellers, companies)
        assert "SortMergeJoin(skew=true)" in plan(fact, run=True)
        got = fact.agg(
            F.count("*"), F.count("fk_organizacao"), F.sum("valor_ponderado_pipeline")
        ).first()
    assert got == want


def test_one_pass_equals_two_and_refuses_repeated_sellers(spark):
    deals = _hot_deals(spark, 2000)
    sellers, companies = _dims(spark)
    one = gold.wide_sales_one_pass(deals, sellers, companies)
    two = gold.wide_sales(silver.sales_fact(deals, sellers, companies), sellers, companies)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    with pytest.raises(ValueError, match="vendedor_id"):
        gold.wide_sales_one_pass(deals, sellers.union(sellers), companies)


def test_repeated_sellers_fan_out_as_documented(spark):
    deals = _hot_deals(spark, 50)
    sellers, companies = _dims(spark)
    doubled = sellers.union(sellers.withColumn("nome_vendedor", F.lit("other")))
    fact = silver.sales_fact(deals, doubled, companies)
    assert fact.count() == 100
    assert gold.wide_sales(fact, doubled, companies).count() == 200


def test_staged_tables_lie_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark) == folder.rstrip("/")
    staged = stage(spark.range(3), "numbers")
    assert staged.count() == 3
    own = f"{shared_folder(spark).removeprefix('file:')}/staged/{spark.sparkContext.applicationId}/numbers-"
    assert own in staged.inputFiles()[0]
