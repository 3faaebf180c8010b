"""The stored build from staging to gold, against the SQL twins and the lazy queries."""

from datetime import datetime, timezone

import oracle
import pytest
from pyspark.sql import functions as F

from salesloom.operators.history import read_history
from salesloom.plans import build
from salesloom.sources.tables import replace_table
from workload import standins
from workload.oracles import ORACLES
from workload.queries import plain

SF = f"{oracle.TESTDATA}/sf0.001"
STAGED = {
    "crm_deals": standins.crm_deals,
    "crm_activities": standins.crm_activities,
    "crm_contacts": standins.crm_contacts,
    "crm_organizations": standins.crm_organizations,
    "custos_aquisicao_v2": standins.custos_aquisicao,
    "metas_vendedores_v2": standins.metas_vendedores,
    "produtos_servicos_v2": standins.produtos_servicos,
    "territorios_segmentos": standins.territorios_segmentos,
}
SAME_AS = {
    "dim_organizacoes": "company_dim",
    "dim_produtos": "product_dim",
    "dim_vendedores": "seller_dim",
    "fct_metas_vendas": "goal_fact",
    "fct_vendas": "sales_fact",
    "agg_meta_vs_realizado": "goals_vs_actuals",
    "agg_performance_marketing": "channel_performance",
    "obt_vendas_analitico": "wide_sales",
}


@pytest.fixture(scope="module")
def built(spark):
    for name, rows in STAGED.items():
        replace_table(rows(spark, SF), "staging", name)
    as_of = datetime.fromisoformat(standins.AS_OF).replace(tzinfo=timezone.utc)
    return build.build_tables(spark, as_of)


@pytest.mark.parametrize("name", SAME_AS)
def test_stored_table_equals_its_sql(built, name):
    con = oracle.connect(SF)
    assert oracle.difference(plain(built[name]), con, ORACLES[SAME_AS[name]]) is None


def test_layers(spark, built):
    assert spark.table("gold.obt_vendas_analitico").count() == built["fct_vendas"].count()
    assert len(spark.table("gold.obt_vendas_analitico").columns) == 19
    assert len(spark.table("silver.fct_vendas").columns) == 13
    assert len(spark.table("stg_crm_deals").columns) == 23
    assert len(built) == 17


def test_snapshots(spark, built, folder):
    path = f"{folder}/deals"
    build.snapshot_deals(spark, path, datetime(2024, 1, 1))
    deals = spark.table("staging.crm_deals")
    moved = F.when(F.col("status") == "open", "won").otherwise(F.col("status"))
    rows, opened = deals.count(), deals.where("status = 'open'").count()
    replace_table(deals.withColumn("status", moved), "staging", "crm_deals")
    try:
        build.snapshot_deals(spark, path, datetime(2024, 1, 2))
    finally:
        replace_table(standins.crm_deals(spark, SF), "staging", "crm_deals")
    versions = read_history(spark, path)
    assert versions.count() == rows + opened
    assert versions.where("valid_to is not null").count() == opened > 0
