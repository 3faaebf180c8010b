"""The job from files to marts, as a user starts it."""

import json
import os

from salesloom.__main__ import main
from salesloom.operators.history import read_history


def deal(n, owner, status, value, channel, **more):
    return {
        "id": f"deal_{n}", "title": f"Pedido {n}", "stage": "Proposta", "stage_id": 1,
        "value": value, "currency": "BRL", "probability": 50, "owner_id": owner[0],
        "owner_name": owner[1], "person_id": 1, "org_id": 31, "status": status,
        "expected_close_date": "2024-03-01", "add_time": "2024-01-01T10:00:00Z",
        "update_time": "2024-01-02T10:00:00Z", "won_time": None, "lost_time": None,
        "custom_fields": {"produtos": ["P1"], "origem_lead": channel}, **more,
    }


JOAO, ANA = (501, "João Silva"), (502, "Ana Costa")
DEALS = [
    deal(1, ANA, "won", 1000.5, "Google Ads", won_time="2024-01-31T09:00:00Z"),
    deal(2, JOAO, "won", 500, "Google Ads", won_time="2024-01-11T09:00:00Z", org_id=99),
    deal(3, ANA, "open", 200, "Webinar"),
]
ORGANIZATIONS = [{"id": 31, "name": "Padaria", "annual_revenue": 2000000, "city": "Recife"}]
SHEETS = {
    "custos_aquisicao_v2": "data,origem_lead,custo,quantidade_leads,observacoes\n"
    "05/01/2024,Gogle Ads,100.50,3,\n2024-01-20,google ads,50,0,\n",
    "metas_vendedores_v2": "vendedor,mes,meta_receita,meta_deals_fechados,comissao_percentual\n"
    'ANA COSTA,01/01/2024,4002,3,"5,0%"\nana costa,2024-01-01,2000,9,"5,0%"\n'
    'JOÃO SILVA,01/01/2024,100,1,"5,0%"\n',
    "produtos_servicos_v2": "produto_id,nome,categoria,preco_base,margem_minima,desconto_max\n"
    'P1,Caixa,HW,"R$ 1.234,50",15%,10%\n',
    "territorios_segmentos": "território,estado,segmento_foco,vendedor_responsavel,"
    "potencial_anual\nSul,RS,Varejo,Ana Costa,10\n",
}


def test_job(spark, folder):
    os.makedirs(f"{folder}/crm")
    os.makedirs(f"{folder}/sheets")
    dumps = {
        "crm_deals": DEALS,
        "crm_organizations": ORGANIZATIONS,
        "crm_contacts": [{"id": 1, "name": "Bia"}],
        "crm_activities": [{"id": "activity_7", "deal_id": "deal_1"}],
    }
    for name, data in dumps.items():
        with open(f"{folder}/crm/{name}_response.json", "w", encoding="utf-8") as file:
            json.dump({"success": True, "data": data}, file, indent=2)
    for name, text in SHEETS.items():
        with open(f"{folder}/sheets/{name}.csv", "w", encoding="utf-8") as file:
            file.write(text)
    lake = f"{folder}/lake"
    options = ["--crm", f"{folder}/crm", "--sheets", f"{folder}/sheets", "--lake", lake]
    for day in ("2024-02-01T00:00:00", "2024-02-02T00:00:00"):
        assert main([*options, "--as-of", day]) == 0

    def rows(table, *columns):
        return sorted((tuple(map(str, r)) for r in spark.table(table).select(*columns).collect()))

    assert rows(
        "gold.agg_meta_vs_realizado", "nome_vendedor", "meta_faturamento", "realizado_faturamento",
        "atingimento_meta_pct",
    ) == [
        ("Ana Costa", "4002.000000000", "1000.500000000", "0.250000000"),
        ("João Silva", "0E-9", "500.000000000", "0E-9"),  # the goal has lost its accent
    ]
    assert rows(
        "gold.agg_performance_marketing", "canal", "deals_ganhos", "cpl", "cac", "roi"
    ) == [
        ("Google Ads", "2", "33.500000000", "50.250000000", "13.930348259"),
        ("Webinar", "0", "0E-9", "0E-9", "0E-9"),
        ("google ads", "2", "0E-9", "25.000000000", "29.010000000"),
    ]
    assert rows(
        "gold.obt_vendas_analitico", "deal_id", "nome_empresa", "porte_empresa",
        "dias_ciclo_vendas", "valor_ponderado_pipeline",
    ) == [
        ("deal_1", "Padaria", "Mid-Market", "29", "500.250000000"),
        ("deal_2", "None", "None", "9", "250.000000000"),
        ("deal_3", "Padaria", "Mid-Market", "31", "100.000000000"),
    ]
    assert rows("silver.dim_produtos", "preco_base", "margem_minima_pct") == [
        ("1234.500000000", "0.150000000")
    ]
    assert read_history(spark, f"{lake}/snapshots/crm_deals").count() == 3
    assert spark.table("staging.territorios_segmentos").columns[0] == "territorio"


def test_options_reach_the_marts(spark, folder):
    os.makedirs(f"{folder}/crm")
    os.makedirs(f"{folder}/sheets")
    spelled = [*DEALS, deal(4, (502, "ANA COSTA"), "won", 10, "Webinar", won_time="2024-01-15T09:00:00Z")]
    for name, data in {
        "crm_deals": spelled, "crm_organizations": ORGANIZATIONS, "crm_contacts": [{"id": 1}],
        "crm_activities": [{"id": "activity_7"}],
    }.items():
        with open(f"{folder}/crm/{name}_response.json", "w", encoding="utf-8") as file:
            for record in data:
                file.write(json.dumps(record) + "\n")
    extra = SHEETS | {"metas_vendedores_v2": SHEETS["metas_vendedores_v2"] + 'FANTASMA,01/01/2024,"R$ 7,00",1,"5,0%"\n'}
    for name, text in extra.items():
        with open(f"{folder}/sheets/{name}.csv", "w", encoding="utf-8") as file:
            file.write(text)
    before = spark.conf.get("spark.sql.session.timeZone")
    assert main([
        "--crm", f"{folder}/crm", "--sheets", f"{folder}/sheets", "--lake", f"{folder}/lake2", "--lines",
        "--as-of", "2024-02-05T00:00:00", "--no-line-breaks", "--normalize-names", "--include-goal-only",
        "--group-casefold", "--day-mode", "calendar", "--money-text",
    ]) == 0
    assert spark.conf.get("spark.sql.session.timeZone") == before
    marts = spark.table("gold.agg_meta_vs_realizado")
    got = {(r.nome_vendedor, float(r.meta_faturamento)) for r in marts.collect()}
    assert ("João Silva", 10000.0) in got or ("João Silva", 100.0) in got
    assert ("Fantasma", 7.0) in got
    assert {r.nome_vendedor for r in spark.table("silver.dim_vendedores").collect()} == {
        "Ana Costa", "ANA COSTA", "João Silva", "Fantasma"
    }
    channels = [r.canal for r in spark.table("gold.agg_performance_marketing").collect()]
    assert sorted(channels) == ["google ads", "webinar"]
    checks = {(r.table, r.check, r.key, r.value, r.rows) for r in spark.table("gold.key_checks").collect()}
    assert ("dim_vendedores", "repeated", "vendedor_id", "502", 2) in checks
    assert ("stg_crm_deals", "not in dim_organizacoes", "organizacao_id", "99", 1) in checks
    months = spark.sql("DESCRIBE TABLE EXTENDED gold.agg_meta_vs_realizado").collect()
    assert any(r.col_name == "# Partition Information" for r in months)


def test_other_time_zones_are_refused(spark):
    import pytest

    from salesloom.plans.build import build_tables

    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            build_tables(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
