"""Gold: the three marts. Facts are aggregated before the full joins, one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions import measures
from salesloom.operators import keys
from salesloom.plans.silver import _with_dimensions, goal_name

WON = "won"


def won_by_month(sales: DataFrame) -> DataFrame:
    """Won value and deals per seller and month."""
    return (
        sales.where(F.col("status_deal") == WON)
        .groupBy("sk_vendedor", measures.month_of(F.col("data_ganho")).alias("mes_referencia"))
        .agg(
            F.sum("valor_estimado").alias("total_vendido"),
            F.count("deal_id").alias("qtd_deals_fechados"),
        )
    )


def goals_vs_actuals(
    sales: DataFrame, goals: DataFrame, sellers: DataFrame, normalize_names: bool = False
) -> DataFrame:
    """Goal attainment per seller and month, from goals, won deals or both.

    Goals reach sellers by name. Goal names carry no accents, so by default an accented seller
    loses the goals; ``normalize_names`` cleans both sides.

    A row of either side without a seller key can match nothing and has no place in the result,
    so such rows leave before the full join, where they would share one partition.
    """

    def name_key(c: Column) -> Column:
        return goal_name(c) if normalize_names else c

    named = sellers.select(name_key(F.col("nome_vendedor")).alias("_name"), "sk_vendedor")
    goal = (
        goals.join(named, name_key(goals["nome_vendedor"]) == named["_name"])
        .where(F.col("sk_vendedor").isNotNull())
        .select("sk_vendedor", "mes_referencia", "meta_valor", "meta_qtd_deals")
        .alias("m")
    )
    actual = won_by_month(sales.where(F.col("sk_vendedor").isNotNull())).alias("v")
    both = goal.join(
        actual,
        (F.col("m.sk_vendedor") == F.col("v.sk_vendedor"))
        & (F.col("m.mes_referencia") == F.col("v.mes_referencia")),
        "full_outer",
    )
    sold, target = measures.fill_zero(F.col("total_vendido")), F.col("meta_valor")
    mart = both.select(
        F.coalesce("m.mes_referencia", "v.mes_referencia").alias("mes_referencia"),
        F.coalesce("m.sk_vendedor", "v.sk_vendedor").alias("sk_vendedor"),
        measures.fill_zero(target).alias("meta_faturamento"),
        measures.fill_zero(F.col("meta_qtd_deals")).alias("meta_qtd"),
        sold.alias("realizado_faturamento"),
        measures.fill_zero(F.col("qtd_deals_fechados")).alias("realizado_qtd"),
        measures.ratio_or_zero(sold, target).alias("atingimento_meta_pct"),
    )
    return mart.join(sellers.select("sk_vendedor", "nome_vendedor"), "sk_vendedor", "left").select(
        *mart.columns, "nome_vendedor"
    )


def cost_by_channel_month(costs: DataFrame, group_casefold: bool = False) -> DataFrame:
    """Cost and leads per channel and month; spellings differ by case unless folded."""
    channel = F.col("canal_aquisicao")
    if group_casefold:
        channel = F.lower(channel)
    return costs.groupBy(
        measures.month_of(F.col("data_custo")).alias("mes"), channel.alias("canal_aquisicao")
    ).agg(
        F.sum("custo_total").alias("investimento_total"), F.sum("qtd_leads").alias("leads_totais")
    )


def funnel_by_channel_month(deals: DataFrame, group_casefold: bool = False) -> DataFrame:
    """Deals, won deals and won value per lead channel and month of creation."""
    channel = F.col("origem_lead")
    if group_casefold:
        channel = F.lower(channel)
    won = F.col("status_deal") == WON
    return deals.groupBy(
        channel.alias("canal_aquisicao"), measures.month_of(F.col("data_criacao")).alias("mes")
    ).agg(
        F.count("deal_id").alias("oportunidades_geradas"),
        F.count_if(won).alias("vendas_realizadas"),
        F.sum(F.when(won, F.col("valor_estimado")).otherwise(0)).alias("receita_gerada"),
    )


def channel_performance(
    costs: DataFrame, deals: DataFrame, group_casefold: bool = False
) -> DataFrame:
    """Cost per lead, acquisition cost and return per channel and month.

    Channels meet whatever their case. By default spellings that differ by case stay apart
    before that, so two of them both get the same deals; ``group_casefold`` merges them.
    """
    c = cost_by_channel_month(costs, group_casefold).alias("c")
    p = funnel_by_channel_month(deals, group_casefold).alias("p")
    both = c.join(
        p,
        (F.col("c.mes") == F.col("p.mes"))
        & (F.lower("c.canal_aquisicao") == F.lower("p.canal_aquisicao")),
        "full_outer",
    )
    cost, leads = F.col("investimento_total"), measures.fill_zero(F.col("leads_totais"))
    won, revenue = measures.fill_zero(F.col("vendas_realizadas")), F.col("receita_gerada")
    return both.select(
        F.coalesce("c.mes", "p.mes").alias("mes_referencia"),
        F.coalesce("c.canal_aquisicao", "p.canal_aquisicao").alias("canal"),
        measures.fill_zero(cost).alias("custo_marketing"),
        leads.alias("leads_captados"),
        measures.fill_zero(F.col("oportunidades_geradas")).alias("deals_criados"),
        won.alias("deals_ganhos"),
        measures.fill_zero(revenue).alias("receita_total"),
        measures.ratio_or_zero(cost, leads).alias("cpl"),
        # NULL where deals were won without a cost row, and where cost has no deal row.
        measures.ratio_or_zero(cost, won).alias("cac"),
        measures.ratio_or_zero(revenue - cost, cost).alias("roi"),
    )


_FACT_PART = (
    "deal_id",
    "titulo",
    "valor_estimado",
    "valor_ponderado_pipeline",
    "probabilidade_pct",
    "etapa_funil",
    "status_deal",
    "dias_ciclo_vendas",
)
_DATE_PART = ("data_criacao", "data_previsao_fechamento", "data_ganho")


def _wide(rows: DataFrame) -> DataFrame:
    return rows.select(
        *_FACT_PART,
        "nome_vendedor",
        "nome_empresa",
        "setor",
        "porte_empresa",
        F.col("cidade").alias("cidade_cliente"),
        F.col("estado").alias("estado_cliente"),
        *_DATE_PART,
        measures.month_of(F.col("data_criacao")).alias("mes_criacao_deal"),
        measures.month_of(F.col("data_ganho")).alias("mes_fechamento_deal"),
    )


def wide_sales(sales: DataFrame, sellers: DataFrame, companies: DataFrame) -> DataFrame:
    """The fact with the names of its seller and company: 19 columns for reports."""
    seller = sellers.select(F.col("sk_vendedor").alias("_seller"), "nome_vendedor")
    company = companies.withColumnRenamed("organizacao_id", "_company")
    return _wide(
        sales.join(seller, sales["sk_vendedor"] == seller["_seller"], "left").join(
            company, sales["fk_organizacao"] == company["_company"], "left"
        )
    )


def wide_sales_one_pass(
    deals: DataFrame,
    sellers: DataFrame,
    companies: DataFrame,
    as_of: Column | None = None,
    day_mode: str = "elapsed",
) -> DataFrame:
    """The same rows straight from the deals, each dimension joined once instead of twice.

    Only dimensions without repeated keys make both forms equal, so that is checked first.
    """
    keys.assert_unique(sellers.where(F.col("vendedor_id").isNotNull()), ["vendedor_id"])
    keys.assert_unique(sellers, ["sk_vendedor"])
    keys.assert_unique(companies, ["organizacao_id"])
    return _wide(_with_dimensions(deals, sellers, companies, as_of, day_mode))
