"""The whole build: deal history first, then bronze views, silver tables and gold tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions import clean
from salesloom.functions.names import qualified_name
from salesloom.operators import keys
from salesloom.operators.history import history_exists, update_history
from salesloom.operators.staging import stage
from salesloom.plans import bronze, gold, silver
from salesloom.sources.load import STAGING
from salesloom.sources.tables import replace_changed, replace_table, replace_view

log = logging.getLogger(__name__)

# What makes a new version of a deal.
DEAL_KEY = "id"
DEAL_CHECKED = ("stage", "status", "value", "expected_close_date", "probability")

# Bronze view: its staging table and its projection.
BRONZE = {
    "stg_crm_deals": ("crm_deals", bronze.stg_crm_deals),
    "stg_crm_activities": ("crm_activities", bronze.stg_crm_activities),
    "stg_crm_contacts": ("crm_contacts", bronze.stg_crm_contacts),
    "stg_crm_organizations": ("crm_organizations", bronze.stg_crm_organizations),
    "stg_custos_aquisicao": ("custos_aquisicao_v2", bronze.stg_custos_aquisicao),
    "stg_metas_vendedores": ("metas_vendedores_v2", bronze.stg_metas_vendedores),
    "stg_produtos": ("produtos_servicos_v2", bronze.stg_produtos),
    "stg_territorios": ("territorios_segmentos", bronze.stg_territorios),
}


def snapshot_deals(spark: SparkSession, path: str, run_time: datetime | None = None) -> None:
    """Load the staged deals into their history."""
    run_time = run_time or datetime.now(timezone.utc)
    first = not history_exists(spark, path)
    deals = spark.table(qualified_name(STAGING, "crm_deals"))
    update_history(spark, path, deals, DEAL_KEY, DEAL_CHECKED, run_time, first)


@dataclass(frozen=True)
class Options:
    """Repaired forms of what reports rely on by default, and the money reader of plain columns.

    ``changed_only`` writes just the months whose rows differ from those of the build before.
    """

    normalize_names: bool = False
    include_goal_only: bool = False
    group_casefold: bool = False
    day_mode: str = "elapsed"
    key_registry: str | None = None
    money: Callable[[Column], Column] = clean.safe_numeric
    changed_only: bool = False


# Months by which stored tables are split into folders, so a month filter skips the others.
MONTHS = {
    "fct_metas_vendas": ("mes_referencia",),
    "agg_meta_vs_realizado": ("mes_referencia",),
    "agg_performance_marketing": ("mes_referencia",),
    "obt_vendas_analitico": ("mes_criacao_deal",),
}
# Bronze views whose plain money columns follow the options.
MONEY_VIEWS = ("stg_custos_aquisicao", "stg_metas_vendedores", "stg_territorios")


# Marts that are far smaller than what they are computed from.
AGGREGATED = ("agg_meta_vs_realizado", "agg_performance_marketing")


def _store(df: DataFrame, layer: str, table: str, changed_only: bool = False) -> DataFrame:
    if changed_only and table in MONTHS:
        rows = stage(df, table) if table in AGGREGATED else df
        written = replace_changed(rows, layer, table, *MONTHS[table])
        log.info("%s: %d months written", table, len(written))
    else:
        replace_table(df, layer, table, MONTHS.get(table, ()))
    return df.sparkSession.table(qualified_name(layer, table))


def key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys that break a join: repeated ones of dimensions, and those that a fact alone has.

    One row per key: the table, what is wrong, the key as text, and its rows. A repeated seller or
    company makes a deal appear more than once in the marts.
    """
    repeated = [
        ("dim_vendedores", "vendedor_id"),
        ("dim_vendedores", "sk_vendedor"),
        ("dim_organizacoes", "organizacao_id"),
        ("dim_produtos", "produto_id"),
    ]
    orphaned = [
        ("stg_crm_deals", "organizacao_id", "dim_organizacoes", "organizacao_id"),
        ("stg_crm_deals", "vendedor_id", "dim_vendedores", "vendedor_id"),
    ]

    def found(df: DataFrame, table: str, check: str, key: str) -> DataFrame:
        return df.select(
            F.lit(table).alias("table"),
            F.lit(check).alias("check"),
            F.lit(key).alias("key"),
            F.col(key).cast("string").alias("value"),
            "rows",
        )

    parts = [
        found(keys.duplicate_keys(tables[t].where(F.col(k).isNotNull()), [k]), t, "repeated", k)
        for t, k in repeated
    ] + [
        found(keys.orphans(tables[t], k, tables[d], dk), t, f"not in {d}", k)
        for t, k, d, dk in orphaned
    ]
    return reduce(DataFrame.unionAll, parts)


def build_tables(
    spark: SparkSession, as_of: datetime | None = None, options: Options = Options()
) -> dict[str, DataFrame]:
    """All tables from staging, by name.

    Bronze stays lazy. Silver is stored before gold reads it, so each dimension is computed once
    and joined by its real size. ``as_of`` fixes the moment up to which open deals are counted.
    Months and days are those of UTC, so the session must be. ``key_checks`` is stored with the
    marts and its rows are logged as a warning.
    """
    if (zone := spark.conf.get("spark.sql.session.timeZone")) not in ("UTC", "Etc/UTC", "Z"):
        raise ValueError(f"months are counted in UTC, but the session's time zone is {zone}")
    moment = F.lit(as_of or datetime.now(timezone.utc)).cast("timestamp")
    t = {}
    for view, (table, cleaned) in BRONZE.items():
        how = {"money": options.money} if view in MONEY_VIEWS else {}
        t[view] = replace_view(cleaned(spark.table(qualified_name(STAGING, table)), **how), view)

    def silver_table(name: str, df: DataFrame) -> None:
        t[name] = _store(df, "silver", name, options.changed_only)

    def gold_table(name: str, df: DataFrame) -> None:
        t[name] = _store(df, "gold", name, options.changed_only)

    raw_deals = spark.table(qualified_name(STAGING, "crm_deals"))
    silver_table("dim_organizacoes", silver.company_dim(t["stg_crm_organizations"]))
    silver_table("dim_produtos", silver.product_dim(t["stg_produtos"]))
    silver_table("fct_metas_vendas", silver.goal_fact(t["stg_metas_vendedores"]))
    sellers = silver.seller_dim(
        raw_deals, t["fct_metas_vendas"], options.include_goal_only, options.key_registry
    )
    silver_table("dim_vendedores", sellers)
    sellers, companies = t["dim_vendedores"], t["dim_organizacoes"]
    sales = silver.sales_fact(t["stg_crm_deals"], sellers, companies, moment, options.day_mode)
    silver_table("fct_vendas", sales)
    goals = t["fct_metas_vendas"]
    gold_table(
        "agg_meta_vs_realizado",
        gold.goals_vs_actuals(t["fct_vendas"], goals, sellers, options.normalize_names),
    )
    gold_table(
        "agg_performance_marketing",
        gold.channel_performance(
            t["stg_custos_aquisicao"], t["stg_crm_deals"], options.group_casefold
        ),
    )
    gold_table("obt_vendas_analitico", gold.wide_sales(t["fct_vendas"], sellers, companies))
    gold_table("key_checks", key_checks(t))
    for row in t["key_checks"].groupBy("table", "check", "key").count().collect():
        log.warning("%s: %d values of %s are %s", row["table"], row["count"], row["key"], row["check"])
    return t
