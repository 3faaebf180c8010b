"""Silver: the dimensions and facts of the star schema.

Joins carry no broadcast hints. Silver tables are stored, so Spark knows their real size and
broadcasts a dimension below ``spark.sql.autoBroadcastJoinThreshold``. A larger one is joined by
sorting, where adaptive execution splits the partition of a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions import clean, measures
from salesloom.operators import keys, shape
from salesloom.operators.registry import lasting_key
from salesloom.operators.staging import stage

# Revenue above which a company is in a tier, highest first, and where sellers
# come from.
COMPANY_TIERS = ((10_000_000, "Enterprise"), (1_000_000, "Mid-Market"))
LOWEST_TIER = "SMB"
FROM_CRM, FROM_SHEET = "CRM", "Planilha"


def company_dim(organizations: DataFrame) -> DataFrame:
    """Companies with their tier; unknown revenue counts as the lowest."""
    return organizations.select(
        "organizacao_id",
        "nome_empresa",
        "setor",
        shape.tier(F.col("faturamento_anual"), COMPANY_TIERS, LOWEST_TIER).alias("porte_empresa"),
        "cidade",
        "estado",
        "pais",
    )


def product_dim(products: DataFrame) -> DataFrame:
    """Products with base price, least margin and largest discount."""
    return products.select(
        "produto_id",
        "nome_produto",
        "categoria",
        "preco_base",
        "margem_minima_pct",
        "desconto_maximo_pct",
    )


def seller_dim(
    raw_deals: DataFrame,
    goals: DataFrame | None = None,
    include_goal_only: bool = False,
    key_registry: str | None = None,
) -> DataFrame:
    """Distinct sellers of the CRM with a surrogate key; stored as a side effect.

    The key is the seller's own id, or a number by name order where the id is no integer.
    ``include_goal_only`` adds sellers that only the goals name; goal names carry no accents, so
    the CRM's names are cleaned before they are compared. A seller spelled in two ways has two
    rows, as in the CRM. By name order a new seller moves the numbers of others; with a
    ``key_registry``, a folder, a name keeps the number that it got first.
    """
    owned = raw_deals.where(F.col("owner_id").isNotNull())
    members = shape.distinct_members(
        owned,
        [
            ("vendedor_id", clean.safe_int(F.col("owner_id"))),
            ("nome_vendedor", "owner_name"),
            ("origem", F.lit(FROM_CRM)),
        ],
    )
    if include_goal_only:
        if goals is None:
            raise ValueError("include_goal_only needs the goals")
        named = shape.distinct_members(
            goals,
            [
                ("vendedor_id", F.lit(None).cast("bigint")),
                ("nome_vendedor", "nome_vendedor"),
                ("origem", F.lit(FROM_SHEET)),
            ],
        )
        members = stage(members, "members")  # read twice below, computed once
        known = members.select(goal_name(F.col("nome_vendedor")).alias("nome_vendedor"))
        members = members.unionByName(named.join(known, "nome_vendedor", "left_anti"))
    if key_registry:
        return lasting_key(members, key_registry, "vendedor_id", ["nome_vendedor"], "sk_vendedor")
    return keys.surrogate_key(members, "vendedor_id", ["nome_vendedor"], "sk_vendedor")


def goal_name(c: Column) -> Column:
    """A seller's name as goals write it once they are clean."""
    return clean.title_case(clean.strip_accents(c))


def goal_fact(goals: DataFrame) -> DataFrame:
    """The best goal per seller and month: highest value, then commission, then deals.

    The sort is kept cheap. The month goes before the name, as dates compare faster than names
    with a common start; and the value is compared as a double, exactly only where those tie.
    """
    columns = ["nome_vendedor", "mes_referencia", "meta_valor", "meta_qtd_deals", "comissao_pct"]
    best = [F.col("meta_valor").cast("double").desc()]
    best += [F.col(c).desc() for c in ("meta_valor", "comissao_pct", "meta_qtd_deals")]
    return keys.dedup_first(goals.select(*columns), ["mes_referencia", "nome_vendedor"], best)


def sales_fact(
    deals: DataFrame,
    sellers: DataFrame,
    companies: DataFrame,
    as_of: Column | None = None,
    day_mode: str = "elapsed",
) -> DataFrame:
    """One row per deal (and spelling of its seller), with keys and measures.

    The company key comes from the dimension, so it is NULL for unknown companies.
    """
    return _with_dimensions(deals, sellers, companies, as_of, day_mode).select(*FACT_COLUMNS)


FACT_COLUMNS = (
    "deal_id",
    "titulo",
    "valor_estimado",
    "probabilidade_pct",
    "sk_vendedor",
    "fk_organizacao",
    "etapa_funil",
    "status_deal",
    "dias_ciclo_vendas",
    "valor_ponderado_pipeline",
    "data_criacao",
    "data_previsao_fechamento",
    "data_ganho",
)


def _with_dimensions(
    deals: DataFrame,
    sellers: DataFrame,
    companies: DataFrame,
    as_of: Column | None,
    day_mode: str,
) -> DataFrame:
    """Deals with the columns of both dimensions and the computed measures."""
    seller = sellers.select(
        F.col("vendedor_id").alias("_seller"), "sk_vendedor", "nome_vendedor"
    )
    company = companies.withColumnRenamed("organizacao_id", "fk_organizacao")
    joined = deals.join(seller, deals["vendedor_id"] == seller["_seller"], "left").join(
        company, deals["organizacao_id"] == company["fk_organizacao"], "left"
    )
    return joined.withColumns(
        {
            "dias_ciclo_vendas": measures.cycle_days(
                F.col("data_criacao"),
                F.col("data_ganho"),
                F.col("data_perda"),
                as_of=as_of,
                mode=day_mode,
            ),
            "valor_ponderado_pipeline": measures.weighted_value(
                F.col("valor_estimado"), F.col("probabilidade_pct")
            ),
        }
    )
