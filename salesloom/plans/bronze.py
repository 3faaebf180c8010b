"""Bronze: staging tables with clean names and types. One narrow projection each, no shuffle.

The lists pair output columns with what they come from. Fixed values: the names of both sides,
which sources and reports share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from salesloom.functions import clean
from salesloom.operators.shape import project

CUSTOM_FIELDS = "custom_fields"


def _date(source: DataFrame, field: str) -> Column:
    """A field as a date; one that already is a date needs no reading."""
    is_date = isinstance(source.schema[field].dataType, DateType)
    return F.col(field) if is_date else clean.safe_date(F.col(field))


def stg_crm_deals(source: DataFrame) -> DataFrame:
    """One row per deal, its custom fields flattened."""
    columns = [
        ("deal_id", "id"),
        ("organizacao_id", "org_id"),
        ("contato_id", "person_id"),
        ("vendedor_id", "owner_id"),
        ("titulo", "title"),
        ("valor_estimado", clean.safe_numeric(F.col("value"))),
        ("moeda", "currency"),
        ("probabilidade_pct", clean.safe_int(F.col("probability"))),
        ("status_deal", "status"),
        ("etapa_funil", "stage"),
        ("etapa_id", "stage_id"),
        ("territorio_label", f"{CUSTOM_FIELDS}.territorio"),
        ("motivo_perda", f"{CUSTOM_FIELDS}.motivo_perda"),
        ("segmento", f"{CUSTOM_FIELDS}.segmento"),
        ("origem_lead", f"{CUSTOM_FIELDS}.origem_lead"),
        ("concorrente", f"{CUSTOM_FIELDS}.concorrente"),
        ("lista_interesse_produtos", f"{CUSTOM_FIELDS}.produtos"),
        ("data_previsao_fechamento", _date(source, "expected_close_date")),
        ("data_criacao", "add_time"),
        ("data_atualizacao", "update_time"),
        ("data_ganho", "won_time"),
        ("data_perda", "lost_time"),
        ("data_ingestao", "_ingested_at"),
    ]
    return project(source, columns)


def stg_crm_activities(source: DataFrame) -> DataFrame:
    """One row per activity, keyed by the digits of its id."""
    columns = [
        ("atividade_id", clean.digits_key(F.col("id"))),
        ("deal_id", clean.digits_key(F.col("deal_id"))),
        ("contato_id", "person_id"),
        ("organizacao_id", "org_id"),
        ("vendedor_id", "owner_id"),
        ("tipo_atividade", "type"),
        ("assunto", "subject"),
        ("observacao", "note"),
        ("realizado_bool", "done"),
        ("data_vencimento", _date(source, "due_date")),
        ("hora_vencimento", "due_time"),
        ("duracao_bruta", F.col("duration").try_cast("string")),
        ("data_criacao", "add_time"),
        ("data_conclusao", "marked_as_done_time"),
    ]
    return project(source, columns)


def stg_crm_contacts(source: DataFrame) -> DataFrame:
    """One row per person."""
    columns = [
        ("contato_id", "id"),
        ("organizacao_id", "org_id"),
        ("vendedor_responsavel_id", "owner_id"),
        ("nome_completo", "name"),
        ("email", "email"),
        ("telefone", "phone"),
        ("cargo", "job_title"),
        ("data_criacao", "add_time"),
        ("data_atualizacao", "update_time"),
    ]
    return project(source, columns)


def stg_crm_organizations(source: DataFrame) -> DataFrame:
    """One row per company."""
    columns = [
        ("organizacao_id", "id"),
        ("nome_empresa", "name"),
        ("vendedor_responsavel_id", "owner_id"),
        ("endereco_completo", "address"),
        ("cidade", "city"),
        ("estado", "state"),
        ("pais", "country"),
        ("cep", "postal_code"),
        ("setor", "industry"),
        ("faixa_funcionarios", "employees"),
        ("faturamento_anual", clean.safe_numeric(F.col("annual_revenue"))),
        ("qtd_contatos", clean.safe_int(F.col("people_count"))),
        ("qtd_deals_abertos", clean.safe_int(F.col("open_deals_count"))),
        ("qtd_deals_ganhos", clean.safe_int(F.col("won_deals_count"))),
        ("data_criacao", "add_time"),
        ("data_ingestao", "_ingested_at"),
    ]
    return project(source, columns)


def stg_custos_aquisicao(
    source: DataFrame, money: Callable[[Column], Column] = clean.safe_numeric
) -> DataFrame:
    """One row per cost entry. Rows without date text go; unreadable dates stay as NULL.

    ``money`` reads the cost; ``clean.parse_money`` takes it with currency signs.
    """
    columns = [
        ("data_custo", clean.parse_date_multi(F.col("data"))),
        ("canal_aquisicao", clean.canonical_label(F.col("origem_lead"))),
        ("custo_total", money(F.col("custo"))),
        ("qtd_leads", clean.safe_int(F.col("quantidade_leads"))),
        ("observacoes", "observacoes"),
        ("origem_arquivo", "source_sheet"),
    ]
    return project(source.where(F.col("data").isNotNull()), columns)


def stg_metas_vendedores(
    source: DataFrame, money: Callable[[Column], Column] = clean.safe_numeric
) -> DataFrame:
    """One row per goal entry that names a seller; names without accents, in title case."""
    columns = [
        ("nome_vendedor", clean.title_case(F.col("_stripped"))),
        ("mes_referencia", clean.parse_date_multi(F.col("mes"))),
        ("meta_valor", money(F.col("meta_receita"))),
        ("meta_qtd_deals", clean.safe_int(F.col("meta_deals_fechados"))),
        ("comissao_pct", clean.percent_digits(F.col("comissao_percentual"))),
    ]
    # The cleaned name is NULL exactly when the raw one is, and a raw column reaches the scan.
    named = source.where(F.col("vendedor").isNotNull())
    # Named in a step of its own, the stripped text is computed once, not at each of its uses.
    return project(named.withColumn("_stripped", clean.strip_accents(F.col("vendedor"))), columns)


def stg_produtos(source: DataFrame) -> DataFrame:
    """One row per product."""
    columns = [
        ("produto_id", "produto_id"),
        ("nome_produto", "nome"),
        ("categoria", "categoria"),
        ("preco_base", clean.parse_money(F.col("preco_base"))),
        ("margem_minima_pct", clean.parse_percent(F.col("margem_minima"))),
        ("desconto_maximo_pct", clean.parse_percent(F.col("desconto_max"))),
    ]
    return project(source, columns)


def stg_territorios(
    source: DataFrame, money: Callable[[Column], Column] = clean.safe_numeric
) -> DataFrame:
    """One row per territory entry."""
    columns = [
        ("nome_territorio", "territorio"),
        ("lista_estados_string", "estado"),
        ("segmento_foco", "segmento_foco"),
        ("nome_vendedor", "vendedor_responsavel"),
        ("potencial_anual_mercado", money(F.col("potencial_anual"))),
    ]
    return project(source, columns)
