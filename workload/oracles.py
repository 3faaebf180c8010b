"""The queries once more, as SQL for DuckDB over the same tables."""

from __future__ import annotations

from workload import standins

AS_OF = f"timestamp '{standins.AS_OF}'"
LOADED = f"'{standins.LOADED_AT}'"
_DAY = "'%Y-%m-%d'"
_SECOND = "'%Y-%m-%d %H:%M:%S'"


def day(expr: str) -> str:
    return f"strftime({expr}, {_DAY})"


def second(expr: str) -> str:
    return f"strftime({expr}, {_SECOND})"


def quotient(n: str, d: str) -> str:
    """Nine decimals, as the marts store ratios."""
    return f"round(cast({n} as double) / cast({d} as double), 9)"


def _dirty(expr: str) -> str:
    return f"""case when l_tax = 0 then 'n/d'
        when l_returnflag || l_linestatus = 'AF' then strftime({expr}, '%d/%m/%Y')
        when l_returnflag || l_linestatus = 'AO' then strftime({expr}, '%Y-%m-%d')
        when l_returnflag || l_linestatus = 'NF' then strftime({expr}, '%-d-%-m-%Y')
        when l_returnflag || l_linestatus = 'NO' then strftime({expr}, '%Y/%m/%d')
        when l_returnflag || l_linestatus = 'RF' then '  ' || strftime({expr}, '%d/%m/%Y') || ' '
        else strftime({expr}, '%Y-%-m-%-d') end"""


def _clean_date(expr: str) -> str:
    formats = ("%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y", "%Y/%m/%d")
    tries = ", ".join(f"try_strptime(trim({expr}), '{f}')" for f in formats)
    return f"cast(coalesce({tries}) as date)"


_DELIMITED = r"""[\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-\s]+|[^\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-\s]+"""


def _title(expr: str) -> str:
    pieces = f"regexp_extract_all(lower({expr}), '{_DELIMITED}')"
    capital = "(case when t[1] = 'ß' then 'SS' else upper(t[1]) end) || t[2:]"
    return f"array_to_string(list_transform({pieces}, lambda t: {capital}), '')"


_SEGMENT_CHANNEL = """case c_mktsegment when 'AUTOMOBILE' then 'Google Ads'
    when 'BUILDING' then 'Facebook Ads' when 'FURNITURE' then 'LinkedIn Ads'
    when 'HOUSEHOLD' then 'Eventos' else 'Webinar' end"""

_LABEL = """case when lower(origem_lead) like '%gogle%' then 'Google Ads'
    when lower(origem_lead) like '%face%' then 'Facebook Ads'
    when lower(origem_lead) like '%linkedin%' then 'LinkedIn Ads' else origem_lead end"""

_CTE = {
    "deals": f"""
        select 'deal_' || o_orderkey as deal_id,
            case when o_orderpriority <> '5-LOW' then o_custkey end as organizacao_id,
            c_custkey as contato_id,
            cast(c_nationkey as bigint) as vendedor_id,
            case when n_regionkey = 0 then 'Nação ' else 'Seller ' end || n_nationkey
                as owner_name,
            'Pedido ' || o_orderkey as titulo,
            cast(o_totalprice as decimal(18,2)) as valor_estimado,
            'BRL' as moeda,
            cast(case left(o_orderpriority, 1) when '1' then 100 when '2' then 80
                when '3' then 60 when '4' then 25 else 10 end as bigint) as probabilidade_pct,
            case o_orderstatus when 'F' then 'won' when 'P' then 'lost' else 'open' end
                as status_deal,
            o_orderpriority as etapa_funil,
            cast(left(o_orderpriority, 1) as bigint) as etapa_id,
            n_name as territorio_label,
            case when o_orderstatus = 'P' then 'Preço' end as motivo_perda,
            c_mktsegment as segmento,
            {_SEGMENT_CHANNEL} as origem_lead,
            case when o_orderstatus = 'O' then '' end as concorrente,
            o_orderpriority || '|' || c_mktsegment as lista_interesse_produtos,
            cast(o_orderdate as date) + 30 as data_previsao_fechamento,
            o_orderdate + to_hours(o_orderkey % 24) as data_criacao,
            case when o_orderstatus = 'F' then o_orderdate + to_hours(o_orderkey % 24)
                + to_hours(cast(floor(o_totalprice) as bigint) % 2003) end as data_ganho,
            case when o_orderstatus = 'P' then o_orderdate + to_hours(o_orderkey % 24)
                + to_hours(cast(floor(o_totalprice) as bigint) % 2003) end as data_perda
        from orders join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey""",
    "companies": """
        select c_custkey as organizacao_id, c_name as nome_empresa, c_mktsegment as setor,
            case when cast(c_acctbal as decimal(18,2)) * 1200 > 10000000 then 'Enterprise'
                when cast(c_acctbal as decimal(18,2)) * 1200 > 1000000 then 'Mid-Market'
                else 'SMB' end as porte_empresa,
            n_name as cidade, left(c_mktsegment, 2) as estado, 'Brasil' as pais
        from customer join nation on c_nationkey = n_nationkey""",
    "sellers": """
        select distinct vendedor_id as sk_vendedor, vendedor_id, owner_name as nome_vendedor,
            'CRM' as origem
        from deals""",
    "goals": f"""
        select {_title("strip_accents(vendedor)")} as nome_vendedor,
            {_clean_date("mes")} as mes_referencia, meta_valor, meta_qtd_deals, comissao_pct
        from (select case when l_discount <> 0 then upper(
                    case n_regionkey when 4 then 'Ghost ' when 0 then 'Nação '
                    else 'Seller ' end || n_nationkey) end as vendedor,
                {_dirty("date_trunc('month', l_shipdate)")} as mes,
                cast(l_extendedprice as decimal(18,2)) as meta_valor,
                cast(l_quantity as bigint) as meta_qtd_deals,
                cast(cast(round(l_discount * 100) as integer) * 10 as decimal(9,3)) / 1000
                    as comissao_pct
            from lineitem join supplier on l_suppkey = s_suppkey
            join nation on s_nationkey = n_nationkey)
        where vendedor is not null""",
    "goal_fact": """
        select nome_vendedor, mes_referencia, meta_valor, meta_qtd_deals, comissao_pct
        from (select *, row_number() over (partition by nome_vendedor, mes_referencia
                order by meta_valor desc nulls last, comissao_pct desc nulls last,
                    meta_qtd_deals desc nulls last) as rn from goals)
        where rn = 1""",
    "raw_costs": f"""
        select case when l_discount <> 0 then {_dirty("l_shipdate")} end as data,
            case c_mktsegment
                when 'AUTOMOBILE' then case l_returnflag when 'A' then 'Gogle Ads'
                    when 'N' then 'google ads' else 'Google Ads' end
                when 'BUILDING' then case l_returnflag when 'A' then 'facebook'
                    when 'N' then 'FACE ads' else 'Facebook Ads' end
                when 'FURNITURE' then case l_returnflag when 'A' then 'linkedin'
                    when 'N' then 'LinkedIn Ads' else 'LINKEDIN' end
                when 'HOUSEHOLD' then 'Eventos' else 'Rádio' end as origem_lead,
            cast(cast(l_extendedprice as decimal(18,2)) * cast(0.05 as decimal(4,2))
                as decimal(18,4)) as custo_total,
            cast(l_quantity as bigint) as qtd_leads,
            l_returnflag as observacoes
        from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey""",
    "costs": f"""
        select {_clean_date("data")} as data_custo,
            {_LABEL} as canal_aquisicao,
            custo_total, qtd_leads, observacoes,
            'custos_aquisicao_v2' as origem_arquivo
        from raw_costs where data is not null""",
    "products": """
        select 'PROD' || p_partkey as produto_id, p_name as nome_produto,
            p_type as categoria,
            case when p_size >= 3 then cast(cast(p_retailprice as decimal(18,2)) as double) end
                as preco_base,
            case when p_size <= 40 then p_size / 100 end as margem_minima_pct,
            (p_size * 10 + 5) / 1000 as desconto_maximo_pct
        from part""",
    "sales": """
        select d.*, s.sk_vendedor, c.organizacao_id as fk_organizacao,
            coalesce(data_ganho, data_perda, AS_OF) as fim,
            cast(cast(valor_estimado * 100 as bigint) * probabilidade_pct as double) / 10000
                as ponderado
        from deals d left join sellers s on d.vendedor_id = s.vendedor_id
        left join companies c on d.organizacao_id = c.organizacao_id""".replace("AS_OF", AS_OF),
    "day_one": f"""
        select o_orderkey as id, o_orderpriority as stage, o_orderstatus as status,
            cast(o_totalprice as decimal(18,2)) as value, cast(o_orderdate as date) as opened_on
        from orders where o_orderdate < date '{standins.DAY_ONE_ENDS}'""",
    "day_two": """
        select o_orderkey as id,
            case when o_orderpriority <> '3-MEDIUM' then o_orderpriority end as stage,
            case when o_orderstatus = 'O' and cast(o_totalprice as decimal(18,2)) > 200000
                then 'F' else o_orderstatus end as status,
            cast(o_totalprice as decimal(18,2)) as value, cast(o_orderdate as date) as opened_on
        from orders where o_orderkey in (select l_orderkey from lineitem)""",
    "versions": f"""
        select h.*, '{standins.DAY_ONE}' as valid_from,
            case when n.id is not null and (h.stage is distinct from n.stage
                or h.status is distinct from n.status or h.value is distinct from n.value)
                then '{standins.DAY_TWO}' end as valid_to
        from day_one h left join day_two n on h.id = n.id
        union all
        select n.*, '{standins.DAY_TWO}', null
        from day_two n left join day_one h on h.id = n.id
        where h.id is null or h.stage is distinct from n.stage
            or h.status is distinct from n.status or h.value is distinct from n.value""",
}
_CTE |= {
    "odd_owners": """
        select deal_id, valor_estimado,
            case when cast(substr(deal_id, 6) as bigint) % 11 <> 0 then
                case when vendedor_id = 5 then 'x5' else cast(vendedor_id as varchar) end end as owner,
            case when vendedor_id = 3 and etapa_id = 2 then upper(owner_name) else owner_name end as name
        from deals""",
    "odd_sellers": """
        select coalesce(vendedor_id, row_number() over (
                order by nome_vendedor nulls first, vendedor_id nulls first) + 100000) as sk_vendedor, *
        from (select distinct try_cast(owner as bigint) as vendedor_id, name as nome_vendedor,
            'CRM' as origem from odd_owners where owner is not null)""",
}
# What each of them reads.
_NEEDS = {
    "sellers": ["deals"],
    "odd_owners": ["deals"],
    "odd_sellers": ["odd_owners"],
    "goal_fact": ["goals"],
    "costs": ["raw_costs"],
    "sales": ["deals", "sellers", "companies"],
    "versions": ["day_one", "day_two"],
}


def sql(select: str, *tables: str) -> str:
    """The statement with the definitions that it needs in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in tables:
        add(name)
    if not ordered:
        return select
    return "with " + ",\n".join(f"{n} as ({_CTE[n]})" for n in ordered) + "\n" + select


_DEALS = f"""
    select deal_id, organizacao_id, contato_id, vendedor_id, titulo,
        cast(valor_estimado as double) as valor_estimado, moeda, probabilidade_pct, status_deal,
        etapa_funil, etapa_id, territorio_label, motivo_perda, segmento, origem_lead,
        concorrente, lista_interesse_produtos,
        {day("data_previsao_fechamento")} as data_previsao_fechamento,
        {second("data_criacao")} as data_criacao, {second("data_criacao")} as data_atualizacao,
        {second("data_ganho")} as data_ganho, {second("data_perda")} as data_perda,
        {LOADED} as data_ingestao
    from deals"""


def _attainment(clean_names: bool) -> str:
    name = _title("strip_accents(nome_vendedor)") if clean_names else "nome_vendedor"
    return f"""
        select {day("mes")} as mes_referencia, f.sk_vendedor, meta_faturamento, meta_qtd,
            realizado_faturamento, realizado_qtd, atingimento_meta_pct, s.nome_vendedor
        from (
            select coalesce(m.mes_referencia, v.mes_referencia) as mes,
                coalesce(m.sk_vendedor, v.sk_vendedor) as sk_vendedor,
                coalesce(cast(meta_valor as double), 0) as meta_faturamento,
                coalesce(meta_qtd_deals, 0) as meta_qtd,
                coalesce(cast(total as double), 0) as realizado_faturamento,
                coalesce(n, 0) as realizado_qtd,
                case when meta_valor > 0 then {quotient("coalesce(total, 0)", "meta_valor")}
                    else 0 end as atingimento_meta_pct
            from (select sk_vendedor, mes_referencia, meta_valor, meta_qtd_deals
                from (select * replace ({name} as nome_vendedor) from goal_fact) g
                left join (select sk_vendedor, {name} as nome from sellers) k
                    on g.nome_vendedor = k.nome) m
            full join (select sk_vendedor, cast(date_trunc('month', data_ganho) as date)
                    as mes_referencia, sum(valor_estimado) as total, count(deal_id) as n
                from sales where status_deal = 'won' group by 1, 2) v
                on m.sk_vendedor = v.sk_vendedor and m.mes_referencia = v.mes_referencia) f
        left join sellers s on f.sk_vendedor = s.sk_vendedor
        where f.sk_vendedor is not null"""


def _channels(fold: bool) -> str:
    cost_channel = "lower(canal_aquisicao)" if fold else "canal_aquisicao"
    lead_channel = "lower(origem_lead)" if fold else "origem_lead"
    return f"""
        select {day("coalesce(c.mes, p.mes)")} as mes_referencia,
            coalesce(c.canal, p.canal) as canal,
            coalesce(cast(custo as double), 0) as custo_marketing,
            cast(coalesce(leads, 0) as bigint) as leads_captados,
            coalesce(n, 0) as deals_criados, coalesce(won, 0) as deals_ganhos,
            coalesce(cast(receita as double), 0) as receita_total,
            case when coalesce(leads, 0) > 0 then {quotient("custo", "leads")} else 0 end as cpl,
            case when coalesce(won, 0) > 0 then {quotient("custo", "won")} else 0 end as cac,
            case when coalesce(custo, 0) > 0 then {quotient("(receita - custo)", "custo")}
                else 0 end as roi
        from (select cast(date_trunc('month', data_custo) as date) as mes,
                {cost_channel} as canal, sum(custo_total) as custo, sum(qtd_leads) as leads
            from costs group by 1, 2) c
        full join (select cast(date_trunc('month', data_criacao) as date) as mes,
                {lead_channel} as canal, count(deal_id) as n,
                count(*) filter (status_deal = 'won') as won,
                sum(case when status_deal = 'won' then valor_estimado else 0 end) as receita
            from deals group by 1, 2) p
            on c.mes = p.mes and lower(c.canal) = lower(p.canal)"""


def _fact(days: str) -> str:
    return f"""
        select deal_id, titulo, cast(valor_estimado as double) as valor_estimado,
            probabilidade_pct, sk_vendedor, fk_organizacao, etapa_funil, status_deal,
            {days}('day', data_criacao, fim) as dias_ciclo_vendas,
            ponderado as valor_ponderado_pipeline, {second("data_criacao")} as data_criacao,
            {day("data_previsao_fechamento")} as data_previsao_fechamento,
            {second("data_ganho")} as data_ganho
        from sales"""


_WIDE = f"""
    select deal_id, titulo, cast(valor_estimado as double) as valor_estimado,
        ponderado as valor_ponderado_pipeline, probabilidade_pct, etapa_funil, status_deal,
        date_sub('day', data_criacao, fim) as dias_ciclo_vendas, nome_vendedor, nome_empresa,
        setor, porte_empresa, cidade as cidade_cliente, estado as estado_cliente,
        {second("data_criacao")} as data_criacao,
        {day("data_previsao_fechamento")} as data_previsao_fechamento,
        {second("data_ganho")} as data_ganho,
        {day("date_trunc('month', data_criacao)")} as mes_criacao_deal,
        {day("date_trunc('month', data_ganho)")} as mes_fechamento_deal
    from sales v left join sellers s on v.sk_vendedor = s.sk_vendedor
    left join companies c on v.fk_organizacao = c.organizacao_id"""

_TERRITORY = """
    select n_name as nome_territorio, 'BR, ' || n_name as lista_estados_string,
        case when n_regionkey = 0 then 'Indústria' else 'Varejo' end as segmento_foco,
        s_name as nome_vendedor, AMOUNT as potencial_anual_mercado
    from supplier join nation on s_nationkey = n_nationkey"""

_VERSION = """
    select id, stage, status, cast(value as double) as value, {opened} as opened_on,
        md5(id || '|' || valid_from || '.000000') as scd_id, valid_from as updated_at,
        valid_from, valid_to
    from versions {where}"""


def _versions(where: str = "") -> str:
    return sql(_VERSION.format(opened=day("opened_on"), where=where), "versions")


def _documents(expr: str) -> str:
    return f"select doc_id, {expr} as text from documents"


_ASCII = r"regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')"

ORACLES: dict[str, str] = {
    "goals_vs_actuals": sql(_attainment(False), "goal_fact", "sales"),
    "goals_vs_actuals_by_clean_name": sql(_attainment(True), "goal_fact", "sales"),
    "channel_performance": sql(_channels(False), "costs", "deals"),
    "channel_performance_casefold": sql(_channels(True), "costs", "deals"),
    "wide_sales": sql(_WIDE, "sales"),
    "wide_sales_one_pass": sql(_WIDE, "sales"),
    "wide_sales_refreshed": sql(_WIDE, "sales"),
    "sales_fact": sql(_fact("date_sub"), "sales"),
    "sales_fact_calendar_days": sql(_fact("date_diff"), "sales"),
    "seller_dim": sql("select * from sellers", "sellers"),
    "seller_dim_with_goal_only": sql(
        """
        select coalesce(vendedor_id, row_number() over (order by nome_vendedor) + 100000)
            as sk_vendedor, vendedor_id, nome_vendedor, origem
        from (select vendedor_id, nome_vendedor, origem from sellers
            union all
            select distinct cast(null as bigint), nome_vendedor, 'Planilha' from goals
            where nome_vendedor not in (select """
        + _title("strip_accents(nome_vendedor)")
        + """ from sellers))""",
        "sellers",
        "goals",
    ),
    "company_dim": sql("select * from companies", "companies"),
    "product_dim": sql("select * from products", "products"),
    "goal_fact": sql(
        f"""select nome_vendedor, {day("mes_referencia")} as mes_referencia,
            cast(meta_valor as double) as meta_valor, meta_qtd_deals,
            cast(comissao_pct as double) as comissao_pct from goal_fact""",
        "goal_fact",
    ),
    "stg_crm_deals": sql(_DEALS, "deals"),
    "envelope_records": sql(_DEALS, "deals"),
    "stg_crm_activities": f"""
        select event_id as atividade_id, case when event_type <> 'error' then user_id end as deal_id,
            user_id as contato_id, user_id as organizacao_id, user_id as vendedor_id,
            event_type as tipo_atividade, event_type || ' ' || user_id as assunto,
            props as observacao, event_type in ('purchase', 'signup') as realizado_bool,
            case when event_type <> 'view' then {day("ts")} end as data_vencimento,
            strftime(ts, '%H:%M') as hora_vencimento,
            case when event_type in ('purchase', 'signup') then '00:30' end as duracao_bruta,
            {second("ts")} as data_criacao,
            case when event_type in ('purchase', 'signup') then {second("ts")} end
                as data_conclusao
        from events""",
    "stg_crm_contacts": f"""
        select c_custkey as contato_id, c_custkey as organizacao_id,
            cast(c_nationkey as bigint) as vendedor_responsavel_id, c_name as nome_completo,
            lower(replace(c_name, '#', '.')) || '@example.com' as email,
            case when c_acctbal >= 0 then '+55 ' || c_custkey end as telefone,
            c_mktsegment as cargo, {LOADED} as data_criacao, {LOADED} as data_atualizacao
        from customer""",
    "stg_crm_organizations": f"""
        select c_custkey as organizacao_id, c_name as nome_empresa,
            cast(c_nationkey as bigint) as vendedor_responsavel_id,
            'Rua ' || c_custkey as endereco_completo, n_name as cidade,
            left(c_mktsegment, 2) as estado, 'Brasil' as pais,
            case when c_acctbal >= 0 then lpad(cast(c_custkey as varchar), 8, '0') end as cep,
            c_mktsegment as setor, '50-100' as faixa_funcionarios,
            case when c_acctbal >= 0 then cast(cast(c_acctbal as decimal(18,2)) * 1200 as double)
                end as faturamento_anual,
            cast(c_nationkey as bigint) as qtd_contatos, c_custkey as qtd_deals_abertos,
            cast(null as bigint) as qtd_deals_ganhos, {LOADED} as data_criacao,
            {LOADED} as data_ingestao
        from customer join nation on c_nationkey = n_nationkey""",
    "stg_custos_aquisicao": sql(
        f"""select {day("data_custo")} as data_custo, canal_aquisicao,
            cast(custo_total as double) as custo_total, qtd_leads, observacoes, origem_arquivo
        from costs""",
        "costs",
    ),
    "stg_metas_vendedores": sql(
        f"""select nome_vendedor, {day("mes_referencia")} as mes_referencia,
            cast(meta_valor as double) as meta_valor, meta_qtd_deals,
            cast(comissao_pct as double) as comissao_pct from goals""",
        "goals",
    ),
    "stg_produtos": sql("select * from products", "products"),
    "stg_territorios": _TERRITORY.replace(
        "AMOUNT",
        "case when s_acctbal >= 1000 then cast(cast(s_acctbal as decimal(18,2)) as double) end",
    ),
    # The money cleaner takes the dot of plain numbers for a thousands mark.
    "stg_territorios_with_money": _TERRITORY.replace(
        "AMOUNT", "cast(cast(s_acctbal as decimal(18,2)) * 100 as double)"
    ),
    "flatten_struct": sql(
        """select deal_id as id, lista_interesse_produtos, origem_lead, segmento,
            territorio_label, motivo_perda, concorrente from deals""",
        "deals",
    ),
    "won_by_month": sql(
        f"""select sk_vendedor, {day("date_trunc('month', data_ganho)")} as mes_referencia,
            cast(sum(valor_estimado) as double) as total_vendido,
            count(deal_id) as qtd_deals_fechados
        from sales where status_deal = 'won' group by 1, 2""",
        "sales",
    ),
    "cost_by_channel_month": sql(
        f"""select {day("date_trunc('month', data_custo)")} as mes, canal_aquisicao,
            cast(sum(custo_total) as double) as investimento_total,
            cast(sum(qtd_leads) as bigint) as leads_totais
        from costs group by 1, 2""",
        "costs",
    ),
    "funnel_by_channel_month": sql(
        f"""select origem_lead as canal_aquisicao,
            {day("date_trunc('month', data_criacao)")} as mes,
            count(deal_id) as oportunidades_geradas,
            count(*) filter (status_deal = 'won') as vendas_realizadas,
            cast(sum(case when status_deal = 'won' then valor_estimado else 0 end) as double)
                as receita_gerada
        from deals group by 1, 2""",
        "deals",
    ),
    "cycle_days_elapsed": sql(
        f"""select deal_id as id,
            date_sub('day', data_criacao, coalesce(data_ganho, data_perda, {AS_OF})) as days
        from deals""",
        "deals",
    ),
    "cycle_days_calendar": sql(
        f"""select deal_id as id,
            date_diff('day', data_criacao, coalesce(data_ganho, data_perda, {AS_OF})) as days
        from deals""",
        "deals",
    ),
    "ratio_measures": f"""
        select l_orderkey, l_linenumber, cast(p as double) as price,
            case when q > 0 then {quotient("p", "q")} else 0 end as per_unit,
            case when t > 0 then {quotient("(t - d)", "t")} else 0 end as margin,
            cast(cast(p * 100 as bigint) * cast(q as bigint) as double) / 10000 as weighted,
            {day("date_trunc('month', l_shipdate)")} as month
        from (select l_orderkey, l_linenumber, l_shipdate,
            cast(l_extendedprice as decimal(18,2)) as p,
            cast(cast(l_quantity as bigint) as decimal(18,0)) as q,
            cast(l_tax as decimal(18,2)) as t, cast(l_discount as decimal(18,2)) as d
            from lineitem)""",
    "surrogate_rank": f"""
        select {second("o_orderdate")} as o_orderdate, o_orderkey,
            row_number() over (order by o_orderdate nulls first, o_orderkey) as rn
        from orders""",
    "surrogate_key": """
        select case when c_acctbal >= 0 then c_custkey
                else row_number() over (order by c_mktsegment, c_name) + 100000 end as sk,
            case when c_acctbal >= 0 then c_custkey end as id, c_name as name,
            c_mktsegment as segment
        from customer""",
    "surrogate_key_lasting": """
        select case when c_acctbal >= 0 then c_custkey
                else row_number() over (
                    partition by c_acctbal >= 0
                    order by case when c_custkey in (select o_custkey from orders) then 0 else 1 end,
                        c_mktsegment, c_name) + 100000 end as sk,
            case when c_acctbal >= 0 then c_custkey end as id, c_name as name,
            c_mktsegment as segment
        from customer""",
    "orphan_keys": """
        select o_orderkey, count(*) as rows from orders anti join lineitem
            on o_orderkey = l_orderkey
        group by 1""",
    "duplicate_keys": """
        select l_orderkey, l_linenumber, count(*) as rows from lineitem
        group by 1, 2 having count(*) > 1""",
    "parse_dates": f"""
        select l_orderkey, l_linenumber, raw, {day(_clean_date("raw"))} as day
        from (select *, {_dirty("l_shipdate")} as raw from lineitem)""",
    "parse_money": sql("select produto_id, preco_base as amount from products", "products"),
    "parse_percent": sql(
        """select produto_id, margem_minima_pct as least, desconto_maximo_pct as most
        from products""",
        "products",
    ),
    "percent_digits": """
        select l_orderkey, l_linenumber,
            cast(left(regexp_replace(a, '[^0-9]', '', 'g'), 4) as integer) / 1000 as commission,
            cast(left(regexp_replace(b, '[^0-9]', '', 'g'), 4) as integer) / 1000 as whole
        from (select l_orderkey, l_linenumber,
            cast(round(l_discount * 100) as integer) || ',5%' as a,
            cast(l_quantity as integer) || '%' as b from lineitem)""",
    "digits_key": """
        select event_id as event, case when event_type <> 'error' then user_id end as deal
        from events""",
    "canonical_label": sql(
        f"""select origem_lead,
            {_LABEL} as label, count(*) as rows
        from raw_costs group by 1, 2""",
        "raw_costs",
    ),
    "safe_cast": f"""
        select l_orderkey, l_linenumber,
            case when l_returnflag <> 'A' then cast(cast(l_extendedprice as decimal(18,2))
                as double) end as number,
            case when l_returnflag <> 'N' then cast(l_quantity as bigint) end as whole,
            case when l_linestatus = 'F' then {day("l_shipdate")} end as day
        from lineitem""",
    "strip_accents": _documents("strip_accents(text)"),
    "title_case": _documents(_title("text")),
    "to_ascii": _documents(_ASCII),
    "snake_case": _documents(
        rf"trim(regexp_replace(lower({_ASCII}), '[^a-z0-9_]+', '_', 'g'), '_')"
    ),
    "grid_rows": f"""
        select case when l_discount <> 0 then upper(case n_regionkey when 4 then 'Ghost '
                when 0 then 'Nação ' else 'Seller ' end || n_nationkey) end as vendedor,
            {_dirty("date_trunc('month', l_shipdate)")} as mes,
            cast(cast(l_extendedprice as decimal(18,2)) as varchar) as meta_receita,
            cast(cast(l_quantity as bigint) as varchar) as meta_deals_fechados,
            cast(round(l_discount * 100) as integer) || ',0%' as comissao,
            'metas_vendedores_v2' as source_sheet,
            '2002-01-01T06:00:00+00:00' as ingested_at
        from lineitem join supplier on l_suppkey = s_suppkey
        join nation on s_nationkey = n_nationkey""",
    "stringify_columns": """
        select cast(o_orderkey as varchar) as o_orderkey,
            case when o_orderpriority <> '5-LOW' then o_orderpriority end as priority,
            case when o_orderpriority = '1-URGENT' then '' else o_orderstatus end as status
        from orders""",
    "drop_blank_rows": """
        select case when o_orderstatus = 'F' then o_orderkey end as a,
            case when o_orderpriority = '5-LOW' then o_orderpriority end as b
        from orders where o_orderstatus = 'F' or o_orderpriority = '5-LOW'""",
    "scd2_init": sql(
        f"""select id, stage, status, cast(value as double) as value,
            {day("opened_on")} as opened_on,
            md5(id || '|{standins.DAY_ONE}.000000') as scd_id,
            '{standins.DAY_ONE}' as updated_at, '{standins.DAY_ONE}' as valid_from,
            cast(null as varchar) as valid_to
        from day_one""",
        "day_one",
    ),
    "scd2_merge": _versions(),
    "scd2_current": _versions("where valid_to is null"),
    "scd2_as_of": _versions(
        "where valid_from <= '2002-01-02 12:00:00' "
        "and (valid_to is null or valid_to > '2002-01-02 12:00:00')"
    ),
    "scd2_stored": _versions(),
    # The third load holds every third record of the second, unchanged, so it makes no version.
    "scd2_stored_new_column": sql(
        f"""select id, stage, status, cast(value as double) as value, {day("opened_on")} as opened_on,
            case when valid_from = '{standins.DAY_TWO}' then 'p' || (id % 7) end as priority,
            md5(id || '|' || valid_from || '.000000') as scd_id, valid_from as updated_at,
            valid_from, valid_to
        from versions""",
        "versions",
    ),
    "ratio_measures_wide": """
        select l_orderkey, l_linenumber,
            cast(cast(l_partkey as hugeint) * 125000000000000000 as decimal(38,9))::varchar as eighth,
            cast(cast(l_suppkey as hugeint) * 250000000 as decimal(38,9))::varchar as by_nanos,
            true as too_wide,
            cast(cast(l_partkey as hugeint) * 10000000000 * (20000000000 + l_linenumber)
                as decimal(38,9))::varchar as weighted
        from lineitem""",
    "load_report": """
        select 'nations' as source_table, 'success' as status, count(*) as rows from nation
        union all select 'parts', 'success', count(*) from part where p_partkey % 5 <> 0
        union all values ('none', 'skipped', null), ('null_data', 'skipped', null),
            ('absent', 'skipped', null), ('blank', 'skipped', null), ('absent_sheet', 'error', null)""",
    "loaded_tables": """
        select cast(p_partkey as varchar) as codigo, case when p_size > 10 then p_name end as nome_peca,
            p_type as nome_peca_1, cast(null as varchar) as col_2a_via, 'pecas' as source_sheet,
            '2002-01-01T06:00:00+00:00' as ingested_at
        from part where p_partkey % 5 <> 0""",
    "loaded_records": f"""
        select cast(n_nationkey as bigint) as n_nationkey, n_name, {LOADED} as _ingested_at from nation""",
    "layer_tables": f"""
        select o_orderkey, o_totalprice as value, {day("date_trunc('month', o_orderdate)")} as month
        from orders where year(o_orderdate) = 1995""",
    "odd_seller_dim": sql("select * from odd_sellers", "odd_sellers"),
    "odd_sales": sql(
        """select deal_id, sk_vendedor, cast(valor_estimado as double) as valor_estimado
        from odd_owners o left join (select * from odd_sellers where vendedor_id <> 7) s
            on try_cast(o.owner as bigint) = s.vendedor_id""",
        "odd_owners",
        "odd_sellers",
    ),
    "odd_key_checks": sql(
        """select vendedor_id, count(*) as rows from odd_sellers where vendedor_id is not null
        group by 1 having count(*) > 1""",
        "odd_sellers",
    ),
}
