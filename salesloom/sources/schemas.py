"""Layouts of the sources. Field and sheet names as the sources write them."""

from __future__ import annotations

# The four API entities. Amounts are read as decimals, so no digit is lost to a double.
CRM_DEALS = """
    id string, title string, stage string, stage_id bigint, value decimal(38,9),
    currency string, probability bigint, owner_id bigint, owner_name string,
    person_id bigint, person_name string, org_id bigint, org_name string, status string,
    expected_close_date date, add_time timestamp, update_time timestamp,
    won_time timestamp, lost_time timestamp,
    custom_fields struct<produtos: array<string>, origem_lead: string, segmento: string,
        territorio: string, motivo_perda: string, concorrente: string>
"""
CRM_CONTACTS = """
    id bigint, name string, email string, phone string, org_id bigint, org_name string,
    owner_id bigint, owner_name string, job_title string,
    add_time timestamp, update_time timestamp
"""
CRM_ORGANIZATIONS = """
    id bigint, name string, address string, city string, state string, country string,
    postal_code string, owner_id bigint, owner_name string, people_count bigint,
    open_deals_count bigint, won_deals_count bigint, industry string, employees string,
    annual_revenue decimal(38,9), add_time timestamp, update_time timestamp
"""
CRM_ACTIVITIES = """
    id string, type string, subject string, done boolean, due_date date, due_time string,
    duration string, deal_id string, person_id bigint, org_id bigint, owner_id bigint,
    owner_name string, note string, add_time timestamp, update_time timestamp,
    marked_as_done_time timestamp
"""

# (table, folder in the raw zone, layout)
CRM_TABLES = (
    ("crm_deals", "deals", CRM_DEALS),
    ("crm_contacts", "contacts", CRM_CONTACTS),
    ("crm_organizations", "organizations", CRM_ORGANIZATIONS),
    ("crm_activities", "activities", CRM_ACTIVITIES),
)

# Sheets; each tab is named like its sheet and every cell is text.
SHEET_TABLES = (
    "custos_aquisicao_v2",
    "territorios_segmentos",
    "produtos_servicos_v2",
    "metas_vendedores_v2",
)
