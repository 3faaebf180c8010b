"""One query per operator, over whole tables. Results are plain: text for dates, doubles."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions import clean, measures
from salesloom.functions.names import qualified_name, rename_columns, table_name
from salesloom.operators import history, keys, registry, shape
from salesloom.operators.staging import shared_folder, stage
from salesloom.plans import bronze, gold, silver
from salesloom.sources import load, schemas
from salesloom.sources.readers import read_api_envelope, read_grid, stamp, stringify_all
from salesloom.sources.tables import land, replace_changed, replace_table
from workload import standins
from workload.standins import cents, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PAGE_RECORDS = 100
#: Of dumps and the raw zone: JSON repeats its field names in every record.
COMPRESSION = "gzip"


def plain(df: DataFrame) -> DataFrame:
    """Types that every engine prints alike."""

    def one(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        return c.alias(field.name)

    return df.select(*[one(f) for f in df.schema])


def query(build: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def _as_of():
    return F.lit(standins.AS_OF).cast("timestamp")


def _moment(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


# -- tables the queries share ----------------------------------------------------------------


# Silver tables are stored before a mart reads them, as the build does.


def _sellers(spark, sf_dir, **options):
    return silver.seller_dim(standins.crm_deals(spark, sf_dir), **options)


def _companies(spark, sf_dir):
    return silver.company_dim(
        bronze.stg_crm_organizations(standins.crm_organizations(spark, sf_dir))
    )


def _deals(spark, sf_dir):
    return bronze.stg_crm_deals(standins.crm_deals(spark, sf_dir))


def _goals(spark, sf_dir):
    return bronze.stg_metas_vendedores(standins.metas_vendedores(spark, sf_dir))


def _goal_fact(spark, sf_dir):
    return stage(silver.goal_fact(_goals(spark, sf_dir)), "goals")


def _costs(spark, sf_dir):
    return bronze.stg_custos_aquisicao(standins.custos_aquisicao(spark, sf_dir))


def _sales(spark, sf_dir, sellers, **options):
    return silver.sales_fact(
        _deals(spark, sf_dir), sellers, _companies(spark, sf_dir), _as_of(), **options
    )


# -- marts -----------------------------------------------------------------------------------


@query
def goals_vs_actuals(spark, sf_dir):
    sellers = stage(_sellers(spark, sf_dir), "sellers")
    sales = stage(_sales(spark, sf_dir, sellers), "sales")
    return gold.goals_vs_actuals(sales, _goal_fact(spark, sf_dir), sellers)


@query
def goals_vs_actuals_by_clean_name(spark, sf_dir):
    sellers = stage(_sellers(spark, sf_dir), "sellers")
    sales = stage(_sales(spark, sf_dir, sellers), "sales")
    goals = _goal_fact(spark, sf_dir)
    return gold.goals_vs_actuals(sales, goals, sellers, normalize_names=True)


@query
def channel_performance(spark, sf_dir):
    return gold.channel_performance(_costs(spark, sf_dir), _deals(spark, sf_dir))


@query
def channel_performance_casefold(spark, sf_dir):
    return gold.channel_performance(
        _costs(spark, sf_dir), _deals(spark, sf_dir), group_casefold=True
    )


@query
def wide_sales(spark, sf_dir):
    sellers = stage(_sellers(spark, sf_dir), "sellers")
    sales = _sales(spark, sf_dir, sellers)
    return gold.wide_sales(sales, sellers, _companies(spark, sf_dir))


@query
def wide_sales_one_pass(spark, sf_dir):
    sellers = stage(_sellers(spark, sf_dir), "sellers")
    companies = _companies(spark, sf_dir)
    return gold.wide_sales_one_pass(_deals(spark, sf_dir), sellers, companies, _as_of())


# -- silver ----------------------------------------------------------------------------------


@query
def sales_fact(spark, sf_dir):
    return _sales(spark, sf_dir, stage(_sellers(spark, sf_dir), "sellers"))


@query
def sales_fact_calendar_days(spark, sf_dir):
    sellers = stage(_sellers(spark, sf_dir), "sellers")
    return _sales(spark, sf_dir, sellers, day_mode="calendar")


@query
def seller_dim(spark, sf_dir):
    return _sellers(spark, sf_dir)


@query
def seller_dim_with_goal_only(spark, sf_dir):
    return _sellers(spark, sf_dir, goals=_goals(spark, sf_dir), include_goal_only=True)


@query
def company_dim(spark, sf_dir):
    return _companies(spark, sf_dir)


@query
def product_dim(spark, sf_dir):
    return silver.product_dim(bronze.stg_produtos(standins.produtos_servicos(spark, sf_dir)))


@query
def goal_fact(spark, sf_dir):
    return silver.goal_fact(_goals(spark, sf_dir))


# -- bronze ----------------------------------------------------------------------------------


@query
def stg_crm_deals(spark, sf_dir):
    return _deals(spark, sf_dir)


@query
def stg_crm_activities(spark, sf_dir):
    return bronze.stg_crm_activities(standins.crm_activities(spark, sf_dir))


@query
def stg_crm_contacts(spark, sf_dir):
    return bronze.stg_crm_contacts(standins.crm_contacts(spark, sf_dir))


@query
def stg_crm_organizations(spark, sf_dir):
    return bronze.stg_crm_organizations(standins.crm_organizations(spark, sf_dir))


@query
def stg_custos_aquisicao(spark, sf_dir):
    return _costs(spark, sf_dir)


@query
def stg_metas_vendedores(spark, sf_dir):
    return _goals(spark, sf_dir)


@query
def stg_produtos(spark, sf_dir):
    return bronze.stg_produtos(standins.produtos_servicos(spark, sf_dir))


@query
def stg_territorios(spark, sf_dir):
    return bronze.stg_territorios(standins.territorios_segmentos(spark, sf_dir))


@query
def stg_territorios_with_money(spark, sf_dir):
    raw = standins.territorios_segmentos(spark, sf_dir)
    return bronze.stg_territorios(raw, money=clean.parse_money)


@query
def flatten_struct(spark, sf_dir):
    raw = standins.crm_deals(spark, sf_dir).select("id", "custom_fields")
    return shape.flatten_struct(
        raw,
        "custom_fields",
        {"territorio": "territorio_label", "produtos": "lista_interesse_produtos"},
    )


# -- aggregates and measures -----------------------------------------------------------------


@query
def won_by_month(spark, sf_dir):
    return gold.won_by_month(_sales(spark, sf_dir, stage(_sellers(spark, sf_dir), "sellers")))


@query
def cost_by_channel_month(spark, sf_dir):
    return gold.cost_by_channel_month(_costs(spark, sf_dir))


@query
def funnel_by_channel_month(spark, sf_dir):
    return gold.funnel_by_channel_month(_deals(spark, sf_dir))


@query
def cycle_days_elapsed(spark, sf_dir):
    return _cycle_days(spark, sf_dir, "elapsed")


@query
def cycle_days_calendar(spark, sf_dir):
    return _cycle_days(spark, sf_dir, "calendar")


def _cycle_days(spark, sf_dir, mode):
    won, lost = F.col("won_time"), F.col("lost_time")
    days = measures.cycle_days(F.col("add_time"), won, lost, as_of=_as_of(), mode=mode)
    return standins.crm_deals(spark, sf_dir).select("id", days.alias("days"))


@query
def ratio_measures(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    price, quantity = cents("l_extendedprice"), F.col("l_quantity").cast("bigint")
    tax = cents("l_tax")
    return line.select(
        "l_orderkey",
        "l_linenumber",
        price.cast("double").alias("price"),
        measures.ratio_or_zero(price, quantity).alias("per_unit"),
        measures.ratio_or_zero(tax - cents("l_discount"), tax).alias("margin"),
        measures.weighted_value(price, quantity).alias("weighted"),
        measures.month_of(F.col("l_shipdate")).alias("month"),
    )


@query
def ratio_measures_wide(spark, sf_dir):
    """Amounts far beyond what a double holds; results as text, so every digit counts."""
    line = table(spark, sf_dir, "lineitem")
    wide, one = "decimal(38,9)", F.lit(Decimal(1))
    part, supplier = F.col("l_partkey").cast("decimal(18,0)"), F.col("l_suppkey").cast("decimal(18,0)")
    number = F.col("l_linenumber").cast("bigint")
    huge = (part * F.lit(Decimal(10**18))).cast(wide)
    most = (one * F.lit(Decimal(10**19)) * F.lit(Decimal(10**9))).cast(wide)
    return line.select(
        "l_orderkey",
        "l_linenumber",
        measures.ratio(huge, F.lit(Decimal(8)).cast(wide)).cast("string").alias("eighth"),
        measures.ratio(supplier.cast(wide), F.lit(Decimal("0.000000004")).cast(wide))
        .cast("string")
        .alias("by_nanos"),
        measures.ratio(most, F.lit(Decimal("0.000000003")).cast(wide)).isNull().alias("too_wide"),
        measures.weighted_value(
            (part * F.lit(Decimal(10**12))).cast(wide), F.lit(20_000_000_000) + number
        )
        .cast("string")
        .alias("weighted"),
    )


# -- keys ------------------------------------------------------------------------------------


@query
def surrogate_rank(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return keys.global_row_number(orders, ["o_orderdate"], "rn")


@query
def surrogate_key(spark, sf_dir):
    members = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    return keys.surrogate_key(members, "id", ["segment", "name"], "sk")


@query
def surrogate_key_lasting(spark, sf_dir):
    """Two builds: customers with orders first, then all; the second leaves the first one's keys alone."""
    members = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        "c_custkey",
    )
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    path = _scratch(spark, "registry")
    first = members.join(buyers, "c_custkey", "left_semi").drop("c_custkey")
    registry.lasting_key(first, path, "id", ["segment", "name"], "sk")
    return registry.lasting_key(members.drop("c_custkey"), path, "id", ["segment", "name"], "sk")


@query
def orphan_keys(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return keys.orphans(orders, "o_orderkey", lines, "l_orderkey")


@query
def duplicate_keys(spark, sf_dir):
    return keys.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- cleaners --------------------------------------------------------------------------------


@query
def parse_dates(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    raw = standins.dirty_date(F.col("l_shipdate"))
    return line.select(
        "l_orderkey", "l_linenumber", raw.alias("raw"), clean.parse_date_multi(raw).alias("day")
    )


@query
def parse_money(spark, sf_dir):
    raw = standins.produtos_servicos(spark, sf_dir)
    return raw.select("produto_id", clean.parse_money(F.col("preco_base")).alias("amount"))


@query
def parse_percent(spark, sf_dir):
    raw = standins.produtos_servicos(spark, sf_dir)
    return raw.select(
        "produto_id",
        clean.parse_percent(F.col("margem_minima")).alias("least"),
        clean.parse_percent(F.col("desconto_max")).alias("most"),
    )


@query
def percent_digits(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    raw = F.concat(F.round(F.col("l_discount") * 100).cast("int"), F.lit(",5%"))
    whole = F.concat(F.col("l_quantity").cast("int"), F.lit("%"))
    return line.select(
        "l_orderkey",
        "l_linenumber",
        clean.percent_digits(raw).alias("commission"),
        clean.percent_digits(whole).alias("whole"),
    )


@query
def digits_key(spark, sf_dir):
    events = standins.crm_activities(spark, sf_dir)
    return events.select(
        clean.digits_key(F.col("id")).alias("event"),
        clean.digits_key(F.col("deal_id")).alias("deal"),
    )


@query
def canonical_label(spark, sf_dir):
    raw = standins.custos_aquisicao(spark, sf_dir)
    label = clean.canonical_label(F.col("origem_lead"))
    return raw.groupBy("origem_lead", label.alias("label")).agg(F.count(F.lit(1)).alias("rows"))


@query
def safe_cast(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    price = cents("l_extendedprice").cast("string")
    number = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("R$ "), price)).otherwise(price)
    whole = F.col("l_quantity").cast("bigint").cast("string")
    count = F.when(F.col("l_returnflag") == "N", F.concat(whole, F.lit(".5"))).otherwise(whole)
    day = F.when(
        F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd")
    ).otherwise(F.date_format("l_shipdate", "yyyy/MM/dd"))
    return line.select(
        "l_orderkey",
        "l_linenumber",
        clean.safe_numeric(number).alias("number"),
        clean.safe_int(count).alias("whole"),
        clean.safe_date(day).alias("day"),
    )


@query
def strip_accents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", clean.strip_accents(F.col("text")).alias("text")
    )


@query
def title_case(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", clean.title_case(F.col("text")).alias("text")
    )


@query
def to_ascii(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", clean.to_ascii(F.col("text")).alias("text")
    )


@query
def snake_case(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", clean.snake_case(F.col("text")).alias("text")
    )


# -- loading ---------------------------------------------------------------------------------


def _scratch(spark, label):
    return f"{shared_folder(spark)}/workload/{label}-{uuid.uuid4().hex}"


@query
def envelope_records(spark, sf_dir):
    """Deals as pages of an API response, unwrapped, stamped, landed and read from the raw zone."""
    raw = standins.crm_deals(spark, sf_dir).drop("_ingested_at")
    page = F.floor(F.regexp_substr("id", F.lit(r"\d+")).cast("bigint") / PAGE_RECORDS)
    # Ids are unique, so a page holds PAGE_RECORDS records at most.
    pages = raw.groupBy(page.alias("page")).agg(F.collect_list(F.struct("*")).alias("data"))
    dump = _scratch(spark, "dump")
    pages.select(F.lit(True).alias("success"), "data").write.json(dump, compression=COMPRESSION)

    records = read_api_envelope(spark, dump, schemas.CRM_DEALS, lines=True)
    stamped = stamp(records, _moment(standins.LOADED_AT))
    lake = _scratch(spark, "lake")
    landed = land(stamped, lake, "deals", date(2002, 1, 1), compression=COMPRESSION)
    return bronze.stg_crm_deals(spark.read.schema(stamped.schema).json(landed))


@query
def grid_rows(spark, sf_dir):
    """The goal sheet as a CSV export: read, blank rows dropped, stamped, renamed, all text."""
    export = _scratch(spark, "sheet")
    sheet = standins.metas_vendedores(spark, sf_dir)
    titled = sheet.toDF("Vendedor", "Mês", "Meta Receita", "Meta Deals Fechados", "Comissão (%)")
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    titled.write.options(header=True, **keep_blanks).csv(export)
    grid = shape.drop_blank_rows(read_grid(spark, export, multi_line=False))
    stamped = stamp(grid, _moment(standins.LOADED_AT), "Metas Vendedores v2")
    return stringify_all(rename_columns(stamped))


@query
def stringify_columns(spark, sf_dir):
    status = F.col("o_orderstatus")
    token = F.when(status == "F", "nan").when(status == "P", "None").otherwise("<NA>")
    return stringify_all(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.when(F.col("o_orderpriority") == "5-LOW", token)
            .otherwise(F.col("o_orderpriority"))
            .alias("priority"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(status).alias("status"),
        )
    )


@query
def drop_blank_rows(spark, sf_dir):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return shape.drop_blank_rows(
        table(spark, sf_dir, "orders").select(
            F.when(status == "F", F.col("o_orderkey")).alias("a"),
            F.when(priority == "5-LOW", priority).alias("b"),
        )
    )


def _exports(spark, sf_dir):
    """Dumps and sheets made of the test tables, and sources that are absent or without rows."""
    folder = _scratch(spark, "exports")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    nations.write.json(f"{folder}/nations")
    nations.where("n_nationkey < 0").select(F.lit(True).alias("success")).write.json(f"{folder}/none")
    nothing = table(spark, sf_dir, "region").select(F.lit(None).cast("string").alias("data"))
    nothing.write.option("ignoreNullFields", False).json(f"{folder}/null_data")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Código"),
        F.when(F.col("p_size") > 10, F.col("p_name")).alias("Nome (peça)"),
        F.col("p_type").alias("nome  peça"),
        F.lit(None).cast("string").alias("2ª via"),
    )
    blank = [F.when(F.col("Código") % 5 != 0, F.col(c)).alias(c) for c in parts.columns]
    parts.select(*blank).write.option("header", True).csv(f"{folder}/parts")
    parts.where("1 = 0").write.option("header", True).csv(f"{folder}/blank")
    names = [f"{kind}_{uuid.uuid4().hex}" for kind in ("nations", "none", "null_data", "absent")]
    sources = [
        load.ApiSource(f"{folder}/{kind}", name, kind, "n_nationkey bigint, n_name string", True)
        for kind, name in zip(("nations", "none", "null_data", "absent"), names)
    ]
    tabs = {kind: f"{kind} {uuid.uuid4().hex}" for kind in ("parts", "blank", "absent sheet")}
    sources.append(
        load.GridSource("Peças", tuple((t, f"{folder}/{kind}") for kind, t in tabs.items()), False)
    )
    report = load.run_sources(spark, sources, _scratch(spark, "lake"), _moment(standins.LOADED_AT))
    return report, {kind: table_name(t) for kind, t in tabs.items()} | {"nations": names[0]}


@query
def load_report(spark, sf_dir):
    """One row per source: what was loaded, skipped or failed, and how many rows."""
    report, _ = _exports(spark, sf_dir)
    kind = F.regexp_replace("table", "_[0-9a-f]{32}$", "")
    return report.select(kind.alias("source_table"), "status", "rows")


@query
def loaded_tables(spark, sf_dir):
    """The staging table of a sheet: blank rows gone, names clean and distinct, every cell text."""
    _, tables = _exports(spark, sf_dir)
    return spark.table(f"staging.{tables['parts']}")


@query
def loaded_records(spark, sf_dir):
    """The staging table of an API dump, by way of the raw zone."""
    _, tables = _exports(spark, sf_dir)
    return spark.table(f"staging.{tables['nations']}")


@query
def layer_tables(spark, sf_dir):
    """A table of a layer, refreshed twice and split by month; one year of months is read."""
    name = f"orders_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("value"),
        measures.month_of(F.col("o_orderdate")).alias("month"),
    )
    replace_table(orders.where("o_orderkey % 2 = 0"), " silver ", name, ["month"])
    replace_table(orders, "silver", name, ["month"])
    stored = spark.table(qualified_name(" silver ", name))
    return stored.where(F.col("month").between(F.lit("1995-01-01").cast("date"), F.lit("1995-12-01").cast("date")))


@query
def wide_sales_refreshed(spark, sf_dir):
    """The wide table of most deals, then of all: only months with other rows are written again."""
    name = f"wide_{uuid.uuid4().hex}"
    sellers = stage(_sellers(spark, sf_dir), "sellers")
    companies = stage(_companies(spark, sf_dir), "companies")
    wide = gold.wide_sales(stage(_sales(spark, sf_dir, sellers), "sales"), sellers, companies)
    late = F.col("mes_criacao_deal") >= F.lit("1997-06-01").cast("date")
    replace_changed(wide.where(~late | (F.col("status_deal") == "won")), "gold", name, "mes_criacao_deal")
    replace_changed(wide, "gold", name, "mes_criacao_deal")
    return spark.table(qualified_name("gold", name))


# -- odd sellers ------------------------------------------------------------------------------


@query
def odd_seller_dim(spark, sf_dir):
    """Deals without an owner, owners whose id is no number, and one spelled in two ways."""
    return silver.seller_dim(standins.odd_deals(spark, sf_dir))


@query
def odd_sales(spark, sf_dir):
    """Deals that find no seller, one seller, or two spellings of one."""
    sellers = stage(silver.seller_dim(standins.odd_deals(spark, sf_dir)), "sellers")
    known = sellers.where(F.col("vendedor_id").isNull() | (F.col("vendedor_id") != 7))
    deals = standins.odd_deals(spark, sf_dir)
    owners = deals.withColumn("owner_id", clean.safe_int(F.col("owner_id")))
    fact = silver.sales_fact(bronze.stg_crm_deals(owners), known, _companies(spark, sf_dir), _as_of())
    return fact.select("deal_id", "sk_vendedor", "valor_estimado")


@query
def odd_key_checks(spark, sf_dir):
    """Sellers with more than one row, and owners of deals that are no seller."""
    sellers = silver.seller_dim(standins.odd_deals(spark, sf_dir))
    return keys.duplicate_keys(sellers.where(F.col("vendedor_id").isNotNull()), ["vendedor_id"])


# -- history ---------------------------------------------------------------------------------

CHECKED = ("stage", "status", "value")


def _day_one(spark, sf_dir):
    records = standins.records_day_one(spark, sf_dir)
    return history.scd2_init(records, "id", _moment(standins.DAY_ONE))


def _day_two(spark, sf_dir):
    return history.scd2_merge(
        _day_one(spark, sf_dir),
        standins.records_day_two(spark, sf_dir),
        "id",
        CHECKED,
        _moment(standins.DAY_TWO),
    )


@query
def scd2_init(spark, sf_dir):
    return _day_one(spark, sf_dir)


@query
def scd2_merge(spark, sf_dir):
    return _day_two(spark, sf_dir)


@query
def scd2_current(spark, sf_dir):
    return history.scd2_current(_day_two(spark, sf_dir))


@query
def scd2_as_of(spark, sf_dir):
    return history.scd2_as_of(_day_two(spark, sf_dir), _moment("2002-01-02 12:00:00"))


@query
def scd2_stored(spark, sf_dir):
    """Both loads through the stored, partitioned history."""
    path = _scratch(spark, "history")
    for moment, records, first in (
        (standins.DAY_ONE, standins.records_day_one(spark, sf_dir), True),
        (standins.DAY_TWO, standins.records_day_two(spark, sf_dir), False),
    ):
        history.update_history(spark, path, records, "id", CHECKED, _moment(moment), first)
    return history.read_history(spark, path)


@query
def scd2_stored_new_column(spark, sf_dir):
    """The source gains a column with the second load; older versions show NULL there."""
    path = _scratch(spark, "history")
    later = standins.records_day_two(spark, sf_dir)
    later = later.withColumn("priority", F.concat(F.lit("p"), F.col("id") % 7))
    for moment, records, first in (
        (standins.DAY_ONE, standins.records_day_one(spark, sf_dir), True),
        (standins.DAY_TWO, later, False),
        (standins.DAY_THREE, later.where("id % 3 = 0").drop("priority"), False),
    ):
        history.update_history(spark, path, records, "id", CHECKED, _moment(moment), first)
    return history.read_history(spark, path)
