"""Raw sales sources derived from the test tables: every row of a table becomes a record.

Orders are deals, customers are companies, nations are sellers, order lines carry goals and
costs. Text is made dirty by the row's own attributes, so each cleaner meets all of its cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2002-01-01 12:00:00"
LOADED_AT = "2002-01-01 06:00:00"
DAY_ONE, DAY_TWO, DAY_THREE = "2002-01-02 00:00:00", "2002-01-03 00:00:00", "2002-01-04 00:00:00"
DAY_ONE_ENDS = "2001-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _segment_channel() -> Column:
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "AUTOMOBILE", "Google Ads")
        .when(segment == "BUILDING", "Facebook Ads")
        .when(segment == "FURNITURE", "LinkedIn Ads")
        .when(segment == "HOUSEHOLD", "Eventos")
        .otherwise("Webinar")
    )


def _seller_name() -> Column:
    prefix = F.when(F.col("n_regionkey") == 0, "Nação ").otherwise("Seller ")
    return F.concat(prefix, F.col("n_nationkey"))


def crm_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    stage_id = F.left("o_orderpriority", F.lit(1)).cast("bigint")
    status = F.col("o_orderstatus")
    ordered = F.col("o_orderdate").cast("timestamp")
    added = F.timestamp_add("HOUR", F.col("o_orderkey") % 24, ordered)
    closed = F.timestamp_add("HOUR", F.floor("o_totalprice") % 2003, added)
    return rows.select(
        F.concat(F.lit("deal_"), "o_orderkey").alias("id"),
        F.concat(F.lit("Pedido "), "o_orderkey").alias("title"),
        F.col("o_orderpriority").alias("stage"),
        stage_id.alias("stage_id"),
        cents("o_totalprice").alias("value"),
        F.lit("BRL").alias("currency"),
        F.when(stage_id == 1, 100)
        .when(stage_id == 2, 80)
        .when(stage_id == 3, 60)
        .when(stage_id == 4, 25)
        .otherwise(10)
        .cast("bigint")
        .alias("probability"),
        F.col("c_nationkey").cast("bigint").alias("owner_id"),
        _seller_name().alias("owner_name"),
        F.col("c_custkey").alias("person_id"),
        F.col("c_name").alias("person_name"),
        F.when(stage_id != 5, F.col("o_custkey")).alias("org_id"),
        F.col("c_name").alias("org_name"),
        F.when(status == "F", "won").when(status == "P", "lost").otherwise("open").alias("status"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("expected_close_date"),
        added.alias("add_time"),
        added.alias("update_time"),
        F.when(status == "F", closed).alias("won_time"),
        F.when(status == "P", closed).alias("lost_time"),
        F.struct(
            F.array("o_orderpriority", "c_mktsegment").alias("produtos"),
            _segment_channel().alias("origem_lead"),
            F.col("c_mktsegment").alias("segmento"),
            F.col("n_name").alias("territorio"),
            F.when(status == "P", "Preço").alias("motivo_perda"),
            F.when(status == "O", "").alias("concorrente"),
        ).alias("custom_fields"),
        F.lit(LOADED_AT).cast("timestamp").alias("_ingested_at"),
    )


def odd_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deals with owner ids as text: some missing, some no number, and one seller whose name is
    written in two ways."""
    number, owner = F.col("stage_id"), F.col("owner_id")
    order = F.regexp_substr("id", F.lit(r"\d+")).cast("bigint")
    name = F.when((owner == 3) & (number == 2), F.upper("owner_name")).otherwise(F.col("owner_name"))
    text = F.when(owner == 5, F.concat(F.lit("x"), owner)).otherwise(owner.cast("string"))
    return crm_deals(spark, sf_dir).withColumns(
        {"owner_name": name, "owner_id": F.when(order % 11 != 0, text)}
    )


def crm_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    balance = cents("c_acctbal")
    stamp = F.lit(LOADED_AT).cast("timestamp")
    return rows.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("owner_id"),
        F.concat(F.lit("Rua "), "c_custkey").alias("address"),
        F.col("n_name").alias("city"),
        F.left("c_mktsegment", F.lit(2)).alias("state"),
        F.lit("Brasil").alias("country"),
        F.when(balance >= 0, F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias(
            "postal_code"
        ),
        F.col("c_mktsegment").alias("industry"),
        F.lit("50-100").alias("employees"),
        F.when(balance >= 0, balance * 1200).alias("annual_revenue"),
        F.col("c_nationkey").alias("people_count"),
        F.col("c_custkey").cast("string").alias("open_deals_count"),
        F.concat(F.col("c_nationkey"), F.lit(".5")).alias("won_deals_count"),
        stamp.alias("add_time"),
        stamp.alias("_ingested_at"),
    )


def crm_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lit(LOADED_AT).cast("timestamp")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("org_id"),
        F.col("c_nationkey").cast("bigint").alias("owner_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias(
            "email"
        ),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("+55 "), "c_custkey")).alias("phone"),
        F.col("c_mktsegment").alias("job_title"),
        stamp.alias("add_time"),
        stamp.alias("update_time"),
    )


def crm_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    done = kind.isin("purchase", "signup")
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("activity_"), "event_id").alias("id"),
        F.when(kind == "error", "none").otherwise(F.concat(F.lit("deal_"), user)).alias("deal_id"),
        user.alias("person_id"),
        user.alias("org_id"),
        user.alias("owner_id"),
        kind.alias("type"),
        F.concat_ws(" ", kind, user).alias("subject"),
        F.col("props").alias("note"),
        done.alias("done"),
        F.when(kind == "view", F.date_format("ts", "yyyy/MM/dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("due_date"),
        F.date_format("ts", "HH:mm").alias("due_time"),
        F.when(done, "00:30").alias("duration"),
        F.date_trunc("second", "ts").cast("timestamp").alias("add_time"),
        F.when(done, F.date_trunc("second", "ts").cast("timestamp")).alias("marked_as_done_time"),
    )


def dirty_date(c: Column) -> Column:
    """A date in the formats that people type, by the line's flags; some are no dates."""
    flags = F.concat("l_returnflag", "l_linestatus")
    return (
        F.when(F.col("l_tax") == 0, "n/d")
        .when(flags == "AF", F.date_format(c, "dd/MM/yyyy"))
        .when(flags == "AO", F.date_format(c, "yyyy-MM-dd"))
        .when(flags == "NF", F.date_format(c, "d-M-yyyy"))
        .when(flags == "NO", F.date_format(c, "yyyy/MM/dd"))
        .when(flags == "RF", F.date_format(c, "'  'dd/MM/yyyy' '"))
        .otherwise(F.date_format(c, "yyyy-M-d"))
    )


def metas_vendedores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    name = F.when(
        F.col("n_regionkey") == 4, F.concat(F.lit("Ghost "), "n_nationkey")
    ).otherwise(_seller_name())
    return rows.select(
        F.when(F.col("l_discount") != 0, F.upper(name)).alias("vendedor"),
        dirty_date(F.date_trunc("month", "l_shipdate")).alias("mes"),
        cents("l_extendedprice").cast("string").alias("meta_receita"),
        F.col("l_quantity").cast("bigint").cast("string").alias("meta_deals_fechados"),
        F.concat(F.round(F.col("l_discount") * 100).cast("int"), F.lit(",0%")).alias(
            "comissao_percentual"
        ),
    )


def custos_aquisicao(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    segment, flag = F.col("c_mktsegment"), F.col("l_returnflag")

    def spelled(a: str, n: str, r: str) -> Column:
        return F.when(flag == "A", a).when(flag == "N", n).otherwise(r)

    return rows.select(
        F.when(F.col("l_discount") != 0, dirty_date(F.col("l_shipdate"))).alias("data"),
        F.when(segment == "AUTOMOBILE", spelled("Gogle Ads", "google ads", "Google Ads"))
        .when(segment == "BUILDING", spelled("facebook", "FACE ads", "Facebook Ads"))
        .when(segment == "FURNITURE", spelled("linkedin", "LinkedIn Ads", "LINKEDIN"))
        .when(segment == "HOUSEHOLD", "Eventos")
        .otherwise("Rádio")
        .alias("origem_lead"),
        (cents("l_extendedprice") * F.lit("0.05").cast("decimal(4,2)"))
        .cast("decimal(18,4)")
        .cast("string")
        .alias("custo"),
        F.col("l_quantity").cast("bigint").cast("string").alias("quantidade_leads"),
        flag.alias("observacoes"),
        F.lit("custos_aquisicao_v2").alias("source_sheet"),
    )


def produtos_servicos(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    amount = F.translate(F.format_number(cents("p_retailprice"), 2), ",.", ".,")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("PROD"), "p_partkey").alias("produto_id"),
        F.col("p_name").alias("nome"),
        F.col("p_type").alias("categoria"),
        F.when(size < 3, "a consultar").otherwise(F.concat(F.lit("R$ "), amount)).alias(
            "preco_base"
        ),
        F.when(size > 40, F.concat(size, F.lit(",5%"))).otherwise(F.concat(size, F.lit("%"))).alias(
            "margem_minima"
        ),
        F.concat(size, F.lit(".5%")).alias("desconto_max"),
    )


def territorios_segmentos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    amount = cents("s_acctbal").cast("string")
    return rows.select(
        F.col("n_name").alias("territorio"),
        F.concat(F.lit("BR, "), "n_name").alias("estado"),
        F.when(F.col("n_regionkey") == 0, "Indústria").otherwise("Varejo").alias("segmento_foco"),
        F.col("s_name").alias("vendedor_responsavel"),
        F.when(F.col("s_acctbal") < 1000, F.concat(F.lit("R$ "), amount))
        .otherwise(amount)
        .alias("potencial_anual"),
    )


def deal_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records whose versions are kept."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("stage"),
        F.col("o_orderstatus").alias("status"),
        cents("o_totalprice").alias("value"),
        F.to_date("o_orderdate").alias("opened_on"),
    )


def records_day_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that existed when the history began."""
    return deal_records(spark, sf_dir).where(F.col("opened_on") < F.lit(DAY_ONE_ENDS).cast("date"))


def records_day_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records that have lines: some changed, some gone NULL, some new, some missing."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    status = F.when(
        (F.col("status") == "O") & (F.col("value") > 200000), "F"
    ).otherwise(F.col("status"))
    stage = F.when(F.col("stage") != "3-MEDIUM", F.col("stage"))
    return (
        deal_records(spark, sf_dir)
        .join(lines, "id", "left_semi")
        .withColumns({"status": status, "stage": stage})
    )
