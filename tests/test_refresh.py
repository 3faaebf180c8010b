"""Tables that are refreshed by the months whose rows differ."""

import os
import uuid

import oracle
import pytest
from pyspark.sql import functions as F

from salesloom.operators.changes import digests
from salesloom.operators.staging import stage
from salesloom.plans import bronze, build, gold, silver
from salesloom.sources import tables
from workload import standins

SF = f"{oracle.TESTDATA}/sf0.001"
ROWS = [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-02-01"), (4, None, None)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "id int, name string, month string")
    return df.withColumn("month", F.col("month").cast("date"))


def content(df):
    return sorted((tuple(map(str, r)) for r in df.select("id", "name", "month").collect()))


def stored_files(df):
    """Files of each month's folder, with the moment of their last write."""
    found = {}
    for url in df.inputFiles():
        path = url.removeprefix("file://")
        found.setdefault(path.split("/")[-2].partition("=")[2], set()).add((path, os.stat(path).st_mtime_ns))
    return found


def refresh(spark, name, rows):
    written = tables.replace_changed(frame(spark, rows), "gold", name, "month")
    assert content(spark.table(f"gold.{name}")) == content(frame(spark, rows))
    return written


def test_only_months_that_differ_are_written(spark):
    name = f"marts_{uuid.uuid4().hex}"
    assert len(refresh(spark, name, ROWS)) == 3
    before = stored_files(spark.table(f"gold.{name}"))
    assert refresh(spark, name, ROWS[::-1]) == []
    assert stored_files(spark.table(f"gold.{name}")) == before
    changed = [(1, "z", "2024-01-01"), *ROWS[1:], (5, "e", "2024-03-01")]
    assert refresh(spark, name, changed) == ["2024-01-01", "2024-03-01"]
    after = stored_files(spark.table(f"gold.{name}"))
    assert after["2024-02-01"] == before["2024-02-01"] and after["2024-01-01"] != before["2024-01-01"]
    assert after["__HIVE_DEFAULT_PARTITION__"] == before["__HIVE_DEFAULT_PARTITION__"]


def test_months_go_come_back_and_repeat_rows(spark):
    name = f"marts_{uuid.uuid4().hex}"
    refresh(spark, name, ROWS)
    assert refresh(spark, name, ROWS[:2]) == ["2024-02-01", "__HIVE_DEFAULT_PARTITION__"]
    assert refresh(spark, name, []) == ["2024-01-01"]
    assert len(refresh(spark, name, ROWS)) == 3
    assert refresh(spark, name, [*ROWS, ROWS[2]]) == ["2024-02-01"]
    assert refresh(spark, name, [*ROWS[:3], (None, "4", None)]) == ["2024-02-01", "__HIVE_DEFAULT_PARTITION__"]


def test_a_full_refresh_or_other_columns_end_what_was_noted(spark):
    name = f"marts_{uuid.uuid4().hex}"
    refresh(spark, name, ROWS)
    for rows in (ROWS[:1], ROWS[:2]):  # twice, so the table points at the same folder again
        tables.replace_table(frame(spark, rows), "gold", name, ["month"])
    assert len(refresh(spark, name, ROWS)) == 3
    wider = frame(spark, ROWS).withColumn("more", F.lit(1))
    assert len(tables.replace_changed(wider, "gold", name, "month")) == 3
    assert "more" in spark.table(f"gold.{name}").columns


def test_a_refresh_that_stops_is_made_good(spark, monkeypatch):
    name = f"marts_{uuid.uuid4().hex}"
    refresh(spark, name, ROWS)
    note = tables._note

    def stopped(spark, path, number, folders):
        if None not in folders.values():
            raise RuntimeError("driver lost")
        note(spark, path, number, folders)

    monkeypatch.setattr(tables, "_note", stopped)
    with pytest.raises(RuntimeError, match="driver lost"):
        tables.replace_changed(frame(spark, ROWS[:2]), "gold", name, "month")
    monkeypatch.setattr(tables, "_note", note)
    assert refresh(spark, name, ROWS) == ["2024-02-01", "__HIVE_DEFAULT_PARTITION__"]


def test_digests_tell_nulls_and_places_apart(spark):
    rows = [(1, None, "x"), (2, "x", None), (3, "x", "x"), (4, None, None), (5, "xx", None)]
    df = spark.createDataFrame(rows, "by int, a string, b string")
    assert digests(df, "by").select("digest").distinct().count() == 5
    assert digests(df.where("false"), "by").count() == 0
    with pytest.raises(ValueError, match="no date"):
        tables.replace_changed(df, "gold", "never", "by")


def test_three_loads_equal_the_full_build(spark):
    as_of = F.lit(standins.AS_OF).cast("timestamp")
    deals = stage(standins.crm_deals(spark, SF).where("year(add_time) = 1995"), "deals")
    companies = stage(silver.company_dim(bronze.stg_crm_organizations(standins.crm_organizations(spark, SF))), "companies")
    goals = silver.goal_fact(bronze.stg_metas_vendedores(standins.metas_vendedores(spark, SF)))
    goals = stage(goals.where("mes_referencia < '1993-01-01'"), "goals")
    month = F.date_format("add_time", "yyyy-MM")
    won = F.when(month == "1995-03", "won").otherwise(F.col("status"))
    before, gone = None, "1995-05-01"
    for load in (deals.where(month != "1995-05"), deals.withColumn("status", won), deals.where(month != "1995-08")):
        sellers = stage(silver.seller_dim(load, goals), "sellers")
        sales = stage(silver.sales_fact(bronze.stg_crm_deals(load), sellers, companies, as_of), "sales")
        marts = {
            "obt_vendas_analitico": gold.wide_sales(sales, sellers, companies),
            "agg_meta_vs_realizado": gold.goals_vs_actuals(sales, goals, sellers),
        }
        for name, full in marts.items():
            stored = build._store(full, "gold", name, changed_only=True)
            full = full.select(*stored.columns)
            assert stored.exceptAll(full).isEmpty() and full.exceptAll(stored).isEmpty()
        after = stored_files(spark.table("gold.obt_vendas_analitico"))
        if before:
            changed = {m for m in before.keys() | after.keys() if before.get(m) != after.get(m)}
            assert changed == {"1995-03-01", gone} and len(after) > 10
            gone = "1995-08-01"
        before = after
