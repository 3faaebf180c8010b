import json
import os
import threading
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.sources import load, readers, tables

RUN = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)
LAYOUT = "id string, value decimal(38,9), at timestamp, tags struct<names: array<string>, n: int>"
RECORDS = [
    {"id": "a", "value": 10.25, "at": "2024-01-01T10:00:00Z", "tags": {"names": ["x", "y"]}},
    {"id": "b", "value": None, "extra": 1, "tags": None},
]


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as file:
        file.write(text if isinstance(text, str) else json.dumps(text, indent=1))
    return path


def ids(df):
    return sorted(r.id for r in df.collect())


def test_envelope_forms(spark, folder):
    envelope = {"success": True, "data": RECORDS, "additional_data": {"pagination": {"limit": 100}}}
    for name, text in (("envelope", envelope), ("list", RECORDS), ("bare", {"data": RECORDS})):
        path = put(folder, f"{name}.json", text)
        df = readers.read_api_envelope(spark, path, LAYOUT)
        assert df.columns == ["id", "value", "at", "tags"], name
        first, second = df.orderBy("id").collect()
        assert first.value == Decimal("10.25") and first.tags.names == ["x", "y"]
        assert str(first["at"]) == "2024-01-01 10:00:00"
        assert second.value is None and second.tags is None
    root = put(folder, "root.json", RECORDS[0])
    assert ids(readers.read_api_envelope(spark, root, LAYOUT)) == ["a"]
    mixed = readers.read_api_envelope(spark, folder, LAYOUT)
    assert ids(mixed) == ["a"] * 4 + ["b"] * 3


@pytest.mark.parametrize("text", ['{"success": true, "data": []}', '{"success": true}', "[]"])
def test_envelope_without_records(spark, folder, text):
    path = put(folder, "none.json", text)
    assert readers.read_api_envelope(spark, path, LAYOUT).isEmpty()


def test_envelope_inferred_and_lines(spark, folder):
    path = put(folder, "envelope.json", {"success": True, "data": RECORDS})
    inferred = readers.read_api_envelope(spark, path)
    assert set(inferred.columns) == {"id", "value", "at", "tags", "extra"}
    assert ids(inferred) == ["a", "b"]
    listed = put(folder, "list.json", RECORDS)
    assert ids(readers.read_api_envelope(spark, listed)) == ["a", "b"]

    pages = "\n".join(json.dumps(p) for p in ({"data": RECORDS}, RECORDS, RECORDS[0]))
    lines = put(folder, "pages.jsonl", pages)
    assert ids(readers.read_api_envelope(spark, lines, LAYOUT, lines=True)) == list("aaabb")


def test_envelope_fields_must_not_clash(spark, folder):
    path = put(folder, "x.json", RECORDS)
    with pytest.raises(ValueError, match="data"):
        readers.read_api_envelope(spark, path, "id string, data string")


GRID = (
    'Nome,Preço,nome,,2ª via,nome\n'
    'a,"1,5",x,,"line\nbreak",\n'
    ',,,,,\n'
    'nan,"",y,z,"say ""hi""",None\n'
)


def test_grid(spark, folder):
    grid = readers.read_grid(spark, put(folder, "grid.csv", GRID))
    assert grid.columns == ["Nome", "Preço", "nome_2", "", "2ª via", "nome_5"]
    rows = [tuple(r) for r in grid.collect()]
    assert rows == [
        ("a", "1,5", "x", None, "line\nbreak", None),
        (None,) * 6,
        ("nan", None, "y", "z", 'say "hi"', "None"),
    ]
    assert readers.read_grid(spark, put(folder, "empty.csv", "")).isEmpty()
    assert readers.read_grid(spark, put(folder, "head.csv", "a,b\n")).isEmpty()


def test_stringify(spark):
    df = spark.sql("select 1 as a, 'nan' as b, '' as c, cast(null as int) as d, '<NA>' as e")
    assert tuple(readers.stringify_all(df).first()) == ("1", None, "", None, None)


def test_replace_table_keeps_old_rows_when_a_load_fails(spark):
    assert tables.replace_table(spark.range(3).toDF("n"), "swap", "t") == 3
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).cast("bigint").alias("n"))
    with pytest.raises(Exception, match="broken"):
        tables.replace_table(bad, "swap", "t")
    assert spark.table("swap.t").count() == 3
    for _ in range(2):  # a table may be rebuilt from itself
        old = spark.table("swap.t")
        tables.replace_table(old.union(old), "swap", "t")
    assert spark.table("swap.t").count() == 12


def test_land(spark, folder):
    df = readers.stamp(spark.range(2).toDF("id"), RUN)
    for _ in range(2):
        path = tables.land(df, folder, "deals", date(2024, 1, 30))
    tables.land(df, folder, "deals", date(2024, 1, 31))
    assert path == f"{folder}/raw/crm/deals/ingest_date=2024-01-30"
    landed = spark.read.json(f"{folder}/raw/crm/deals")
    assert landed.count() == 4
    assert landed.where("ingest_date = '2024-01-30'").count() == 2


def test_landed_records_may_be_compressed(spark, folder):
    """Same rows in a fraction of the bytes."""
    rows = spark.range(20_000).selectExpr("id", "concat('deal ', id % 7) as title", "struct(id % 3 as kind) as more")
    plain = tables.land(rows, folder, "plain", date(2024, 1, 30))
    small = tables.land(rows, folder, "small", date(2024, 1, 30), compression="gzip")
    size = [sum(e.stat().st_size for e in os.scandir(path)) for path in (plain, small)]
    assert size[1] * 4 < size[0]
    assert rows.exceptAll(spark.read.schema(rows.schema).json(small)).isEmpty()
    assert spark.read.json(small).count() == 20_000


def test_load_report(spark, folder):
    good = put(folder, "good.json", {"success": True, "data": RECORDS})
    empty = put(folder, "empty.json", {"success": True, "data": []})
    broken = put(folder, "broken.json", '{"data": [')
    sheet = put(folder, "sheet.csv", GRID)
    head = put(folder, "head.csv", "a,b\n")
    sources = [
        load.ApiSource(good, "api_good", "good", LAYOUT),
        load.ApiSource(good, "api_inferred", "inferred"),
        load.ApiSource(f"{folder}/absent.json", "api_absent", "absent", LAYOUT),
        load.ApiSource(empty, "api_good", "good", LAYOUT),
        load.ApiSource(broken, "api_broken", "broken", LAYOUT),
        load.GridSource("Planilha Nº 1", (("Aba 1", f"{folder}/absent.csv"), ("Aba 2", sheet))),
        load.GridSource("vazia", (("Aba 3", head),)),
    ]
    report = load.run_sources(spark, sources, f"{folder}/lake", RUN)
    got = {(r.table, r.status, r.rows) for r in report.collect()}
    assert got == {
        ("api_good", "success", 2),
        ("api_inferred", "success", 2),
        ("api_absent", "skipped", None),
        ("api_good", "skipped", None),
        ("api_broken", "skipped", None),
        ("aba_1", "error", None),
        ("aba_2", "success", 2),
        ("aba_3", "skipped", None),
    }
    assert load.report_totals(report) == {"success": 3, "error": 1, "skipped": 4}
    assert spark.table("staging.api_good").count() == 2  # the empty dump left it alone
    assert not spark.catalog.tableExists("staging.api_broken")

    tab = spark.table("staging.aba_2")
    assert tab.columns == [
        "nome", "preco", "nome_2", "col_", "col_2a_via", "nome_5", "source_sheet", "ingested_at",
    ]
    assert {f.dataType.simpleString() for f in tab.schema} == {"string"}
    rows = {tuple(r) for r in tab.drop("ingested_at").collect()}
    assert rows == {
        ("a", "1,5", "x", None, "line\nbreak", None, "planilha_no_1"),
        (None, None, "y", "z", 'say "hi"', None, "planilha_no_1"),
    }


def test_landing_failures_stop_the_job(spark, folder):
    good = put(folder, "good.json", {"success": True, "data": RECORDS})
    blocked = put(folder, "a_file", "x")
    with pytest.raises(Exception):
        load.run_sources(spark, [load.ApiSource(good, "t", "e", LAYOUT)], blocked, RUN)


def test_a_bad_second_load_leaves_raw_zone_and_table(spark, folder):
    lake = f"{folder}/lake"
    dump = put(folder, "dump.jsonl", "\n".join(json.dumps(r) for r in RECORDS))
    source = load.ApiSource(dump, "kept", "kept", LAYOUT, lines=True)
    assert load.load_api(spark, source, lake, RUN)[2:4] == ("success", 2)
    for bad in ('{"id": "c"}\n{"id": ', '{"success": true, "data": []}', '{"data": null}'):
        put(folder, "dump.jsonl", bad)
        assert load.load_api(spark, source, lake, RUN)[2] == "skipped"
        assert ids(spark.read.json(f"{lake}/raw/crm/kept/ingest_date=2024-01-30")) == ["a", "b"]
        assert ids(spark.table("staging.kept")) == ["a", "b"]
    assert sorted(os.listdir(f"{lake}/raw/crm/kept")) == ["ingest_date=2024-01-30"]


def test_a_document_without_any_field_is_no_record(spark, folder):
    path = put(folder, "null.json", {"data": None})
    assert readers.read_api_envelope(spark, path, LAYOUT).isEmpty()


def test_cells_beyond_the_header_are_an_error(spark, folder):
    put(f"{folder}/wide", "a.csv", "nome,mes\nana,2024-01-01,EXTRA\n")
    tab = load.load_tab(spark, "s", "aba larga", f"{folder}/wide", RUN, False)
    assert tab[2] == "error" and "EXTRA" in tab[4] and not spark.catalog.tableExists("staging.aba_larga")
    put(f"{folder}/trailing", "a.csv", "nome,mes\nana,2024-01-01,,\nbia\n")
    rows = [tuple(r) for r in readers.read_grid(spark, f"{folder}/trailing").collect()]
    assert rows == [("ana", "2024-01-01"), ("bia", None)]


def test_files_with_other_headers_are_refused(spark, folder):
    put(f"{folder}/both", "a.csv", "vendedor,mes\nana,1\n")
    put(f"{folder}/both", "b.csv", "mes,vendedor\n1,ana\n")
    with pytest.raises(readers.HeaderMismatch, match="mes"):
        readers.read_grid(spark, f"{folder}/both")
    assert load.load_tab(spark, "s", "duas", f"{folder}/both", RUN, True)[2] == "error"


@pytest.mark.parametrize("multi_line", [True, False])
def test_headers_of_many_files_are_checked_by_few_jobs(spark, folder, multi_line):
    for i in range(120):
        line = '"a\nb",1' if multi_line else "ana,1"
        put(f"{folder}/many", f"p{i:03}.csv", f"vendedor,mes\n{line}\n" * 1 + f"x,{i}\n" * (i % 3))
    put(f"{folder}/many", "none.csv", "")
    context = spark.sparkContext
    context.setJobGroup(f"headers {multi_line}", "")
    try:
        grid = readers.read_grid(spark, f"{folder}/many", multi_line=multi_line)
        jobs = context.statusTracker().getJobIdsForGroup(f"headers {multi_line}")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 6
    assert grid.count() == 240 and grid.columns == ["vendedor", "mes"]
    for bad in ("vendedor\nana\n", "vendedor,mes,valor\nana,1,2\n", "vendedor,Mes\nana,1\n"):
        put(f"{folder}/many", "p077.csv", bad)
        with pytest.raises(readers.HeaderMismatch, match="p077.csv"):
            readers.read_grid(spark, f"{folder}/many", multi_line=multi_line)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"


def test_sources_load_at_the_same_time_and_report_in_order(spark, folder, monkeypatch):
    met = threading.Barrier(4, timeout=60)

    def load_tab(session, sheet, tab, path, run_time, multi_line):
        met.wait()
        return (sheet, tab, "error" if tab == "t2" else "success", 1, None)

    tabs = tuple((f"t{i}", "") for i in range(8))
    with monkeypatch.context() as patched:
        patched.setattr(load, "load_tab", load_tab)
        report = load.run_sources(spark, [load.GridSource("s", tabs)], folder, RUN, concurrent=4)
    assert [r["table"] for r in report.collect()] == [t for t, _ in tabs]

    good = [put(folder, f"g{i}.csv", f"a,b\n{i},x\n") for i in range(6)]
    tabs = [(f"junto {i}", path) for i, path in enumerate(good)]
    tabs += [("junto falta", f"{folder}/no.csv"), ("junto 0", good[5])]
    dumps = [load.ApiSource(put(folder, f"d{i}.json", {"data": RECORDS}), f"junto_api_{i}", f"e{i}", LAYOUT) for i in range(3)]
    sources = [dumps[0], load.GridSource("s", tuple(tabs)), *dumps[1:]]
    report = load.run_sources(spark, sources, f"{folder}/lake", RUN)
    alone = load.run_sources(spark, sources, f"{folder}/lake2", RUN, concurrent=1)
    assert report.collect() == alone.collect() and report.count() == 11
    assert load.report_totals(report) == {"success": 10, "error": 1, "skipped": 0}
    assert spark.table("staging.junto_0").first()["a"] == "5"  # of two tabs of one name the last stays


def test_loads_that_share_a_target_share_a_lane():
    assert load._lanes([{"a"}, {"b"}, {"a", "c"}, {"d"}, {"c"}]) == [[0, 2, 4], [1], [3]]
    assert load._lanes([{"a"}, {"b"}, {"a", "b"}]) == [[0, 1, 2]]
    assert load._lanes([]) == []


def test_no_reader_deals_rows_out_unasked(spark, folder):
    path = put(folder, "x.json", {"data": RECORDS})
    grid = put(folder, "x.csv", "a,b\n1,2\n")
    for df in (readers.read_api_envelope(spark, path, LAYOUT), readers.read_grid(spark, grid)):
        assert "REPARTITION_BY_NUM" not in df._jdf.queryExecution().executedPlan().toString()
    assert readers.read_grid(spark, grid, partitions=3).rdd.getNumPartitions() == 3


def test_a_refresh_never_takes_the_table_away(spark, monkeypatch):
    tables.replace_table(spark.range(3).toDF("n"), "there", "t")
    statements, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **b: (statements.append(q), real(self, q, *a, **b))[1])
    tables.replace_table(spark.range(4).toDF("n"), "there", "t")
    assert not any("DROP" in s for s in statements) and spark.table("there.t").count() == 4
    assert tables.replace_table(spark.range(0).toDF("n"), "there", "t", keep_if_empty=True) == 0
    assert spark.table("there.t").count() == 4
    tables.replace_table(spark.range(2).toDF("m"), "there", "t")
    assert spark.table("there.t").columns == ["m"]


def test_a_table_split_by_month_is_read_by_month(spark, capsys):
    months = spark.range(100).selectExpr("id", "add_months(date'2024-01-01', cast(id % 5 as int)) as month")
    for _ in range(2):
        tables.replace_table(months, "split", "by_month", ["month"])
    one = spark.table("split.by_month").where("month = date'2024-03-01'")
    assert one.count() == 20
    one.explain()
    assert "PartitionFilters: [isnotnull(month" in capsys.readouterr().out


def test_headers_of_large_files_are_checked_by_parts(spark, folder):
    """A large file is no single task's work, and its later parts have no header."""
    rows = "".join(f"seller {i},{i}\n" for i in range(2000))
    for name in ("a.csv", "b.csv"):
        put(f"{folder}/large", name, "vendedor,mes\n" + rows)
    context, setting = spark.sparkContext, "spark.sql.files.maxPartitionBytes"
    context.setJobGroup("parts of files", "")
    spark.conf.set(setting, "2k")
    try:
        grid = readers.read_grid(spark, f"{folder}/large", multi_line=False)
        status = context.statusTracker()
        stages = [i for j in status.getJobIdsForGroup("parts of files") for i in status.getJobInfo(j).stageIds]
        assert grid.count() == 4000
        put(f"{folder}/large", "b.csv", "mes,vendedor\n" + rows)
        with pytest.raises(readers.HeaderMismatch, match="b.csv"):
            readers.read_grid(spark, f"{folder}/large", multi_line=False)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset(setting)
    assert max(info.numTasks for info in map(status.getStageInfo, stages) if info) > 10
