"""Line dedup on small cases, with the sketch alone and with exact counts near the threshold."""

import pytest

from salesloom.llm import line_dedup

DOCS = "doc_id long, text string, source string, key string, lines_removed string"


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, s, "k", "x") for i, t, s in rows], DOCS)
    got = line_dedup.remove_boilerplate(df, **options)
    assert got.columns[:5] == df.columns and len(got.columns) == 6
    added = got.columns[5]
    return sorted(((r["doc_id"], r["text"], r[added]) for r in got.collect()), key=str)


def test_first_occurrence_stays(spark):
    rows = [(i, f"own line {i}\nAll  rights reserved. \nlast", f"s{i}") for i in range(4)]
    rows.append((9, "All rights\treserved.\nAll rights reserved.", "s0"))
    got = run(spark, rows, min_words=3)
    assert got[0] == (0, rows[0][1], 0)
    assert got[1:4] == [(i, f"own line {i}\nlast", 1) for i in (1, 2, 3)]
    assert got[4] == (9, "", 2)


def test_spread_counts_sites_not_lines(spark):
    rows = [(i, "the very same line", "s0" if i % 2 else None) for i in range(50)]
    assert all(n == 0 for *_, n in run(spark, rows))


def test_short_lines_go_and_blank_lines_stay(spark):
    rows = [(i, "\n \nYes sir.\nMenu\n", f"s{i}") for i in range(6)]
    assert run(spark, rows) == [(0, rows[0][1], 0)] + [(i, "\n \n", 2) for i in range(1, 6)]
    assert [t for _, t, _ in run(spark, rows, min_words=3)] == [t for _, t, _ in rows]


@pytest.mark.parametrize("sites", [39, 40, 41, 80])
def test_threshold_is_exact(spark, sites):
    rows = [(i, "a line on many sites", f"s{i}") for i in range(sites)]
    removed = sum(n for *_, n in run(spark, rows, min_sites=40))
    assert removed == (sites - 1 if sites >= 40 else 0)


def test_nulls_repeats_long_texts_and_no_rows(spark):
    line = "boilerplate on each site"
    long = "\n".join([f"line number {i}" for i in range(20_000)] + [line])
    rows = [(None, f"a\n{line}", "s1"), (1, line, None), (1, line, None), (2, None, "s2"), (3, long, "s3"), (1, "other text", "s4")]
    got = run(spark, rows)
    assert (None, f"a\n{line}", 0) in got and got.count((1, "", 1)) == 2
    assert (2, None, 0) in got and (1, "other text", 0) in got
    assert [len(t) for i, t, n in got if i == 3] == [len(long) - len(line) - 1]
    df = spark.createDataFrame([], DOCS)
    assert line_dedup.remove_boilerplate(df).count() == 0
