"""Apportionment against ranked quotients, and what the mix takes."""

from collections import defaultdict

import oracle
from hypothesis import given, settings
from hypothesis import strategies as st

from salesloom.llm import mixing

DOCS = "doc_id long, text string, source string, size string, Taken int"


def highest_quotients(weights, seats):
    order = sorted((-w / (2 * k + 1), i) for i, w in enumerate(weights) if w for k in range(seats))
    quota = [0] * len(weights)
    for _, i in order[:seats]:
        quota[i] += 1
    return quota


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=9), min_size=1, max_size=6), st.integers(0, 50))
def test_sainte_lague(spark, groups, seats):
    rows = [(g, i, w, seats) for g, ws in enumerate(groups) for i, w in enumerate(ws)]
    df = spark.createDataFrame(rows, "g int, k int, weight long, seats long")
    got = defaultdict(dict)
    for r in mixing.sainte_lague(df, "k", ("g",)).collect():
        got[r["g"]][r["k"]] = r["quota"]
    for g, weights in enumerate(groups):
        expected = highest_quotients(weights, seats)
        assert [got[g][i] for i in range(len(weights))] == expected


def test_near_targets_and_reruns(spark):
    docs = spark.read.parquet(f"{oracle.TESTDATA}/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.02 * t + mixing.BLOCK for s, t in target.items())
    assert abs(sum(target.values()) - sum(r["size"] for r in rows)) < 1
    assert sorted(mixing.mix(docs.repartition(3)).collect()) == sorted(rows)


def test_stopped_sources_are_taken_three_times(spark):
    rows = [(i, "a b c d", "big", "x", 1) for i in range(400)] + [(900, "one two", "tiny", "x", 1)]
    rows += [(901, None, None, "x", 1), (902, " ", "void", "x", 1), (None, "k l m", "tiny", "x", 1)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and by[900]["taken"] == 6 and by[None]["taken"] == 9 and by[900]["target"] == 15.0
    assert by[901]["taken"] == 0 and by[901]["target"] == 0.0 and by[902]["size"] == 0
    assert abs(sum(r["taken"] for r in got if r["source"] == "big") - (1605 - 15)) <= mixing.BLOCK


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", "s", "x", 1)] * 5, DOCS)
    assert mixing.mix(df).count() == 5
    assert mixing.mix(df.where("false")).count() == 0
    assert mixing.mix(spark.createDataFrame([(1, "", "s", "x", 1)], DOCS)).first()["taken"] == 0
